"""Planar and geographic expressions on columns, and geometry as arrays of (x, y)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The WGS84 ellipsoid and the scale and offsets of UTM zones.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, FALSE_EASTING = 0.9996, 500000.0
_N = FLATTENING / (2 - FLATTENING)
_A = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def to_utm(lon: Column, lat: Column, zone: int = 44) -> tuple[Column, Column]:
    """(easting, northing) on the northern side of a UTM zone, by Krueger's series."""
    phi, lam = F.radians(lat), F.radians(lon - (6 * zone - 183))
    e2 = 2 * math.sqrt(_N) / (1 + _N)
    t = F.sinh(F.atanh(F.sin(phi)) - e2 * F.atanh(e2 * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_EASTING + SCALE * _A * x, SCALE * _A * y


def from_utm(easting: Column, northing: Column, zone: int = 44) -> tuple[Column, Column]:
    """(lon, lat), the inverse of ``to_utm``."""
    xi, eta = northing / (SCALE * _A), (easting - FALSE_EASTING) / (SCALE * _A)
    p, q = xi, eta
    for j, b in enumerate(_BETA, 1):
        p = p - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        q = q - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(p) / F.cosh(q))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(F.atan2(F.sinh(q), F.cos(p))) + (6 * zone - 183), F.degrees(lat)


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.hypot(ax - bx, ay - by)


def edges(line: Column) -> Column:
    """The edges of a line: structs (a, b)."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(line) - 1, F.lit(1))), lambda i: F.struct(F.get(line, i - 1).alias("a"), F.get(line, i).alias("b")))


def length(line: Column) -> Column:
    """Length of an array of structs (x, y); 0 for fewer than two points."""
    whole = F.aggregate(edges(line), F.lit(0.0), lambda s, e: s + F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]))
    return F.when(F.size(line) >= 2, whole).otherwise(0.0)


def _nearest(line: Column, x: Column, y: Column) -> Column:
    """struct (d, along): distance of a point from a line and where along it the nearest point lies."""

    def step(s: Column, e: Column) -> Column:
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        size = F.hypot(dx, dy)
        t = F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - e["a"]["x"]) * dx + (y - e["a"]["y"]) * dy) / (size * size)))).otherwise(0.0)
        d = F.hypot(e["a"]["x"] + t * dx - x, e["a"]["y"] + t * dy - y)
        nearer = d < s["d"]
        return F.struct(F.when(nearer, d).otherwise(s["d"]).alias("d"), F.when(nearer, s["run"] + t * size).otherwise(s["along"]).alias("along"), (s["run"] + size).alias("run"))

    start = F.struct(F.lit(float("inf")).alias("d"), F.lit(0.0).alias("along"), F.lit(0.0).alias("run"))
    return F.aggregate(edges(line), start, step)


def line_distance(line: Column, x: Column, y: Column) -> Column:
    return _nearest(line, x, y)["d"]


def project(line: Column, x: Column, y: Column) -> Column:
    """Metres along the line of the point nearest to (x, y)."""
    return _nearest(line, x, y)["along"]


def interpolate(line: Column, at: Column) -> Column:
    """struct (x, y) of the point ``at`` metres along a line, held to its ends."""

    def step(s: Column, e: Column) -> Column:
        size = F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"])
        t = F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (at - s["run"]) / size))).otherwise(0.0)
        inside = (at > s["run"]) | (s["run"] == 0)
        return F.struct(
            F.when(inside, e["a"]["x"] + t * (e["b"]["x"] - e["a"]["x"])).otherwise(s["x"]).alias("x"),
            F.when(inside, e["a"]["y"] + t * (e["b"]["y"] - e["a"]["y"])).otherwise(s["y"]).alias("y"),
            (s["run"] + size).alias("run"),
        )

    start = F.struct(F.get(line, F.lit(0))["x"].alias("x"), F.get(line, F.lit(0))["y"].alias("y"), F.lit(0.0).alias("run"))
    got = F.aggregate(edges(line), start, step)
    return F.struct(got["x"].alias("x"), got["y"].alias("y"))


def measured(line: Column) -> Column:
    """The points of a line as structs (x, y, d): d is the metres along the line."""

    def step(s: Column, e: Column) -> Column:
        last = F.element_at(s, -1)
        return F.array_append(s, F.struct(e["b"]["x"].alias("x"), e["b"]["y"].alias("y"), (last["d"] + F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"])).alias("d")))

    first = F.get(line, F.lit(0))
    return F.aggregate(edges(line), F.array(F.struct(first["x"].alias("x"), first["y"].alias("y"), F.lit(0.0).alias("d"))), step)


def sub_line(points: Column, a: Column, b: Column) -> Column:
    """The part of a measured line (``measured``) from ``a`` to ``b`` metres along it."""

    def place(d: Column) -> Column:
        low = F.coalesce(F.element_at(F.filter(points, lambda p: p["d"] <= d), -1), F.get(points, F.lit(0)))
        high = F.coalesce(F.get(F.filter(points, lambda p: p["d"] > d), F.lit(0)), low)
        t = F.when(high["d"] > low["d"], F.greatest(F.lit(0.0), (d - low["d"]) / (high["d"] - low["d"]))).otherwise(0.0)
        return F.struct((low["x"] + t * (high["x"] - low["x"])).alias("x"), (low["y"] + t * (high["y"] - low["y"])).alias("y"))

    inner = F.transform(F.filter(points, lambda p: (p["d"] > a) & (p["d"] < b)), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return F.concat(F.array(place(a)), inner, F.array(place(b)))


def cut(points: Column, at: Column) -> Column:
    """The sub-lines of a measured line (``measured``) between neighbouring positions: ``at`` is a sorted array of
    metres, from the first cut to the last; one line fewer than positions."""
    parts = F.transform(F.sequence(F.lit(0), F.size(at) - 2), lambda i: sub_line(points, F.get(at, i), F.get(at, i + 1)))
    return F.when(F.size(at) > 1, parts).otherwise(F.array().cast("array<array<struct<x:double,y:double>>>"))


def inside(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in a closed ring, by ray casting."""

    def step(s: Column, e: Column) -> Column:
        a, b = e["a"], e["b"]
        crosses = ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])
        return F.when(F.coalesce(crosses, F.lit(False)), ~s).otherwise(s)

    return F.aggregate(edges(ring), F.lit(False), step)


def cell_centre(row: Column, col: Column, bounds: tuple[float, float, float, float], ny: int, nx: int) -> tuple[Column, Column]:
    """Centre of a grid cell; row 0 is the northern one."""
    x0, y0, x1, y1 = bounds
    return x0 + (col + 0.5) * ((x1 - x0) / nx), y1 - (row + 0.5) * ((y1 - y0) / ny)


def cell_index(x: Column, y: Column, bounds: tuple[float, float, float, float], ny: int, nx: int) -> tuple[Column, Column]:
    """(row, col) of the nearest cell, halves to even, held to the grid."""
    x0, y0, x1, y1 = bounds
    col = F.rint((x - x0) / (x1 - x0) * nx - 0.5)
    row = F.rint((y1 - y) / (y1 - y0) * ny - 0.5)

    def held(v: Column, n: int) -> Column:
        return F.least(F.greatest(v, F.lit(0.0)), F.lit(float(n - 1))).cast("long")

    return held(row, ny), held(col, nx)


def degree_box(lon: Column, lat: Column, metres: float) -> tuple[Column, Column, Column, Column]:
    """A box of half-width ``metres`` around a point, in degrees."""
    dlat = metres / 111320.0
    dlon = F.lit(metres) / (111320.0 * F.cos(F.radians(lat)))
    return lon - dlon, lat - dlat, lon + dlon, lat + dlat
