"""Raster grids as long tables, and geometry as well-known binary."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_npz(spark: SparkSession, path: str, fill: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(cells: file, row, col, value; meta: file, ny, nx, x0, y0, x1, y1) of archives with grid and bounds.

    Files are read by Spark; each is opened in one task.  NaN becomes ``fill``.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def cells(frames):
        import io

        for f in frames:
            for p, raw in zip(f["path"], f["content"], strict=True):
                g = np.nan_to_num(np.load(io.BytesIO(raw))["grid"].astype(np.float64), nan=fill)
                row, col = np.indices(g.shape)
                yield pd.DataFrame({"file": p, "row": row.ravel().astype(np.int32), "col": col.ravel().astype(np.int32), "value": g.ravel()})

    def meta(frames):
        import io

        for f in frames:
            for p, raw in zip(f["path"], f["content"], strict=True):
                z = np.load(io.BytesIO(raw))
                b = z["bounds"].astype(float)
                yield pd.DataFrame({"file": [p], "ny": [z["grid"].shape[0]], "nx": [z["grid"].shape[1]], "x0": [b[0]], "y0": [b[1]], "x1": [b[2]], "y1": [b[3]]})

    return files.mapInPandas(cells, "file string, row int, col int, value double"), files.mapInPandas(meta, "file string, ny int, nx int, x0 double, y0 double, x1 double, y1 double")


def _put(spark: SparkSession, path: str, raw: bytes) -> None:
    """Writes one small file through the file system of its path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(raw)
    out.close()


def write_npz(spark: SparkSession, path: str, grid: np.ndarray, bounds: tuple[float, float, float, float]) -> None:
    """One raster with its bounds as an archive; the caller holds the raster, so it is one that fits."""
    import io

    held = io.BytesIO()
    np.savez_compressed(held, grid=grid, bounds=np.asarray(bounds, dtype=np.float64))
    _put(spark, path, held.getvalue())


def write_npy(spark: SparkSession, path: str, grid: np.ndarray) -> None:
    import io

    held = io.BytesIO()
    np.save(held, grid)
    _put(spark, path, held.getvalue())


def read_npy(spark: SparkSession, path: str, bands: tuple[str, ...] = ("value",), fill: float = 0.0) -> DataFrame:
    """file, row, col and a column a band, of arrays with one band (two axes) or a structured type; NaN becomes ``fill``."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def cells(frames):
        import io

        for f in frames:
            for p, raw in zip(f["path"], f["content"], strict=True):
                g = np.load(io.BytesIO(raw))
                row, col = np.indices(g.shape)
                values = {b: np.nan_to_num((g[b] if g.dtype.names else g).astype(np.float64), nan=fill).ravel() for b in bands}
                yield pd.DataFrame({"file": p, "row": row.ravel().astype(np.int32), "col": col.ravel().astype(np.int32), **values})

    return files.mapInPandas(cells, "file string, row int, col int, " + ", ".join(f"{b} double" for b in bands))


def write_grid(cells: DataFrame, path: str) -> None:
    """Cells (row, col, value) of any number as Parquet, near ones together."""
    cells.repartitionByRange("row", "col").write.mode("overwrite").parquet(path)


@F.pandas_udf(T.BinaryType())
def to_wkb(geom: pd.Series) -> pd.Series:
    """Little-endian well-known binary of a line (array of (x, y))."""
    return geom.map(lambda g: None if g is None else struct.pack("<BII", 1, 2, len(g)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in g))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
def from_wkb(raw: pd.Series) -> pd.Series:
    def one(b):
        if b is None:
            return None
        order = "<" if b[0] else ">"
        kind, n = struct.unpack_from(order + "II", b, 1)
        if kind != 2:
            raise ValueError(f"not a line: {kind}")
        flat = struct.unpack_from(order + f"{2 * n}d", b, 9)
        return [{"x": flat[2 * i], "y": flat[2 * i + 1]} for i in range(n)]

    return raw.map(one)
