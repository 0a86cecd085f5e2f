"""Registered queries of sources, sinks, lines, models and stages."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import scalar as S
from ..operators import health, lines
from ..sources import grids, kml, tables
from ..state import fresh as _fresh
from ..state import settle
from ..streaming import chunks, events
from . import stages
from . import testmap as T
from .network import labelled, root, scored_segments
from .registry import QUERIES, query

L = "bigint"


@query("S1_kml_scan", "SELECT n_name AS name, 'R' || n_regionkey AS basin, 2::BIGINT AS points, (n_nationkey + 1)::DOUBLE AS x1 FROM nation")
def _(spark, d):
    n = T.table(spark, d, "nation")
    k = F.col("n_nationkey").cast("string")
    mark = F.concat(F.lit("<Placemark><name>"), "n_name", F.lit('</name><ExtendedData><SchemaData schemaUrl="#s"><SimpleData name="basin">R'), F.col("n_regionkey").cast("string"), F.lit("</SimpleData></SchemaData></ExtendedData><LineString><coordinates>"), k, F.lit(",0,0 "), (F.col("n_nationkey") + 1).cast("string"), F.lit(",1,0</coordinates></LineString></Placemark>"))
    path = _fresh(spark, "kml")
    marks = n.agg(F.concat(F.lit("<kml><Document>"), F.array_join(F.collect_list(mark), ""), F.lit("</Document></kml>")).alias("value"))
    marks.write.text(path)  # one document of 25 places
    g = kml.read_kml(spark, path, ["basin"])
    return g.select("name", "basin", F.size("geom").cast(L).alias("points"), F.col("geom")[1]["x"].alias("x1"))


@query("S6_overpass_ways", "SELECT n_nationkey::BIGINT AS osm_id, n_name AS name, 'river' AS waterway, 2::BIGINT AS points FROM nation")
def _(spark, d):
    p = lambda i: F.struct(F.col("n_nationkey").cast("double").alias("lat"), F.lit(float(i)).alias("lon"))
    way = F.struct(F.lit("way").alias("type"), F.col("n_nationkey").cast(L).alias("id"), F.create_map(F.lit("name"), F.col("n_name"), F.lit("waterway"), F.lit("river")).alias("tags"), F.array(p(0), p(1)).alias("geometry"))
    path = _fresh(spark, "ways")
    T.table(spark, d, "nation").select(F.to_json(F.struct(F.array(way).alias("elements"))).alias("value")).write.text(path)
    raw = spark.read.text(path)  # one document a line; a downloaded file is one document and is read whole
    one = _fresh(spark, "way-files")
    raw.repartition(raw.count(), "value").write.option("maxRecordsPerFile", 1).text(one)
    return tables.overpass_ways(spark, one).select("osm_id", "name", "waterway", F.size("geom").cast(L).alias("points"))


@query("S11_optional_input", "SELECT r_regionkey::BIGINT AS k, NULL::DOUBLE AS water FROM region")
def _(spark, d):
    dw = tables.read_optional(spark, _fresh(spark, "none"), "k long, water double")
    return T.table(spark, d, "region").select(F.col("r_regionkey").cast(L).alias("k")).join(dw, "k", "left")


@query("K1_wkb_table", "SELECT vec_id AS id, 2::BIGINT AS points, CAST(embedding[3] AS DOUBLE) AS x1 FROM embeddings")
def _(spark, d):
    e = T.table(spark, d, "embeddings")
    pt = lambda i: F.struct(F.col("embedding")[i].cast("double").alias("x"), F.col("embedding")[i + 1].cast("double").alias("y"))
    path = _fresh(spark, "wkb")
    tables.overwrite(e.select(F.col("vec_id").alias("id"), grids.to_wkb(F.array(pt(0), pt(2))).alias("wkb")), path)
    g = spark.read.parquet(path).select("id", grids.from_wkb("wkb").alias("g"))
    return g.select("id", F.size("g").cast(L).alias("points"), F.col("g")[1]["x"].alias("x1"))


@query("S4_npz_grid", "SELECT r_regionkey::INT AS row, n_nationkey::INT AS col, CASE WHEN n_regionkey = r_regionkey THEN n_nationkey * 1.5 ELSE 0 END::DOUBLE AS value, 5::BIGINT AS ny, 25::DOUBLE AS x1 FROM nation, region")
def _(spark, d):
    """A raster of regions by nations, with holes, written as an archive and read again."""
    n = T.table(spark, d, "nation").select("n_regionkey", "n_nationkey").collect()  # 25 rows
    grid = np.full((5, 25), np.nan)
    for r in n:
        grid[r["n_regionkey"], r["n_nationkey"]] = r["n_nationkey"] * 1.5
    path = _fresh(spark, "grid")
    grids.write_npz(spark, f"{path}/a.npz", grid, (0.0, 0.0, 25.0, 5.0))
    cells, meta = grids.read_npz(spark, path)
    return cells.join(F.broadcast(meta), "file").select("row", "col", "value", F.col("ny").cast(L).alias("ny"), "x1")


@query("S8_npy_bands", "SELECT n_regionkey::INT AS row, n_nationkey::INT AS col, n_nationkey::DOUBLE AS a, 0::DOUBLE AS b FROM nation UNION ALL SELECT r_regionkey, n_nationkey, 0, 0 FROM nation, region WHERE n_regionkey <> r_regionkey")
def _(spark, d):
    grid = np.zeros((5, 25), dtype=[("a", "f4"), ("b", "f4")])
    grid["b"] = np.nan
    for r in T.table(spark, d, "nation").select("n_regionkey", "n_nationkey").collect():
        grid[r["n_regionkey"], r["n_nationkey"]] = (r["n_nationkey"], np.nan)
    path = _fresh(spark, "bands")
    grids.write_npy(spark, f"{path}/a.npy", grid)
    return grids.read_npy(spark, path, ("a", "b")).select("row", "col", "a", "b")


@query("S9_polygons", "SELECT n_name AS name, 5::BIGINT AS points, (n_nationkey + 1)::DOUBLE AS x1 FROM nation UNION ALL SELECT n_name, 5, n_nationkey + 101 FROM nation WHERE n_nationkey % 2 = 1")
def _(spark, d):
    """One square a nation; odd ones have a second part."""
    def ring(at):
        text = "[[{0},0],[{1},0],[{1},1],[{0},1],[{0},0]]"
        a, b = at.cast("string"), (at + 1).cast("string")
        return F.replace(F.replace(F.lit(text), F.lit("{0}"), a), F.lit("{1}"), b)

    k = F.col("n_nationkey").cast("long")
    shape = F.when(k % 2 == 1, F.concat(F.lit('"MultiPolygon","coordinates":[['), ring(k), F.lit("],["), ring(k + 100), F.lit("]]"))).otherwise(F.concat(F.lit('"Polygon","coordinates":['), ring(k), F.lit("]")))
    one = F.concat(F.lit('{"type":"Feature","properties":{"district":"'), "n_name", F.lit('"},"geometry":{"type":'), shape, F.lit("}}"))
    path = _fresh(spark, "polygons")
    T.table(spark, d, "nation").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(one), ","), F.lit("]}")).alias("value")).write.text(path)  # one document of 25 features
    return tables.read_polygons(spark, path, "district").select("name", F.size("ring").cast(L).alias("points"), F.col("ring")[1]["x"].alias("x1"))


@query("K2_csv_overwrite", "SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders")
def _(spark, d):
    o = T.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    return tables.csv_round_trip(o)


@query("K5_grid_write", "SELECT (p_partkey // 50)::BIGINT AS row, (p_partkey % 50)::BIGINT AS col, CAST(p_retailprice AS DOUBLE) AS value FROM part")
def _(spark, d):
    k = F.col("p_partkey")
    path = _fresh(spark, "grid")
    grids.write_grid(T.table(spark, d, "part").select(F.floor(k / 50).cast(L).alias("row"), (k % 50).cast(L).alias("col"), F.col("p_retailprice").cast("double").alias("value")), path)
    return spark.read.parquet(path)


@query("K6_network_save", "SELECT vec_id AS seg_id, vec_id AS src, vec_id + 1 AS dst, round(CAST(embedding[3] AS DOUBLE), 8) AS x1, vec_id = 0 AS is_source FROM embeddings")
def _(spark, d):
    e = _polylines(spark, d).select(F.col("id").alias("seg_id"), F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), "geom")
    n = e.select(F.col("src").alias("node"), (F.col("src") == 0).alias("is_source"))
    path = _fresh(spark, "network")
    tables.save_network(e, n, path)
    edges, nodes = tables.load_network(spark, path)
    return edges.join(nodes, F.col("src") == F.col("node")).select("seg_id", "src", "dst", F.round(F.col("geom")[1]["x"], 8).alias("x1"), "is_source")


@query("K3_append", "SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def _(spark, d):
    path = _fresh(spark, "append")
    for k in range(4):
        tables.append(T.table(spark, d, "events").where(f"pmod(event_id, 4) = {k}"), path)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("K4_replace", "SELECT o_orderkey, o_orderpriority, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)::BIGINT AS seen_before FROM orders")
def _(spark, d):
    """A table is replaced while a reader has it; a write that fails midway leaves the old version to be read."""
    o = T.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    path = _fresh(spark, "replaced")
    tables.replace(o.where("o_orderkey % 2 = 0"), path)
    reader = tables.read_current(spark, path)
    broken = o.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 7 == 3, F.raise_error(F.lit("a write that fails")).cast("long")).otherwise(F.col("o_orderkey")))
    try:
        tables.replace(broken, path, attempts=1)
    except Exception:  # noqa: BLE001 - the point of the query
        pass
    n = tables.read_current(spark, path).count()
    tables.replace(o, path)
    seen = reader.agg(F.when(F.count(F.lit(1)) == n, F.lit(n)).alias("seen_before"))  # the old version, still there
    return tables.read_current(spark, path).join(F.broadcast(seen))


@query("K7_model_save")
def _(spark, d):
    from pyspark.ml import PipelineModel

    rows = labelled(spark, d)
    path = _fresh(spark, "model")
    health.train_forest(rows, ["a", "b"], "label", trees=10).save(path)
    return health.predict_forest(PipelineModel.load(path), rows, ["bad"]).select("doc_id", "pred_class")


@query("M3_group_cv")
def _(spark, d):
    return health.cross_validate(labelled(spark, d), ["a", "b"], "label", "source", folds=3, trees=10)


@query("M5_permutation_importance")
def _(spark, d):
    """20 dealings of each feature over the groups that were held out of the training, beside the forest's Gini importance."""
    rows = settle(health.held_out_groups(labelled(spark, d), "source"))
    model = health.train_forest(rows.where("not held_out"), ["a", "b"], "label", trees=100)
    return health.permutation_importance(model, rows.where("held_out").drop("held_out"), ["a", "b"], "label")


@query("M6_class_probabilities")
def _(spark, d):
    rows = labelled(spark, d)
    return health.predict_forest(health.train_forest(rows, ["a", "b"], "label", trees=10), rows, ["bad"]).select("doc_id", "p_bad", "p_good", "p_impaired")


@query("T1_resumed_load", "SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def _(spark, d):
    """A load that is run before and after more files come, and once more with nothing new: no row is lost or twice there."""
    e = T.table(spark, d, "events")
    source, out, done = _fresh(spark, "arrived"), _fresh(spark, "loaded"), _fresh(spark, "done")
    for k in (0, 1):
        tables.append(e.where(f"pmod(event_id, 2) = {k}"), source)
        events.incremental(spark, source, e.schema, out, done, lambda x: x.select("event_id", "event_type"))
    events.incremental(spark, source, e.schema, out, done, lambda x: x.select("event_id", "event_type"))
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("T1_chunks", "SELECT event_type, count(*)::BIGINT AS n, round(sum(value * 2), 6) AS total FROM events WHERE value IS NOT NULL GROUP BY 1")
def _(spark, d):
    """Extraction in chunks of 400: every third chunk fails at first and is tried again, every tenth fails in the whole
    first run; the second run extracts just what is missing, and every row lands once."""
    e = T.table(spark, d, "events").where("value is not null").select("event_id", "event_type", "value")
    out, kinds = _fresh(spark, "chunks"), "event_id long, event_type string, twice double"
    for run in (0, 1):
        chunks.resume(spark, e, _fetch(run), kinds, out, "event_id", pause=0.0)
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("twice"), 6).alias("total"))


def _fetch(run: int):
    calls: dict[int, int] = {}

    def fetch(pdf):
        k = int(pdf["chunk"].iloc[0])
        calls[k] = calls.get(k, 0) + 1
        if (k % 3 == 0 and calls[k] == 1) or (k % 10 == 9 and run == 0):
            raise OSError("no answer")
        return pdf.assign(twice=pdf["value"] * 2)

    return fetch


@query("M9_class_guard", "WITH g AS (SELECT source AS klass, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY 1) SELECT klass, n::BIGINT AS n, CASE WHEN count(*) OVER () < 2 THEN 'labels of two classes at least are needed' WHEN n < 5 THEN 'only ' || n || ' rows' ELSE '' END AS warning FROM g WHERE klass IS NOT NULL")
def _(spark, d):
    rows = T.table(spark, d, "documents").select("doc_id", "source").join(T.table(spark, d, "labels").where("toxic = 1"), "doc_id")
    return health.class_guard(rows, "source")


@query("F22_ramp", "SELECT event_id, round(2 + 6 * least(greatest(value / 100, 0), 1), 6)::DOUBLE AS weight FROM events")
def _(spark, d):
    return T.table(spark, d, "events").select("event_id", F.round(2 + 6 * S.clip(F.col("value") / 100, 0.0, 1.0), 6).alias("weight"))


@query("F23_crore", "SELECT c_custkey AS k, format('{:.2f}', round_even(round_even(c_acctbal * 1000, 0) / 1e7, 2)) || ' Cr' AS t FROM customer")
def _(spark, d):
    r = S.half_even_scaled(S.half_even_scaled(F.col("c_acctbal") * 1000) / 1e7, 2)
    return T.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.concat(S.fixed(r, 2), F.lit(" Cr")).alias("t"))


@query("F24_escape", "SELECT page_id, replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS u FROM pages")
def _(spark, d):
    u = F.col("url")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        u = F.replace(u, F.lit(a), F.lit(b))
    return T.table(spark, d, "pages").select("page_id", u.alias("u"))


@query("X1_projection")
def _(spark, d):
    s = T.spots(spark, d).select("id", (F.col("x") + 79.3).alias("lon"), (F.col("y") + 10.8).alias("lat"))
    e, n = geo.to_utm(F.col("lon"), F.col("lat"))
    s = s.select("id", "lon", "lat", e.alias("e"), n.alias("n"))
    lon, lat = geo.from_utm(F.col("e"), F.col("n"))
    return s.select("id", F.round("e", 3).alias("easting"), F.round("n", 3).alias("northing"), (F.abs(lon - F.col("lon")) + F.abs(lat - F.col("lat")) < 1e-9).alias("inverse"))


def _polylines(spark, d, scale: float = 1.0):
    pt = lambda i: F.struct((F.col("embedding")[i].cast("double") * scale).alias("x"), (F.col("embedding")[i + 1].cast("double") * scale).alias("y"))
    return T.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.array(pt(0), pt(2), pt(4)).alias("geom"))


_PL = "pl AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x0, embedding[2]::DOUBLE AS y0, embedding[3]::DOUBLE AS x1, embedding[4]::DOUBLE AS y1, embedding[5]::DOUBLE AS x2, embedding[6]::DOUBLE AS y2 FROM embeddings)"
_FOOT = "sqrt((x{a} + t{a} * (x{b} - x{a})) ** 2 + (y{a} + t{a} * (y{b} - y{a})) ** 2)"


@query("X3_line_measures", f"WITH {_PL}, t AS (SELECT *, least(1, greatest(0, -(x0 * (x1 - x0) + y0 * (y1 - y0)) / ((x1 - x0) ** 2 + (y1 - y0) ** 2))) AS t0, least(1, greatest(0, -(x1 * (x2 - x1) + y1 * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS t1 FROM pl) SELECT id, round(sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) + sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2), 8) AS length, round(least({_FOOT.format(a=0, b=1)}, {_FOOT.format(a=1, b=2)}), 8) AS distance FROM t")
def _(spark, d):
    return _polylines(spark, d).select("id", F.round(geo.length(F.col("geom")), 8).alias("length"), F.round(geo.line_distance(F.col("geom"), F.lit(0.0), F.lit(0.0)), 8).alias("distance"))


@query("X9_bounds", f"WITH {_PL} SELECT id, round((x0 + x1 + x2) / 3, 8) AS cx, least(x0, x1, x2) AS low, greatest(y0, y1, y2) AS high FROM pl")
def _(spark, d):
    xs, ys = F.transform("geom", lambda p: p["x"]), F.transform("geom", lambda p: p["y"])
    return _polylines(spark, d).select("id", F.round(F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / 3, 8).alias("cx"), F.array_min(xs).alias("low"), F.array_max(ys).alias("high"))


@query("G12_edge_split", f"WITH {_PL}, l AS (SELECT id, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) + sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS m FROM pl) SELECT id, round(m * 0.4, 6) AS length_m FROM l UNION ALL SELECT id, round(m * 0.6, 6) FROM l")
def _(spark, d):
    e = _polylines(spark, d).withColumn("length_m", geo.length(F.col("geom"))).withColumn("seg_id", F.col("id").cast("string"))
    e = settle(e.select("seg_id", "id", "length_m", "geom"))
    return lines.split_edges(e, e.select("seg_id", (F.col("length_m") * 0.4).alias("at_m"))).select("id", F.round("length_m", 6).alias("length_m"))


@query("X4_noding")
def _(spark, d):
    p = lines.node_lines(_polylines(spark, d, 20_000.0))
    return p.select("id", "piece", F.round(geo.length(F.col("geom")), 4).alias("length_m"))


@query("G3_attach")
def _(spark, d):
    pieces = lines.node_lines(_polylines(spark, d, 100_000.0))
    e, n = lines.build_segments(pieces)
    e = e.withColumn("is_river", F.lit(0)).withColumn("is_virtual", F.lit(0)).select("seg_id", "src", "dst", "length_m", "geom", "is_river", "is_virtual")
    e, n = lines.attach(e, n, 0.0, 0.0)
    return e.select("seg_id", "src", "dst", F.round("length_m", 4).alias("length_m"), "is_virtual")


@query("B7_work_plan")
def _(spark, d):
    """The greedy plan with its running total checked against the sum of its steps."""
    from pyspark.sql import Window

    p = QUERIES["B3_greedy_plan"](spark, d)
    w = Window.partitionBy("scenario").orderBy("work_order")
    return p.select("scenario", "work_order", "seg_id", "marginal_ha", "cumulative_ha", (F.abs(F.col("cumulative_ha") - F.sum("marginal_ha").over(w)) < 1e-2).alias("adds_up"))


@query("T7_stage_run")
def _(spark, d):
    """All stages of the analysis over the network, and again: the second run skips every one."""
    s = settle(scored_segments(spark, d).withColumns({"district": F.col("prj_name"), "can_name": F.when(F.col("seg_id") % 3 == 0, F.col("prj_name"))}).drop("health", "local_ha"))
    cells = T.local_area(spark, d).join(s.select("seg_id", "district", F.col("can_type").alias("crop_class")), "seg_id").withColumnRenamed("local_ha", "area_ha")
    eco = s.select("district").distinct().withColumn("revenue_per_ha", F.lit(1.0))
    inputs = {"segments": s, "sources": root(spark), "points": T.points(spark, d), "cells": settle(cells), "economics": eco, "multipliers": spark.createDataFrame([("PROMO", 1.5)], "can_type string, multiplier double")}
    run = stages.Runner(spark, _fresh(spark, "run"), stages.analysis(5e6))
    out = run(inputs)
    run(inputs)
    return spark.createDataFrame([(i, n, what, out[n].count()) for i, (n, what) in enumerate(run.done)], "i int, stage string, what string, n long")


