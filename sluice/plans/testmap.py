"""The driver tables seen as a network: parts are segments of a binary tree, line items are points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import clip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seg_id, src, dst, length_m, can_type, prj_name, can_name: segment k runs from node (k + 1) // 2 to k + 1."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("seg_id"), F.shiftright(k + 1, 1).alias("src"), (k + 1).alias("dst"), (F.col("p_size") * 100).cast("double").alias("length_m"),
        F.col("p_type").alias("can_type"), F.col("p_brand").alias("prj_name"), F.col("p_name").alias("can_name"),
    )


def cross_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One more edge a supplier; with the tree they make an acyclic graph with parallel feeds."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select((-1 - s).alias("seg_id"), (3 * s + 1).alias("src"), (7 * s + 11).alias("dst"), F.lit(500.0).alias("length_m"))


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).select("seg_id", "src", "dst", "length_m").unionByName(cross_edges(spark, sf_dir))


def local_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("seg_id")).agg(F.sum("l_quantity").alias("local_ha"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seg_id, p_impaired, pred_class of every line item."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("seg_id"), clip(F.col("l_discount") * 10, 0.0, 1.0).alias("p_impaired"), F.concat("l_returnflag", "l_linestatus").alias("pred_class"))


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """district (nation), crop (market segment), area (quantity): the crop areas of districts."""
    li, o = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c, n = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(F.col("n_name").alias("district"), F.col("c_mktsegment").alias("crop"), F.col("l_quantity").alias("area"))


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, x, y, label: the first two components of the vectors as planar points."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"), "label")


# The same views in SQL.
SEG = "seg AS (SELECT p_partkey AS seg_id, (p_partkey + 1) // 2 AS src, p_partkey + 1 AS dst, CAST(p_size * 100 AS DOUBLE) AS length_m, p_type AS can_type, p_brand AS prj_name, p_name AS can_name FROM part)"
CROSS = "crs AS (SELECT -1 - s_suppkey AS seg_id, 3 * s_suppkey + 1 AS src, 7 * s_suppkey + 11 AS dst, 500.0::DOUBLE AS length_m FROM supplier)"
NET = f"{SEG}, {CROSS}, net AS (SELECT seg_id, src, dst, length_m FROM seg UNION ALL SELECT * FROM crs)"
LOCAL = "loc AS (SELECT l_partkey AS seg_id, sum(l_quantity) AS local_ha FROM lineitem GROUP BY 1)"
POINTS = "pt AS (SELECT l_partkey AS seg_id, least(greatest(l_discount * 10, 0.0), 1.0) AS p_impaired, l_returnflag || l_linestatus AS pred_class FROM lineitem)"
AREAS = "ar AS (SELECT n_name AS district, c_mktsegment AS crop, l_quantity AS area FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"
SPOTS = "sp AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, label FROM embeddings)"
