"""Files with declared schemas: CSV, Parquet, JSON; nothing is inferred."""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import known
from ..state import fresh

# The schemas of the input and result tables.
SCHEMAS = {
    "crop_production": "District string, Year int, Crop string, Season string, Area_ha double",
    "crop_water": "Crop string, Type string, Water_min_mm double, Water_max_mm double, Duration_min_d int, Duration_max_d int, Water_source string",
    "rainfall": "District string, Actual_mm double, Normal_mm double, Dev_pct double",
    "segment_district": "seg_id string, district string",
    "label_queue": "point_id string, seg_id string, lat double, lon double, can_type string, prj_name string",
    "labels": "point_id string, seg_id string, label string, lat double, lon double",
    "segment_health": "seg_id string, n_points long, mean_p_impaired double, p75_p_impaired double, worst_p_impaired double, health_score double, health_score_worst_reach double, dominant_class string, method string",
    "budget": "metric string, value double",
}


def clean_numbers(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column, once, where data come in."""
    return df.withColumns({f.name: known(F.col(f.name)) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return clean_numbers(spark.read.schema(schema).option("header", "true").option("nanValue", "NaN").csv(path))


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``, or an empty one of that schema where there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_labels(spark: SparkSession, path: str, columns: tuple[str, ...] = ("point_id", "seg_id", "label", "lat", "lon")) -> DataFrame:
    """A label file whose header may be shorter than its rows: rows are read by position, bad numbers become
    null, and rows with another number of fields or without an id are left out."""
    raw = spark.read.text(path).select(F.split("value", ",").alias("f")).where(F.size("f") == len(columns))
    rows = raw.where(F.col("f")[0] != columns[0])
    cols = [F.trim(F.col("f")[i]).alias(c) for i, c in enumerate(columns)]
    return rows.select(*cols).where("point_id <> ''").withColumns({c: F.col(c).try_cast("double") for c in columns if c in ("lat", "lon")})


def csv_round_trip(df: DataFrame) -> DataFrame:
    """``df`` written as CSV with a header and read again under its own schema."""
    path = fresh(df.sparkSession, "csv")
    df.write.mode("overwrite").option("header", "true").csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", "true").csv(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


CURRENT = "CURRENT"


def _files(spark: SparkSession, path: str):
    """(file context, a Hadoop path maker) of the store that holds ``path``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return hadoop.FileContext.getFileContext(at.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()), hadoop.Path


def replace(df: DataFrame, path: str, attempts: int = 3, keep: int = 2) -> str:
    """Replaces a table in one step: returns the version that ``read_current`` reads from now on.

    The rows are written to a folder of their own, with ``attempts`` tries; only when all are there does a pointer
    file, renamed over the old one, name that folder.  Until then, and if the write fails, readers have the old
    version; the last ``keep`` versions stay for those that are still reading.
    """
    spark = df.sparkSession
    files, at = _files(spark, path)
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for k in range(attempts):
        try:
            df.write.mode("overwrite").parquet(f"{path}/{version}")
            break
        except Exception:
            if k == attempts - 1:
                files.delete(at(f"{path}/{version}"), True)
                raise
    note = f"{path}/.{version}"
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.text(note)
    part = next(x for x in files.util().listStatus(at(note)) if x.getPath().getName().startswith("part-")).getPath()
    how = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    over = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    over[0] = spark._jvm.java.lang.Enum.valueOf(how, "OVERWRITE")
    files.rename(part, at(f"{path}/{CURRENT}"), over)
    files.delete(at(note), True)
    for old in versions(spark, path)[:-keep]:
        files.delete(at(f"{path}/{old}"), True)
    return version


def versions(spark: SparkSession, path: str) -> list[str]:
    """The versions of a replaced table that are still there, oldest first."""
    files, at = _files(spark, path)
    return sorted(x.getPath().getName() for x in files.util().listStatus(at(path)) if re.fullmatch(r"v\d{20}-\w{8}", x.getPath().getName()))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The version of a replaced table that its pointer names; it stays the same for this frame."""
    name = spark.read.text(f"{path}/{CURRENT}").first()[0]
    return spark.read.parquet(f"{path}/{name}")


def read_polygons(spark: SparkSession, path: str, name: str) -> DataFrame:
    """name, ring of the polygons in GeoJSON feature collections: outer rings, a row for each part of a
    multi-polygon; ``name`` is the property that names a feature."""
    ring = "array<array<double>>"
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    f = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.explode("features").alias("f"))
    f = f.select(F.col("f.properties")[name].alias("name"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("at"))
    one = F.array(F.from_json("at", f"array<{ring}>")[0])
    parts = F.transform(F.from_json("at", f"array<array<{ring}>>"), lambda p: p[0])
    rings = f.where(F.col("kind").isin("Polygon", "MultiPolygon")).select("name", F.explode(F.when(F.col("kind") == "Polygon", one).otherwise(parts)).alias("ring"))
    return rings.select("name", F.transform("ring", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("ring"))


def save_network(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    """Edges (with geom, kept as well-known binary) and nodes (level, component, is_source) as two tables."""
    from .grids import to_wkb

    overwrite(edges.withColumn("wkb", to_wkb("geom")).drop("geom"), f"{path}/edges")
    overwrite(nodes, f"{path}/nodes")


def load_network(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    from .grids import from_wkb

    edges = spark.read.parquet(f"{path}/edges")
    return edges.withColumn("geom", from_wkb("wkb")).drop("wkb"), spark.read.parquet(f"{path}/nodes")


def overpass_ways(spark: SparkSession, path: str) -> DataFrame:
    """osm_id, name, waterway, geom of the ways with two points or more in Overpass JSON files."""
    schema = "elements array<struct<type:string,id:long,tags:map<string,string>,geometry:array<struct<lat:double,lon:double>>>>"
    e = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.explode("elements").alias("e")).where("e.type = 'way' and size(e.geometry) >= 2")
    geom = F.transform("e.geometry", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))
    return e.select(F.col("e.id").alias("osm_id"), F.coalesce(F.col("e.tags")["name"], F.lit("")).alias("name"), F.col("e.tags")["waterway"].alias("waterway"), geom.alias("geom"))
