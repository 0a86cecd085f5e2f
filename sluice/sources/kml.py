"""Placemarks of KML files, through Spark's XML reader: one row a placemark, with its lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = (
    "name string, ExtendedData struct<SchemaData:struct<SimpleData:array<struct<_VALUE:string,_name:string>>>,Data:array<struct<_name:string,value:string>>>, "
    "LineString struct<coordinates:string>, MultiGeometry struct<LineString:array<struct<coordinates:string>>>"
)


def _points(text: Column) -> Column:
    """Coordinates "lon,lat[,alt] ..." as an array of (x, y)."""
    parts = F.filter(F.split(F.trim(text), r"\s+"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(F.split(p, ",")[0].cast("double").alias("x"), F.split(p, ",")[1].cast("double").alias("y")))


def read_kml(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """name, the asked attribute ``columns`` (strings), and geom: one row for each line of each placemark."""
    raw = spark.read.format("xml").option("rowTag", "Placemark").schema(_SCHEMA).load(path)
    simple = F.map_from_entries(F.transform(F.coalesce("ExtendedData.SchemaData.SimpleData", F.array().cast("array<struct<_VALUE:string,_name:string>>")), lambda s: F.struct(s["_name"], s["_VALUE"])))
    data = F.map_from_entries(F.transform(F.coalesce("ExtendedData.Data", F.array().cast("array<struct<_name:string,value:string>>")), lambda s: F.struct(s["_name"], s["value"])))
    lines = F.concat(
        F.coalesce(F.transform("MultiGeometry.LineString", lambda x: x["coordinates"]), F.array().cast("array<string>")),
        F.when(F.col("LineString.coordinates").isNotNull(), F.array("LineString.coordinates")).otherwise(F.array().cast("array<string>")),
    )
    rows = raw.select("name", simple.alias("s"), data.alias("d"), F.explode(lines).alias("line"))
    wanted = [F.coalesce(F.col("s")[c], F.col("d")[c]).alias(c) for c in columns or []]
    return rows.select("name", *wanted, _points(F.col("line")).alias("geom"))
