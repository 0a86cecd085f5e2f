"""Event streams: seasonal windows, sessions, deduplication, and a resumable incremental load.

The windows over ``events`` are extensions; the network model itself uses fixed seasons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def _timed(events: DataFrame, late: str) -> DataFrame:
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return e.withWatermark("ts", late) if e.isStreaming else e


def tumbling_counts(events: DataFrame, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    e = _timed(events, late)
    g = e.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    e = _timed(events, late)
    g = e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def deduplicated(events: DataFrame, late: str = "1 hour") -> DataFrame:
    return _timed(events, late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])


def run_once(stream: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Drives a stream over what is there now and returns the result as a batch."""
    w = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    q = (w.option("checkpointLocation", checkpoint) if checkpoint else w).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def incremental(spark: SparkSession, path: str, schema, out: str, checkpoint: str, extract) -> None:
    """Loads files that are new since the last run through ``extract`` and appends the result.

    The checkpoint is the done-set: a run that was cut off goes on with what it had not committed.
    """
    q = spark.readStream.schema(schema).parquet(path)
    q = extract(q).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
