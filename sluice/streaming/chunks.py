"""Extraction in chunks: each is tried a few times, lands once, and a later run goes on with what is missing."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..state import ranked, settle
from . import labels

SIZE, ATTEMPTS, PAUSE = 400, 3, 20.0


def chunked(points: DataFrame, *order: str, size: int = SIZE) -> DataFrame:
    """``points`` with chunk: runs of ``size`` rows in an order, numbered from 0; no task sees all rows."""
    return ranked(points, "_no", *order).withColumn("chunk", F.floor((F.col("_no") - 1) / size).cast("long")).drop("_no")


def extract(points: DataFrame, fetch: Callable[[pd.DataFrame], pd.DataFrame], kinds: str, key: str, attempts: int = ATTEMPTS, pause: float = PAUSE) -> DataFrame:
    """chunk, attempts, error, rows (of ``kinds``): one row a chunk of ``points`` (with column chunk).

    ``fetch`` turns a chunk into rows and may raise; it is called again, after a longer pause each time, up to
    ``attempts`` times.  A chunk that fails every time has its error and no rows; the others are not held up.
    """
    schema = StructType.fromDDL(kinds)
    names = schema.fieldNames()

    def run(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        import time

        error = None
        for n in range(1, attempts + 1):
            try:
                rows = fetch(pdf.sort_values(key))[names]
                return pd.DataFrame({"chunk": [k[0]], "attempts": [n], "error": [None], "rows": [rows.to_dict("records")]})
            except Exception as e:  # noqa: BLE001 - whatever a fetch raises is an attempt that failed
                error = f"{type(e).__name__}: {e}"
                if n < attempts:
                    time.sleep(pause * n)
        return pd.DataFrame({"chunk": [k[0]], "attempts": [attempts], "error": [error], "rows": [[]]})

    return points.groupBy("chunk").applyInPandas(run, f"chunk long, attempts int, error string, rows array<{schema.simpleString()}>")


def resume(spark: SparkSession, points: DataFrame, fetch: Callable[[pd.DataFrame], pd.DataFrame], kinds: str, out: str, key: str, size: int = SIZE, attempts: int = ATTEMPTS, pause: float = PAUSE) -> DataFrame:
    """Extracts the points whose key ``out`` does not have yet and appends their rows; chunk, attempts, error of the run.

    Rows are appended in one job after all chunks have ended, so a run that is cut off leaves none of its rows, and
    one with failed chunks leaves the others'; either is resumed by calling this again.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    todo = labels.resume(points, spark.read.parquet(out).select(key), [key]) if there else points
    done = settle(extract(chunked(todo, key, size=size), fetch, kinds, key, attempts, pause))
    done.select(F.explode("rows").alias("r")).select("r.*").write.mode("append").parquet(out)
    return done.select("chunk", "attempts", "error")
