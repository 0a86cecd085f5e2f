"""Where iterative plans cut their lineage: tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_shipped: set[str] = set()
_made: set[str] = set()
#: A side of a join is sent to every executor only if it has been counted and has no more rows than this.
BROADCAST_ROWS = 500_000
#: While a table is settled, a side of a join goes through the driver by its size alone up to so many bytes.
BROADCAST_BYTES = 256 << 10
_AUTO = "spark.sql.autoBroadcastJoinThreshold"


def session(name: str = "sluice", **conf: str) -> SparkSession:
    """A session with the settings the library is written for; cluster settings are left alone."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends the library to Python workers that could not import it: once an application, as a zip file
    that the driver serves.  Nothing is sent where PYTHONPATH has the library for the JVM that starts them."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    app = spark.sparkContext.applicationId
    if app in _shipped or root in (spark._jvm.System.getenv("PYTHONPATH") or "").split(os.pathsep):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="sluice-ship-"), "sluice.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "sluice")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
        for n in os.listdir(root):  # modules at the top that have functions for workers
            if n.endswith("_pipeline.py"):
                z.write(os.path.join(root, n), n)
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder where that is unset and the master is local: the machines of
    a cluster share no temporary folder."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="sluice-state-")
        _made.add(_own[app])
    return _own[app]


def fresh(spark: SparkSession, name: str = "table") -> str:
    """A path for a new table in the shared folder, deleted when the driver's Python ends."""
    path = f"{shared_dir(spark)}/sluice-state/{name}-{uuid.uuid4().hex}"
    _made.add(path)
    return path


def settle(df: DataFrame) -> DataFrame:
    """``df`` written out and read again: a loop's plan stays short, and a lost executor loses nothing.

    Its joins shuffle sides of more than ``BROADCAST_BYTES`` that have no hint: loops have hundreds of joins, and each
    broadcast passes the driver, so all together they would send it many times the tables."""
    spark = df.sparkSession
    path = fresh(spark)
    with _few_broadcasts(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _few_broadcasts(spark: SparkSession):
    was = spark.conf.get(_AUTO)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(was)
    if size <= BROADCAST_BYTES:  # -1: none at all
        yield
        return
    spark.conf.set(_AUTO, str(BROADCAST_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_AUTO, was)


def settle_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``settle`` with the number of rows, which is counted while they are written."""
    seen = Observation()
    out = settle(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return out, seen.get["rows"]


def clear(spark: SparkSession) -> None:
    """Deletes what ``settle`` and ``fresh`` have made; frames built on it can't be read any more."""
    for path in list(_made):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        _made.discard(path)


@atexit.register
def _at_exit() -> None:
    try:
        if (spark := SparkSession.getActiveSession()) is not None:
            clear(spark)
    except Exception:  # noqa: BLE001 - the JVM may be gone already
        pass


def ranked(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """``df`` with the place (from 1) of each row in an order: rows are dealt by range, counted, and numbered
    within their range, so no task sees the whole table.  The order must be total for reruns to agree."""
    dealt = settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = sorted((r["_range"], r["count"]) for r in dealt.groupBy("_range").count().collect())  # a row a partition
    starts = [(r, sum(n for q, n in sizes if q < r)) for r, _ in sizes]
    starts = df.sparkSession.createDataFrame(starts, "_range int, _start long")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_place", place).join(F.broadcast(starts), "_range").withColumn(name, (F.col("_start") + F.col("_place")).cast("long")).drop("_range", "_start", "_place")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt to all cores by a hash of these columns, for steps whose work outgrows the bytes they read:
    partitions that follow bytes alone would give a small table to one task."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *by)


def if_small(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has no more than ``most`` rows; counted here unless told."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= most else df
