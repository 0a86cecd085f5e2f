"""What the corpus operators share: tables, the shared folder, materialised steps, safe broadcasts."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is sent to every executor only if it has been counted and has no more rows than this.
BROADCAST_ROWS = 500_000
#: Short rows, and texts, that one task writes into one file where there are many small partitions.
TASK_ROWS = 250_000
TEXT_ROWS = 8_000
#: Bytes of text that one task takes at most where small partitions are merged.
TEXT_BYTES = 64 << 20
#: Rows of one Arrow batch of texts.
BATCH_ROWS = 1_000
_made: set[str] = set()
_own: dict[str, str] = {}

#: The words of a text: whatever stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a temporary one where that is unset and
    the master is local.  A cluster without that setting is refused: its machines share no temporary folder."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="sluice-")
        _made.add(_own[app])
    return _own[app]


def materialise(df: DataFrame, name: str, rows: int | None = None, per: int = TASK_ROWS) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage with files that outlive any executor, and frees the result of its partitioning,
    so that a later join has a fresh exchange on either side, which AQE can split where a key is hot.
    If ``rows`` is given, a bound on the rows that the table is made from, a task makes its share of ``per`` of
    them (``TASK_ROWS`` short ones, ``TEXT_ROWS`` texts, weighed by ``text_weight``), so that hundreds of small partitions don't become as
    many small files.  Partitions that hold more than that stay as they are.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    if rows is not None:
        df = merged_partitions(df, rows, per)
    # nothing looks for a marker of success in these folders: a write that fails raises an error here
    df.write.option("compression", "zstd").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merged_partitions(df: DataFrame, rows: int, per: int) -> DataFrame:
    """``df`` in no more partitions than ``rows`` needs at ``per`` rows each; no row is shuffled for it."""
    return df.coalesce(max(1, -(-rows // per)))


def text_weight(rows: int, size: int) -> int:
    """``rows``, or more where their ``size`` in bytes is more than TEXT_BYTES for every TEXT_ROWS of them: what
    ``merged_partitions`` takes as rows of texts."""
    return max(rows, -(-size * TEXT_ROWS // TEXT_BYTES))


def text_rows(docs: DataFrame, column: str = "text") -> int:
    """``text_weight`` of ``docs``, by one partial aggregate."""
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(column).cast("long"))).first()
    return text_weight(int(rows), int(size or 0))


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for a new table in the shared folder, which is deleted with the others in the end."""
    path = f"{shared_dir(spark)}/sluice/{name}-{uuid.uuid4().hex}"
    _made.add(path)
    return path


def clear(spark: SparkSession) -> None:
    """Deletes every table that ``materialise`` has written; frames built on them can't be read any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in list(_made):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        _made.discard(path)
    _own.clear()


@atexit.register
def _at_exit() -> None:
    try:
        if (spark := SparkSession.getActiveSession()) is not None:
            clear(spark)
    except Exception:  # noqa: BLE001 - the JVM may be gone already
        pass


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Holds Arrow batches of texts to ``rows`` rows, so a worker's memory does not follow the default of
    10,000; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


_owner = ""
_caches: list = []


def worker_cache(clear) -> None:
    """Registers how to empty a table that a Python worker keeps between tasks."""
    _caches.append(clear)


def take_worker(owner: str) -> None:
    """Called where a worker starts a task of an operator: what the worker kept for another one is dropped,
    and free memory goes back to the system, so operators that follow each other don't add up."""
    global _owner
    if _owner == owner:
        return
    _owner = owner
    for clear in _caches:
        clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def if_small(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are within the bound; else Spark shuffles it."""
    return F.broadcast(df) if rows <= most else df


def null_safe(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[k])
    return on
