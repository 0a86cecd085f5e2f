"""Aggregates and window expressions with fixed tie and null rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..state import settle


def quantile(x: Column, q: float) -> Column:
    """Exact quantile by linear interpolation."""
    return F.percentile(x, F.lit(q))


def smallest_mode(x: Column) -> Column:
    """Most frequent value, the smallest of tied ones."""
    return F.mode(x, True)


def average_rank(df: DataFrame, column: str, out: str, by: list[str] | None = None) -> DataFrame:
    """Adds the fractional rank of ``column``, tied values sharing their mean rank; null stays null.

    The number of rows below a value comes from a count by value and a window over the distinct values,
    so rows are not sorted one by one in a single task.
    """
    by = by or []
    per = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*(by or [F.lit(0)]))
    ranked = per.select(*by, F.col(column).alias("_v"), ((F.sum("_n").over(w.orderBy(column)) - (F.col("_n") - 1) / 2.0) / F.sum("_n").over(w)).alias(out))
    on = F.col(column) == F.col("_v")
    for b in by:
        on = on & df[b].eqNullSafe(ranked[b])
    return df.join(ranked, on, "left").select(*[df[c] for c in df.columns], out)


def quartile_bins(df: DataFrame, column: str, out: str, parts: int = 4) -> DataFrame:
    """Adds the quantile bin of ``column``: right-closed, the least value in the first bin, equal edges merged."""
    edges = df.agg(F.array_distinct(F.percentile(column, F.array(*[F.lit(i / parts) for i in range(parts + 1)]))).alias("_edges"))
    inner = F.filter(F.slice(F.col("_edges"), 2, F.greatest(F.size("_edges") - 2, F.lit(0))), lambda e: e < F.col(column))
    # the edges are one row
    return df.join(F.broadcast(edges)).withColumn(out, F.when(F.col(column).isNotNull(), F.size(inner).cast("long"))).drop("_edges")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_share(df: DataFrame, keys: list[str], name: str, value: str, k: int = 3) -> DataFrame:
    """keys, mix: the k largest shares of a key as text such as "Rice 76%; Maize 7%"."""
    w = Window.partitionBy(*keys)
    s = df.withColumn("_s", F.col(value) / F.sum(value).over(w)).withColumn("_rn", F.row_number().over(w.orderBy(F.desc("_s"), F.asc(name)))).where(F.col("_rn") <= k)
    text = F.concat(F.col(name), F.lit(" "), F.bround(F.col("_s") * 100, 0).cast("int").cast("string"), F.lit("%"))
    return s.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", text.alias("t")))), lambda x: x["t"]), "; ").alias("mix"))


def running(df: DataFrame, name: str, value: str, *order: Column | str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before each, in a total order: rows are dealt by range, ranges are
    summed, and a row's sum is its range's start plus the sum within the range, so no task sees the whole table."""
    dealt = settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sums = sorted((r["_range"], r["s"]) for r in dealt.groupBy("_range").agg(F.sum(value).alias("s")).collect())  # a row a partition
    starts, at = [], 0
    for r, s in sums:
        starts.append((r, at))
        at += s or 0
    kind = df.schema[value].dataType.simpleString()
    starts = df.sparkSession.createDataFrame(starts, f"_range int, _start {kind}")
    before = F.coalesce(F.sum(value).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.withColumn("_before", before).join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + F.col("_before")).drop("_range", "_start", "_before")
