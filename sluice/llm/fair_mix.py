"""Operator 9, mixing sources to target weights: weighted fair queueing, in DataFrame functions only.

Sources, sorted by code point with null last, weigh 1, 2, 3, repeating, and share the total of all
sizes; a target stops at three times its source's size and what is over is shared again by weight.
Every source's documents are shuffled by a digest of their id.  The copy e of a document (0, 1, 2) gets
the virtual finish time (e * source size + running size) / target, the copies of all sources are sorted
by it, and the mix is the longest prefix whose size is within the total.

Running sums never need one task to see a whole source or the whole corpus: documents fall into ranges
of the sort key, ranges are summed first, and a document's running sum is its range's offset plus the
running sum within the range.  The number of ranges follows the number of documents, and ranges are summed
by groups in the same way, so a task sees no more of a source's ranges than their root.  The end of the mix
is found by summing copies into ``SLICES`` slices of finish time, and again within the slice that holds
the end, until that has no more than ``LAST_COPIES`` copies, which are then sorted.

Defined results.  Null text: size 0.  A document of size 0 is in the mix for no words (taken 0).  Null
doc_id: sorted by a digest of the text.  Rows of one doc_id and size are ordered by a hash of their texts, so
reruns take the same ones.  Repeated rows: each is a document of its own.  Empty table: no rows.  Columns
other than doc_id, text and source are not read.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import TEXT_ROWS, WORD, if_small, materialise, text_rows

#: Times that a document may be in the mix, and with it the most that a source's target is of its size.
REPEATS = 3
#: Documents that one range of the sort key is made for.
RANGE_ROWS = 2000
#: Slices of finish time that are summed at once, and copies that are sorted in one task in the end.
SLICES = 4096
LAST_COPIES = 100_000
CYCLE = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, cycle: int = CYCLE, repeats: int = REPEATS) -> DataFrame:
    """sk, place, source_size, target: one row a source.

    With every source capped whose cap over weight is below the level, the level is what is left of the
    total over the weight that is left; the first source, by cap over weight, that stays below its cap
    fixes it.
    """
    per = sized.groupBy("sk", "source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("place", F.row_number().over(order)).withColumn("weight", F.pmod(F.col("place") - 1, F.lit(cycle)) + 1)
    per = per.withColumn("cap", F.col("source_size") * repeats).withColumn("ratio", F.col("cap") / F.col("weight"))
    up = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(F.lit(0))
    per = per.select(
        "*",
        F.coalesce(F.sum("cap").over(up), F.lit(0)).alias("capped"),
        (F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(up), F.lit(0))).alias("open_weight"),
        F.sum("source_size").over(all_).alias("total"),
    ).withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_weight"))
    per = per.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(all_)["level"])
    return per.select("sk", "place", "source_size", F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.col("cap").cast("double")).alias("target"))


def range_offsets(ranges: DataFrame, low_bits: int) -> DataFrame:
    """sk, range, offset: the sizes of the source's ranges before this one.

    2^low_bits neighbouring ranges are a group: groups are summed first, then ranges within their group.
    """
    ranges = ranges.withColumn("group", F.shiftright("range", low_bits))
    groups = ranges.groupBy("sk", "group").agg(F.sum("range_size").alias("group_size"))

    def before(size: str, order: str, *by: str) -> Column:
        return F.coalesce(F.sum(size).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    groups = groups.select("sk", "group", before("group_size", "group", "sk").alias("base"))
    inner = ranges.withColumn("inner", before("range_size", "range", "sk", "group"))
    return inner.join(groups, ["sk", "group"]).select("sk", "range", (F.col("base") + F.col("inner")).alias("offset"))


def mix(docs: DataFrame, cycle: int = CYCLE, repeats: int = REPEATS, seed: str = SEED, range_rows: int = RANGE_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the columns of ``keep``: every document of ``docs``.

    ``taken`` is the document's size times the number of its copies in the mix.
    """
    row = F.struct(*keep).alias("row") if keep else F.lit(0).alias("row")
    sized = docs.select(
        "doc_id", "source", row, word_count(F.col("text")).alias("size"),
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), "source")).alias("sk"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("n"), F.md5(F.coalesce("text", F.lit(""))))), F.lit(f":{seed}"))).alias("key"),
        F.xxhash64("text").alias("tie"),
    )
    sized = materialise(sized, "sized", text_rows(docs), TEXT_ROWS)
    n = sized.count()
    bits = max(0, min(31, (n // range_rows).bit_length()))
    sized = sized.withColumn("range", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), 32 - bits))
    targets = materialise(source_targets(sized, cycle, repeats), "targets", n)
    ranges = sized.groupBy("sk", "range").agg(F.sum("size").alias("range_size"))
    ranges = range_offsets(materialise(ranges, "range-sizes", n), bits // 2)
    ranges = materialise(ranges.join(targets, "sk"), "ranges", n)
    inside = Window.partitionBy("sk", "range").orderBy("key", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    timed = sized.withColumn("within", F.sum("size").over(inside)).join(if_small(ranges, ranges.count()), ["sk", "range"])
    timed = materialise(timed.select("doc_id", "row", "size", "source_size", "target", "place", "key", "tie", (F.col("offset") + F.col("within")).alias("running")), "timed", n, TEXT_ROWS)

    def finish(e: int | Column) -> Column:
        return F.try_divide((F.lit(e) * F.col("source_size") + F.col("running")).cast("double"), F.col("target"))

    order = ["finish", "place", "key", "doc_id", "size", "tie", "e"]
    copies = timed.where("size > 0").select("place", "key", "doc_id", "size", "tie", F.posexplode(F.array(*[finish(e) for e in range(repeats)])).alias("e", "finish"))
    left = timed.agg(F.sum("size")).first()[0] or 0
    low, width = 0.0, 8.0 / SLICES
    cuts: list[tuple[float, float, int]] = []

    def slice_of(f: Column, low: float, width: float) -> Column:
        return F.least(F.floor((f - low) / width), F.lit(SLICES - 1))

    while True:
        sums = copies.groupBy(slice_of(F.col("finish"), low, width).alias("slice")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).orderBy("slice").collect()  # SLICES rows at most
        at = next((r for r, reach in zip(sums, accumulate(r["size"] for r in sums), strict=True) if reach > left), None)
        if at is None:
            break
        left -= sum(r["size"] for r in sums if r["slice"] < at["slice"])
        cuts.append((low, width, at["slice"]))
        copies = copies.where(slice_of(F.col("finish"), low, width) == at["slice"])
        if at["n"] <= LAST_COPIES or at["slice"] == SLICES - 1 or width < 1e-12:
            break
        low, width = low + at["slice"] * width, width / SLICES
    last = None
    if at is not None:
        reach = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        last = copies.withColumn("reach", reach).where(F.col("reach") <= left).orderBy(F.col("reach").desc(), *[F.col(c).desc() for c in order]).select(*order).first()

    def inside_mix(e: int) -> Column:
        if not cuts:
            return F.lit(True)
        f = finish(e)
        ok = F.lit(at is None)
        if last is not None:
            mine = F.struct(f, "place", "key", F.coalesce("doc_id", F.lit(-(1 << 63))), "size", "tie", F.lit(e))
            none = -(1 << 63)
            end = F.struct(F.lit(last["finish"]), F.lit(last["place"]), F.lit(last["key"]), F.lit(none if last["doc_id"] is None else last["doc_id"]).cast("long"), F.lit(last["size"]).cast("long"), F.lit(last["tie"]).cast("long"), F.lit(last["e"]))
            ok = mine <= end
        for low, width, k in reversed(cuts):
            s = slice_of(f, low, width)
            ok = (s < k) | ((s == k) & ok)
        return F.coalesce(ok, F.lit(False))

    times = sum((inside_mix(e).cast("long") for e in range(1, repeats)), inside_mix(0).cast("long"))
    extra = [F.col(f"row.{c}").alias(c) for c in keep]
    return timed.select(F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", (F.col("size") * times).alias("taken"), *extra)


ORACLE = f"""
WITH d AS (SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), 'n' || md5(coalesce(text, ''))) || ':{SEED}') AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, (place - 1) % {CYCLE} + 1 AS weight, source_size * {REPEATS} AS cap FROM s),
r AS (SELECT *, CAST(cap AS DOUBLE) / weight AS ratio FROM w),
l AS (SELECT *, coalesce(sum(cap) OVER up, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER up, 0) AS open_weight, sum(source_size) OVER () AS total
  FROM r WINDOW up AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, CAST(total - capped AS DOUBLE) / CAST(open_weight AS DOUBLE) AS lv FROM l),
lvl AS (SELECT arg_min(lv, (ratio, place)) AS level FROM v WHERE lv <= ratio),
t AS (SELECT source, place, source_size, total, coalesce(least(CAST(cap AS DOUBLE), level * weight), CAST(cap AS DOUBLE)) AS target FROM v, lvl),
run AS (SELECT d.doc_id, d.key, d.size, t.*, sum(d.size) OVER (PARTITION BY t.place ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS running
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT run.*, e, CAST(e * source_size + running AS DOUBLE) / target AS finish FROM run, (SELECT unnest(range({REPEATS})) AS e) WHERE size > 0),
m AS (SELECT *, sum(size) OVER (ORDER BY finish, place, key, doc_id, size, e ROWS UNBOUNDED PRECEDING) AS reach FROM c),
k AS (SELECT doc_id, key, place, sum(size) AS taken FROM m WHERE reach <= total GROUP BY doc_id, key, place)
SELECT run.doc_id, run.size, run.source_size, run.target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM run LEFT JOIN k ON run.doc_id IS NOT DISTINCT FROM k.doc_id AND run.place = k.place
"""
