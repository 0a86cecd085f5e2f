"""Operator 11, sharding: minimax contiguous partition, in DataFrame functions only.

Law ``bytes``: documents of one text are an atomic group, groups stand in the order of a digest of their
text, and every shard is a run of neighbouring groups.  The smallest capacity that no shard exceeds is found
by binary search; a capacity is checked by filling shard after shard (greedy is exact for runs).  Within that
capacity the cuts are then made as near to equal shares of what is left as the shards to come allow.

A group that is alone larger than the mean of the shards still to fill can't be in a smaller shard than its
own size, and as everyone's capacity that size would leave shards empty: such groups (fewer than shards, so they
may be known to the driver) get a shard each, largest first, and the search goes on for the others.

The driver never holds the groups.  It knows *cells*, runs of groups whose digests share a prefix, by their
sum, their number and their largest group.  Where a filled shard ends inside a cell, its end is known to within that
largest group, so a capacity is surely enough, surely not, or open; the cells that open ends fall into are summed
again by longer prefixes until every end is a group's edge.  A round holds a few hundred cells of 64 parts each,
at every size of input.

A document's slot follows the digest of its id and text within its shard.  Rows that are equal in all of these are
counted before anything is shuffled by shard, and running counts are made of ranges, so no task sees a shard
or a repeated row as a whole.

Defined results.  Null text: no bytes, size 1, checksum 0, and a group of its own (apart from empty texts).  Null
doc_id: kept like any other.  Repeated rows: each gets a slot.  Fewer groups than shards: some shards stay
empty.  Empty table: no rows.  Columns other than doc_id and text are not read, unless ``write_shards`` writes them.
A group is known by 60 bits of the MD5 of its text: equal texts always meet; two others that met would only share
a shard.  A table of some 10^18 bytes or more would overflow sums of bytes.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import if_small, materialise
from .fair_mix import range_offsets

SHARDS = 16
#: Bits of a group's key, of the first cells, and by which a cell is split; groups that are fetched as they are.
KEY_BITS, FIRST_BITS, SPLIT_BITS, LEAVES = 60, 12, 6, 50_000
#: Rows that one range of slots is made for, and copies of one row that one task writes.
RANGE_ROWS, COPIES = 2000, 5000
SEED = "slot-1"


def group_key(text: Column) -> Column:
    """The first 60 bits of a text's MD5; -1 for null."""
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long"), F.lit(-1).cast("long"))


class Cell(NamedTuple):
    """A run of groups whose keys share all but the last ``KEY_BITS - bits`` bits."""

    prefix: int
    bits: int
    total: int
    biggest: int
    groups: int

    @property
    def low(self) -> int:
        return self.prefix << (KEY_BITS - self.bits)


class Cells:
    """Cells in order, and what they tell of the edges between groups."""

    def __init__(self, cells: list[Cell]):
        self.cells = sorted(cells, key=lambda c: c.low)
        self.starts, at = [], 0
        for c in self.cells:
            self.starts.append(at)
            at += c.total
        self.total = at
        self.open: set[Cell] = set()

    def cell(self, x: int) -> tuple[int, Cell]:
        i = bisect_right(self.starts, x) - 1
        return self.starts[i], self.cells[i]

    def below(self, x: int) -> tuple[int, int]:
        """Bounds of the last edge at or before ``x``; a cell that leaves it open is noted."""
        if x >= self.total:
            return self.total, self.total
        start, c = self.cell(x)
        if x == start or c.groups == 1:
            return start, start
        self.open.add(c)
        return max(start, x - c.biggest + 1), x

    def above(self, x: int) -> tuple[int, int]:
        """Bounds of the first edge at or after ``x``."""
        if x >= self.total:
            return self.total, self.total
        start, c = self.cell(x)
        if x == start:
            return x, x
        if c.groups == 1:
            return start + c.total, start + c.total
        self.open.add(c)
        return x, min(start + c.total, x + c.biggest - 1)

    def nearest(self, x: int) -> tuple[int, int]:
        """Bounds of the edge nearest to ``x``, the earlier one of two."""
        (a, b), (c, d) = self.below(x), self.above(x)
        if a == b and c == d:
            return (c, c) if c - x < x - a else (a, a)
        return a, d

    def filled(self, shards: int, capacity: int, side: int) -> int:
        """How far ``shards`` shards of this capacity reach at least (side 0) or at most (side 1)."""
        at = 0
        for _ in range(shards):
            at = self.below(at + capacity)[side]
        return at

    def least(self, shards: int, side: int) -> int:
        """The smallest capacity that surely (side 0) or maybe (side 1) holds all groups."""
        low, high = max(-(-self.total // shards), max(c.biggest for c in self.cells)), self.total
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.filled(shards, mid, side) >= self.total else (mid + 1, high)
        return low

    def between(self, shards: int, low: int, high: int) -> None:
        """Notes every open cell that a shard's end falls into for any capacity from ``low`` to ``high``."""
        self.open.clear()
        a = b = 0
        for _ in range(shards):
            x, y = a + low, b + high
            a, b = self.below(x)[0], self.below(y)[1]
            if x < self.total:
                first, last = bisect_right(self.starts, x) - 1, bisect_right(self.starts, min(y, self.total - 1)) - 1
                self.open.update(c for c in self.cells[first : last + 1] if c.groups > 1)

    def cuts(self, shards: int, capacity: int) -> list[tuple[int, int]]:
        """Bounds of the ends of all shards but the last, near to equal shares and within the capacity."""
        self.open.clear()
        least = [(self.total, self.total)]
        for _ in range(shards - 1):
            a, b = least[-1]
            least.append((self.above(max(0, a - capacity))[0], self.above(max(0, b - capacity))[1]))
        out, at = [], (0, 0)
        for j, need in zip(range(1, shards), reversed(least[1:]), strict=True):
            share = [self.nearest(p + (self.total - p) // (shards - j + 1))[side] for side, p in enumerate(at)]
            most = [self.below(p + capacity)[side] for side, p in enumerate(at)]
            at = tuple(max(need[s], min(share[s], most[s])) for s in (0, 1))
            out.append(at)
        return out


def smallest_cuts(root: Cell | None, shards: int, refine: Callable[[set[Cell]], list[Cell]]) -> tuple[int, list[int]]:
    """(capacity, the least key of each shard but the first).  ``refine`` gives the parts of cells."""
    if root is None:
        return 0, []
    cells = Cells(refine({root}))

    def split() -> Cells:
        gone = set(cells.open)
        return Cells([c for c in cells.cells if c not in gone] + refine(gone))

    while True:
        low, high = cells.least(shards, 1), cells.least(shards, 0)
        cells.between(shards, low, high)
        if not cells.open:
            break
        cells = split()
    while True:
        ends = cells.cuts(shards, low)
        if all(a == b for a, b in ends):
            break
        cells = split()
    return low, [cells.cell(a)[1].low if a < cells.total else 1 << KEY_BITS for a, _ in ends]


def cell_sums(groups: DataFrame, cells: set[Cell]) -> list[Cell]:
    """The parts of the cells, or their groups where these are few; LEAVES or 2^SPLIT_BITS rows a cell at most."""
    few = sum(c.groups for c in cells) <= LEAVES
    depths = sorted({c.bits for c in cells})

    def inside(bits: int) -> Column:
        return F.shiftright("key", KEY_BITS - bits).isin([c.prefix for c in cells if c.bits == bits])

    whole = depths == [0]
    step = FIRST_BITS if whole else SPLIT_BITS
    bits = reduce(lambda out, b: out.when(inside(b), F.lit(KEY_BITS if few else min(KEY_BITS, b + step))), depths[1:], F.when(F.lit(True) if whole else inside(depths[0]), F.lit(KEY_BITS if few else depths[0] + step)))
    part = groups.withColumn("bits", bits).where("bits is not null").withColumn("prefix", F.expr(f"shiftright(key, {KEY_BITS} - bits)"))
    sums = part.groupBy("prefix", "bits").agg(F.sum("size").alias("total"), F.max("size").alias("biggest"), F.count(F.lit(1)).alias("groups"))
    return [Cell(*r) for r in sums.select("prefix", "bits", "total", "biggest", "groups").collect()]


@dataclass
class Plan:
    """Which shard a group's key belongs to: keys with a shard of their own, and where the other shards begin."""

    shards: int
    alone: list[int] = field(default_factory=list)
    begins: list[int] = field(default_factory=list)
    capacity: int = 0

    def shard(self, key: Column) -> Column:
        first = len(self.alone)
        place = sum(((key >= F.lit(b)).cast("int") for b in self.begins), F.lit(first))
        return reduce(lambda out, ik: F.when(key == ik[1], F.lit(ik[0])).otherwise(out), enumerate(self.alone), place).cast("int")


def plan(groups: DataFrame, shards: int = SHARDS) -> Plan:
    """The minimax cuts of ``groups`` (key, size: one row a group) into ``shards`` runs."""
    total, number = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    alone: list[int] = []
    left = total
    for r in groups.orderBy(F.desc("size"), "key").limit(shards - 1).collect() if shards > 1 else []:
        if r["size"] * (shards - len(alone)) <= left:
            break
        alone.append(r["key"])
        left -= r["size"]
    rest = groups.where(~F.col("key").isin(alone)) if alone else groups
    number -= len(alone)
    root = Cell(0, 0, left, left, number) if number else None
    capacity, begins = smallest_cuts(root, shards - len(alone), lambda cells: cell_sums(rest, cells))
    return Plan(shards, alone, begins, capacity)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, key, n: rows that are equal in all of these are counted (n)."""
    text = F.col("text")
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), group_key(text).alias("key")
    )
    return rows.groupBy("doc_id", "size", "text_crc32", "key").agg(F.count(F.lit(1)).alias("n"))


def assign(docs: DataFrame, shards: int = SHARDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document; shards are numbered from 0."""
    rows = materialise(sized(docs), "shard-sizes", docs.count())
    groups = materialise(rows.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("size")), "shard-groups", number := rows.count())
    cut = plan(groups, shards)
    bits = max(0, min(31, (number // range_rows).bit_length()))
    order = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("n")), F.lit(":"), F.col("key").cast("string"), F.lit(f":{SEED}")))
    rows = rows.withColumn("shard", cut.shard(F.col("key"))).withColumn("order", order)
    rows = rows.withColumn("range", F.shiftright(F.conv(F.substring("order", 1, 8), 16, 10).cast("long"), 32 - bits))
    ranges = rows.groupBy(F.col("shard").alias("sk"), "range").agg(F.sum("n").alias("range_size"))
    offsets = materialise(range_offsets(materialise(ranges, "shard-ranges", number), bits // 2).withColumnRenamed("sk", "shard"), "shard-offsets", number)
    within = F.sum("n").over(Window.partitionBy("shard", "range").orderBy("order", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    placed = rows.withColumn("within", within).join(if_small(offsets, offsets.count()), ["shard", "range"]).withColumn("slot", F.col("offset") + F.col("within"))
    out = ["doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")]
    return copies(placed).select(*out)


def copies(placed: DataFrame, most: int = COPIES) -> DataFrame:
    """Each row n times, at the slots from its own on.  Rows with more copies than ``most`` are dealt out by runs first."""
    here = placed.where(F.col("n") <= most).withColumn("slot", F.explode(F.sequence("slot", F.col("slot") + F.col("n") - 1)))
    runs = placed.where(F.col("n") > most).withColumn("end", F.col("slot") + F.col("n") - 1).withColumn("slot", F.explode(F.sequence("slot", "end", F.lit(most).cast("long"))))
    runs = runs.repartition("shard", "slot").withColumn("slot", F.explode(F.sequence("slot", F.least("end", F.col("slot") + (most - 1)))))
    return here.unionByName(runs.drop("end"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> Plan:
    """Writes ``docs`` with all columns as Parquet, a folder ``shard=<number>`` each; equal texts share a folder.

    A row's shard follows from its text, so texts are not shuffled.  Returns the plan, which places later texts too.
    """
    groups = materialise(docs.select(group_key(F.col("text")).alias("key"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size")).groupBy("key").agg(F.sum("size").alias("size")), "shard-groups", docs.count())
    cut = plan(groups, shards)
    docs.withColumn("shard", cut.shard(group_key(F.col("text")))).write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return cut


ORACLE = rf"""
WITH RECURSIVE t AS (SELECT doc_id, text, octet_length(encode(coalesce(text, ''))) + 1 AS size, coalesce(CAST('0x' || substr(md5(text), 1, 15) AS BIGINT), -1) AS key FROM documents),
poly AS (SELECT list(c ORDER BY i) AS tbl FROM (SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c FROM (SELECT unnest(range(256)) AS i))),
u AS (SELECT DISTINCT text FROM t WHERE text <> ''),
crc AS (SELECT text, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT)), lambda a, b: xor(a >> 8, tbl[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS crc FROM u, poly),
g AS (SELECT key, sum(size)::BIGINT AS s FROM t GROUP BY 1),
o AS (SELECT *, row_number() OVER w AS i, (sum(s) OVER () - sum(s) OVER w + s)::BIGINT AS rest FROM g WINDOW w AS (ORDER BY s DESC, key ROWS UNBOUNDED PRECEDING)),
stop AS (SELECT coalesce(min(i), (SELECT count(*) + 1 FROM g)) AS i FROM o WHERE NOT (i < {SHARDS} AND s * ({SHARDS} + 1 - i) > rest)),
r AS (SELECT key, s, (sum(s) OVER (ORDER BY key) - s)::BIGINT AS before FROM o WHERE i >= (SELECT i FROM stop)),
p AS (SELECT list_prepend(0::BIGINT, list(before + s ORDER BY key)) AS ps, sum(s)::BIGINT AS total, max(s) AS big, ({SHARDS} + 1 - (SELECT i FROM stop))::BIGINT AS k FROM r),
bs(low, high) AS (SELECT greatest((total + k - 1) // k, big), total FROM p UNION ALL
  SELECT CASE WHEN ok THEN low ELSE mid + 1 END, CASE WHEN ok THEN mid ELSE high END FROM (SELECT low, high, mid, list_reduce(ps, lambda a, x: CASE WHEN x - a.start <= mid THEN {{'n': a.n, 'start': a.start, 'prev': x}} ELSE {{'n': a.n + 1, 'start': a.prev, 'prev': x}} END, {{'n': 1::BIGINT, 'start': 0::BIGINT, 'prev': 0::BIGINT}}).n <= k AS ok
  FROM (SELECT low, high, (low + high) // 2 AS mid FROM bs WHERE low < high), p)),
cap AS (SELECT low AS c FROM bs WHERE low = high),
le(j, e) AS (SELECT k, total FROM p UNION ALL SELECT j - 1, list_min(list_filter(ps, lambda x: x >= e - c)) FROM le, p, cap WHERE j > 1),
cu(j, e) AS (SELECT 0::BIGINT, 0::BIGINT UNION ALL SELECT j, greatest(need, least(CASE WHEN up - t < t - down THEN up ELSE down END, most)) FROM (
  SELECT cu.j + 1 AS j, le.e AS need, t, list_max(list_filter(ps, lambda x: x <= t)) AS down, list_min(list_filter(ps, lambda x: x >= t)) AS up, list_max(list_filter(ps, lambda x: x <= b + c)) AS most
  FROM (SELECT j, e AS b, e + (total - e) // (k - j) AS t FROM cu, p WHERE j < k - 1) cu JOIN le ON le.j = cu.j + 1, p, cap)),
sh AS (SELECT key, ((SELECT i FROM stop) - 1 + (SELECT count(*) FROM cu WHERE cu.j > 0 AND cu.e <= before))::INT AS shard FROM r UNION ALL SELECT key, (i - 1)::INT FROM o WHERE i < (SELECT i FROM stop))
SELECT doc_id, size::BIGINT AS size, coalesce(crc, 0)::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), 'n') || ':' || key || ':{SEED}'), doc_id, size) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM t JOIN sh USING (key) LEFT JOIN crc USING (text)
"""
