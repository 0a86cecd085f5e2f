"""Operator 1, approximate nearest neighbours: stable projections indexed by kd-tree.

Largest inner product becomes least distance by one more axis, sqrt(M^2 - |x|^2), which is 0 for a query.
All vectors are projected to ``DIM`` axes by 2-stable (Gaussian) projections; the squared projected
distance of a pair is its squared distance times a chi-square variable of DIM degrees.  The directions are
made orthogonal where vectors have as many components, which keeps that mean and narrows the spread, so the
test errs less often than it says.  A kd-tree over
the projections, fitted on a bounded sample, deals every row to a leaf.  Rows of a leaf beyond
``BLOCK_ROWS`` are dealt over several blocks, so a vector that very many rows share is spread out.

A query first searches its own leaf, then every other leaf whose box may hold a better neighbour.  Within a
block, the points of the boxes that are near enough are taken in the order of their own projected distance, a
few at a time, and verified on the original vectors until the chi-square test holds: given the distance d of
the k-th best so far, a closer vector would lie within projected distance d * sqrt(chi2^-1(CONFIDENCE)) with
that confidence, and all that is left is farther.  A true neighbour is lost with a chance of 1 - CONFIDENCE at
most, whatever the number of rows.  Boxes leave out leaves where vectors lie in groups; on vectors without
structure no box of any index does, and it is the test by points that leaves out over half of them.

Defined results.  Vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, as query or as candidate, nor do rows without vec_id.  A query's candidates are
all rows of another vec_id.  Ties go to the smaller vec_id; repeated rows of one vec_id count once, by their
least vector.  Of lengths that are equally common the longer one counts.  Empty table: no rows.  Other columns
are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import if_small, materialise

NEAREST = 20
DIM = 32
CONFIDENCE = 0.90
SAMPLE = 20_000
#: Rows of a leaf: this many, more where there would be over MANY_LEAVES of them, and BLOCK_ROWS at most.  A query that no box
#: holds off is sent to every leaf, so what is sent grows with queries and leaves, and leaves are as large as a task can hold.
LEAF_ROWS = 2048
MANY_LEAVES = 64
BLOCK_ROWS = 16384
#: Rows (a query and a leaf) that a task routes at a time.
ROUTED_ROWS = 8192
#: Leaves of the tree, which the driver holds: beyond them, a leaf has more blocks.
MOST_LEAVES = 4096
BUCKET = 128
#: Points that are verified before the test is made for the second time, and then each time.
FIRST, STEP = 64, 256


def chi2_quantile(p: float, dof: int) -> float:
    """The p-quantile of a chi-square variable with an even number of degrees, by bisection."""
    assert dof % 2 == 0

    def cdf(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, dof // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return (lo + hi) / 2


@dataclass
class Tree:
    """A kd-tree in arrays: inner node i has children 2i+1 and 2i+2; leaves are the last level."""

    axis: np.ndarray
    cut: np.ndarray
    depth: int

    @classmethod
    def fit(cls, points: np.ndarray, leaves: int) -> Tree:
        depth = max(0, math.ceil(math.log2(max(1, leaves))))
        axis, cut = np.zeros((1 << depth) - 1, dtype=np.int64), np.zeros((1 << depth) - 1)
        parts = {0: points}
        for i in range(len(axis)):
            p = parts.pop(i)
            if len(p):
                axis[i] = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
                cut[i] = float(np.median(p[:, axis[i]]))
            right = p[:, axis[i]] > cut[i]
            parts[2 * i + 1], parts[2 * i + 2] = p[~right], p[right]
        return cls(axis, cut, depth)

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.cut[node])
        return node - ((1 << self.depth) - 1)


@dataclass
class Index:
    """What queries and rows share: the length of vectors, M^2, the projection and the tree."""

    length: int
    top: float
    planes: np.ndarray
    tree: Tree
    stop: float

    def project(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        norm = (vectors * vectors).sum(axis=1)
        last = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.top - norm, 0))
        return vectors @ self.planes[:-1] + last[:, None] * self.planes[-1]


def _matrix(column: pd.Series, length: int) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, length))


def clean(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, v: the usable rows, one a vec_id; their length)."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), bad.alias("bad")).where("vec_id is not null and v is not null and not bad")
    good = good.where(F.exists("v", lambda x: x != 0))
    sizes = good.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    length = int(sizes["length"]) if sizes else 0
    good = good.where(F.size("v") == length).groupBy("vec_id").agg(F.min("v").alias("v"))
    return materialise(good, "vectors"), length


def build(rows: DataFrame, length: int, sample: int = SAMPLE, confidence: float = CONFIDENCE, dim: int = DIM) -> tuple[Index, int]:
    top, n = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), F.count(F.lit(1))).first()
    top = float(top or 0) * (1 + 1e-12)
    planes = np.random.default_rng(11).standard_normal((length + 1, dim))
    if dim <= length + 1:
        planes = np.linalg.qr(planes)[0] * math.sqrt(length + 1)
    index = Index(length, top, planes, Tree(np.zeros(0, np.int64), np.zeros(0), 0), chi2_quantile(confidence, dim))
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas() if n else pd.DataFrame({"v": []})
    leaves = min(MOST_LEAVES, max(1, n // min(BLOCK_ROWS, max(LEAF_ROWS, n // MANY_LEAVES))))
    index.tree = Tree.fit(index.project(_matrix(some["v"], length), False), leaves)
    return index, int(n)


def _deal(index):
    def run(frames):
        for f in frames:
            m = _matrix(f["v"], index.value.length)
            yield f.assign(leaf=index.value.tree.leaf(index.value.project(m, False)).astype(np.int32))

    return run


class Block:
    """Rows of one block under a small kd-tree of buckets, each with its box."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, index: Index):
        points = index.project(vectors, False)
        tree = Tree.fit(points, max(1, len(ids) // BUCKET))
        bucket = tree.leaf(points)
        order = np.lexsort((ids, bucket))
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        head = np.unique(bucket[order], return_index=True)[1]
        self.width = np.diff(np.append(head, len(ids)))
        self.low, self.high = np.minimum.reduceat(self.points, head), np.maximum.reduceat(self.points, head)
        self.norm = (self.points * self.points).sum(axis=1)
        self.stop = index.stop

    def search(self, q: np.ndarray, shadow: np.ndarray, top: float, bound: float, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores of the best found, in order; points verified); ``bound`` is the least score worth having."""
        reach = float(q @ q) + top

        def limit() -> float:
            return max(reach - 2 * bound, 0) * self.stop

        gap = np.maximum(0, np.maximum(self.low - shadow, shadow - self.high))
        at = np.flatnonzero(np.repeat((gap * gap).sum(axis=1) <= limit(), self.width))
        points, norm = (self.points, self.norm) if len(at) == len(self.ids) else (self.points[at], self.norm[at])
        away = norm - 2 * (points @ shadow) + float(shadow @ shadow)
        near = np.flatnonzero(away <= limit() * (1 + 1e-9))  # what the bound leaves out at once is not sorted
        order = near[np.argsort(away[near], kind="stable")]
        at, away = at[order], away[order]
        ids, scores, verified = np.zeros(0, np.int64), np.zeros(0), 0
        while verified < len(at) and away[verified] <= limit() * (1 + 1e-9):
            some = at[verified : verified + (STEP if verified else FIRST)]
            verified += len(some)
            take = some[self.vectors[some] @ q >= bound - 1e-9 * (1 + abs(bound))]
            if not len(take):
                continue
            # row by row in one fixed order of addition, so equal vectors score alike wherever they lie
            ids, scores = np.concatenate([ids, self.ids[take]]), np.concatenate([scores, (self.vectors[take] * q).sum(axis=1)])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                bound = max(bound, float(scores[-1]))
        return ids, scores, verified


_FOUND = "query_id long, vec_id long, score double"


def _search(index, k: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        ix: Index = index.value
        block = Block(rows["vec_id"].to_numpy(), _matrix(rows["v"], ix.length), ix)
        qs = _matrix(queries["q"], ix.length)
        shadows = ix.project(qs, True)
        out = []
        for own, q, shadow, bound in zip(queries["query_id"].to_numpy(), qs, shadows, queries["bound"].to_numpy(), strict=True):
            ids, scores, _ = block.search(q, shadow, ix.top, bound if bound == bound else -math.inf, k)
            out.append((np.full(len(ids), own), ids, scores))
        a, b, c = (np.concatenate(x) for x in zip(*out, strict=True))
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})

    return run


def _home(index):
    def run(frames):
        for f in frames:
            m = _matrix(f["q"], index.value.length)
            yield f.assign(leaf=index.value.tree.leaf(index.value.project(m, True)).astype(np.int32))

    return run


def _sent(queries: pd.DataFrame, which: list[np.ndarray], leaf: list[np.ndarray]) -> pd.DataFrame:
    out = queries.iloc[np.concatenate(which)][["query_id", "q", "bound"]].reset_index(drop=True)
    return out.assign(leaf=np.concatenate(leaf).astype(np.int32))


def _others(index, boxes):
    """The leaves that a query has still to visit, given its bound."""

    def run(frames):
        leaf, low, high = boxes.value
        for f in frames:
            ix: Index = index.value
            qs = _matrix(f["q"], ix.length)
            shadow = ix.project(qs, True)
            reach = np.maximum((qs * qs).sum(axis=1) + ix.top - 2 * f["bound"].fillna(-math.inf).to_numpy(), 0) * ix.stop
            which, at, held = [], [], 0
            for i in range(len(f)):
                gap = np.maximum(0, np.maximum(low - shadow[i], shadow[i] - high))
                hit = np.flatnonzero(((gap * gap).sum(axis=1) <= reach[i]) & (leaf != f["home"].iloc[i]))
                which.append(np.full(len(hit), i))
                at.append(leaf[hit])
                held += len(hit)
                if held >= ROUTED_ROWS:  # a frame holds a vector for each leaf that a query is sent to
                    yield _sent(f, which, at)
                    which, at, held = [], [], 0
            if which:
                yield _sent(f, which, at)

    return run


def _boxes(index):
    def run(frames):
        for f in frames:
            p = index.value.project(_matrix(f["v"], index.value.length), False)
            leaf = f["leaf"].to_numpy()
            for x in np.unique(leaf):
                own = p[leaf == x]
                yield pd.DataFrame({"leaf": [x], "low": [own.min(axis=0).tolist()], "high": [own.max(axis=0).tolist()], "n": [len(own)]})

    return run


def _first_copies(rows: DataFrame, keep: int) -> DataFrame:
    """``rows`` (vec_id, v) without the copies of a vector beyond its ``keep`` least ids, which can be among the
    nearest of no query: all copies score alike, and ties go to the smaller id."""
    h = F.xxhash64("v").alias("h")
    many = materialise(rows.groupBy(h).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > keep).select("h"), "hot-vectors", rows.count())
    many = if_small(many, many.count())
    hot = rows.withColumn("h", h).join(many, "h", "left_semi").drop("h")
    # tasks keep the first of their own copies before the shuffle, so no task meets them all
    first = hot.withColumn("rn", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("rn") <= keep).drop("rn")
    return rows.withColumn("h", h).join(many, "h", "left_anti").drop("h").unionByName(first)


def search(vectors: DataFrame, is_query, k: int = NEAREST, **options) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` that meets ``is_query`` its k nearest rows.

    Queries of one vector are searched once, for k + 1 rows, from which each then drops its own.
    """
    spark = vectors.sparkSession
    rows, length = clean(vectors)
    index, _ = build(rows, length, **options)
    sent = spark.sparkContext.broadcast(index)
    dim = index.planes.shape[1]
    dealt = materialise(_first_copies(rows, k + 1).mapInPandas(_deal(sent), "vec_id long, v array<double>, leaf int"), "dealt")
    edge = [F.min(F.col("low")[i]).alias(f"l{i}") for i in range(dim)] + [F.max(F.col("high")[i]).alias(f"h{i}") for i in range(dim)]
    box = dealt.mapInPandas(_boxes(sent), "leaf int, low array<double>, high array<double>, n long").groupBy("leaf").agg(F.sum("n").alias("n"), *edge).toPandas()
    boxes = spark.sparkContext.broadcast((box["leaf"].to_numpy(), box[[f"l{i}" for i in range(dim)]].to_numpy(float), box[[f"h{i}" for i in range(dim)]].to_numpy(float)))
    # blocks of a leaf: a table of MOST_LEAVES rows at most
    parts = spark.createDataFrame([(int(a), max(1, -(-int(b) // BLOCK_ROWS))) for a, b in zip(box["leaf"], box["n"], strict=True)], "leaf int, parts int")
    blocks = dealt.join(F.broadcast(parts), "leaf").select("vec_id", "v", "leaf", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"))
    asked = materialise(rows.where(is_query).select("vec_id", "v"), "asked")
    queries = asked.groupBy("v").agg(F.min("vec_id").alias("query_id")).select("query_id", F.col("v").alias("q"), F.lit(None).cast("double").alias("bound"))
    queries = materialise(queries, "queries")
    found_of = materialise(asked.join(queries, F.col("v") == F.col("q")).select("vec_id", "query_id"), "groups", asked.count())

    def visit(routed: DataFrame) -> DataFrame:
        routed = materialise(routed, "routed")
        # queries of a leaf come in chunks too; a leaf's blocks meet each of them
        chunks = routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("chunks"))  # MOST_LEAVES rows at most
        chunks = materialise(chunks.join(F.broadcast(parts), "leaf"), "chunks", MOST_LEAVES)
        spread = routed.join(F.broadcast(chunks), "leaf").select("query_id", "q", "bound", "leaf", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        held = blocks.join(F.broadcast(chunks.select("leaf", "chunks")), "leaf").select("vec_id", "v", "leaf", "part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        found = spread.groupBy("leaf", "part", "chunk").cogroup(held.groupBy("leaf", "part", "chunk")).applyInPandas(_search(sent, k + 1), _FOUND)
        return materialise(found, "found")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    at_home = queries.mapInPandas(_home(sent), "query_id long, q array<double>, bound double, leaf int")
    first = visit(at_home)
    kth = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k + 1).select(F.col("query_id").alias("of"), F.col("score").alias("got"))
    second = at_home.join(kth, F.col("query_id") == F.col("of"), "left").select("query_id", "q", F.col("got").alias("bound"), F.col("leaf").alias("home"))
    rest = visit(second.mapInPandas(_others(sent, boxes), "query_id long, q array<double>, bound double, leaf int"))
    top = first.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1).drop("rank")
    top = materialise(top, "top").withColumnRenamed("vec_id", "near")
    each = found_of.join(top, "query_id").where(F.col("vec_id") != F.col("near")).select(F.col("vec_id").alias("query_id"), F.col("near").alias("vec_id"), "score")
    ranked = each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
