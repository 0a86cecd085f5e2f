"""Operator 13, centroid clustering with block-norm screening: k-means in exact integers.

Vectors become integers floor(256 x).  Each is stored with the squared norms of its segments, computed once: its
compressed form.  By Cauchy-Schwarz the difference of two vectors is at least as long, segment by segment, as the
difference of their segments' norms, so the compressed forms of a vector and a centroid bound their distance from
below.  Centroids whose bound is over an exact distance that the vector already has are never looked at; those left
get their exact integer distance segment by segment, with the norms' bound for the segments to come, so one may still
be left out on the way.  The bounds are in floating point and are lowered by a margin far above rounding.

A round is one pass over the vectors, which never move: every task sends one row of sums for each centroid, and the
driver holds the centroids alone (40 x 64 numbers).  Sums and counts are integers, so the order of tasks changes nothing.

Defined results.  Left out: vectors that are null, not of ``DIM`` components, or that hold a null or non-finite
component; also any with a component of 2^19 or more in size, whose squared distances a long can't hold.  A null
vec_id takes part, but is a first centroid only after all others.  Repeated rows each take part, and rows of
one id stand in the order of their vectors.  Fewer vectors than centroids: one centroid each.  Empty table: no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

DIM, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
SEGMENTS = 8
SALT = "2"
#: Components are held below this, so 64 squared differences fit into a long.
LIMIT = 1 << 27
#: By which bounds are lowered, relative to the squared lengths of both vectors.
MARGIN = 1e-9
#: Vectors that are compared at once.
BLOCK = 4096


def integers(embedding: Column, dim: int = DIM, scale: int = SCALE) -> Column:
    """The vector as integers, or null where it takes no part."""
    whole = F.transform(embedding, lambda x: x.cast("double") * scale)
    sound = (F.size(embedding) == dim) & F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (x < LIMIT) & (x >= -LIMIT))
    return F.when(sound, F.transform(whole, lambda x: F.floor(x).cast("int")))


def compressed(vector: Column, dim: int = DIM, segments: int = SEGMENTS) -> Column:
    """The squared norm of each segment."""
    wide = dim // segments

    def norm(s: Column) -> Column:
        return F.aggregate(F.slice(vector, s * wide + 1, wide), F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)

    return F.transform(F.sequence(F.lit(0), F.lit(segments - 1)), norm)


def first_centroids(kept: DataFrame, k: int = CENTROIDS, salt: str = SALT) -> np.ndarray:
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(key.asc_nulls_last(), "vec_id", "v").limit(k).select("v").collect()  # k rows
    return np.array([r["v"] for r in rows], dtype=np.int64)


def nearest(x: np.ndarray, squares: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, its squared distance, exact distances that were finished) for every row of ``x``.

    ``squares`` holds the squared norms of the rows' segments.  Of equally near centroids the first is taken.
    """
    n, segments = squares.shape
    wide = x.shape[1] // segments
    c_squares = (c.reshape(len(c), segments, wide) ** 2).sum(2)
    a, b = np.sqrt(squares.astype(float)), np.sqrt(c_squares.astype(float))
    margin = MARGIN * (squares.sum(1).astype(float)[:, None] + c_squares.sum(1).astype(float)[None])
    # to_come[s]: the bound for the segments from s on
    to_come = np.zeros((segments + 1, n, len(c)))
    for s in reversed(range(segments)):
        to_come[s] = to_come[s + 1] + (a[:, s, None] - b[None, :, s]) ** 2

    def exact(rows: np.ndarray, k: np.ndarray) -> np.ndarray:
        d = x[rows] - c[k]
        return (d * d).sum(1)

    every = np.arange(n)
    best = exact(every, to_come[0].argmin(1))
    done = n
    i, k = np.nonzero(to_come[0] - margin <= best[:, None])
    part = np.zeros(len(i), dtype=np.int64)
    for s in range(segments):
        d = x[i, s * wide : (s + 1) * wide] - c[k, s * wide : (s + 1) * wide]
        part += (d * d).sum(1)
        bound = part + to_come[s + 1][i, k] - margin[i, k]
        if s == segments // 2:  # the most promising of those left, for a sharper limit
            starts = np.searchsorted(i, every)
            low = np.minimum.reduceat(bound, starts)
            at = np.flatnonzero(bound == low[i])
            at = at[np.unique(i[at], return_index=True)[1]]
            best = np.minimum(best, exact(i[at], k[at]))
            done += n
        stay = bound <= best[i]
        i, k, part = i[stay], k[stay], part[stay]
    starts = np.searchsorted(i, every)
    low = np.minimum.reduceat(part, starts)
    at = np.flatnonzero(part == low[i])
    at = at[np.unique(i[at], return_index=True)[1]]  # pairs stand in the order of rows, then centroids
    return k[at], low, done + len(i)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(at, BLOCK)
            v, q = batch.column("v"), batch.column("q")
            yield batch, v.flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1), q.flatten().to_numpy().reshape(batch.num_rows, -1)


def round_sums(kept: DataFrame, c: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """(centroid, vectors, sum of each component) of the vectors nearest to each centroid."""
    dim = c.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(len(c), dtype=np.int64), np.zeros((len(c), dim), dtype=np.int64)
        for _, x, q in _blocks(batches):
            k, _, _ = nearest(x, q, c)
            count += np.bincount(k, minlength=len(c))
            np.add.at(sums, k, x)
        at = np.flatnonzero(count)
        if len(at):
            yield pa.RecordBatch.from_pydict({"k": pa.array(at, pa.int32()), "n": pa.array(count[at]), "s": pa.array(sums[at].tolist(), pa.list_(pa.int64()))})

    parts = kept.select("v", "q").mapInArrow(run, "k int, n long, s array<long>")
    whole = parts.groupBy("k").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim)])
    return [(r["k"], r["n"], [int(r[f"s{i}"]) for i in range(dim)]) for r in whole.collect()]  # a row a centroid


def assigned(kept: DataFrame, c: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance, looked_at (exact distances finished for the vector's block, on its first row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x, q in _blocks(batches):
            k, d, done = nearest(x, q, c)
            first = np.zeros(len(k), dtype=np.int64)
            first[:1] = done
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(k.astype(np.int32)), pa.array(d), pa.array(first)], ["vec_id", "cluster", "distance", "looked_at"])

    return kept.select("vec_id", "v", "q").mapInArrow(run, "vec_id long, cluster int, distance long, looked_at long")


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    spark = embeddings.sparkSession
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding"), dim).alias("v")).where("v is not null")
    kept = materialise(kept.withColumn("q", compressed(F.col("v"), dim)), "kmeans-vectors", embeddings.count(), 20_000)
    c = first_centroids(kept, k)
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(c):
        return spark.createDataFrame([], out)
    for _ in range(rounds):
        for at, n, sums in round_sums(kept, c):
            c[at] = [s // n for s in sums]
    found = materialise(assigned(kept, c), "kmeans-assigned", kept.count())
    per = [(r["cluster"], int(r["d"])) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()]
    total = sum(d for _, d in per)
    digest = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    stats = spark.createDataFrame([(i, d, total, digest[i]) for i, d in per], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(stats), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    near = "SELECT w.id, arg_min({{'k': k, 'd': d}}, (d, k)) AS a FROM (SELECT v.id, k, list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d FROM v, c{r}) w GROUP BY w.id"
    step = (
        "a{r} AS MATERIALIZED (" + near + "), s{r} AS (SELECT k, i, sum(y) AS s, count(*) AS n FROM (SELECT a.k AS k, unnest(range(1, 65)) AS i, unnest(x) AS y FROM v JOIN a{r} USING (id)) GROUP BY 1, 2), "
        "m{r} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{r} GROUP BY 1), c{t} AS MATERIALIZED (SELECT k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k))"
    )
    rounds = ", ".join(step.format(r=r, t=r + 1) for r in range(ROUNDS))
    last = near.format(r=ROUNDS)
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda e: floor(e::DOUBLE * {SCALE})::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e::DOUBLE))) = {DIM}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, vec_id, x) - 1)::INT AS k, x AS c FROM (SELECT sha256('{SALT}:' || vec_id) AS h, vec_id, x FROM v) ORDER BY h, vec_id, x LIMIT {CENTROIDS}),
{rounds}, f AS MATERIALIZED ({last})
SELECT vec_id, a.k AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM v JOIN f USING (id) JOIN c{ROUNDS} ON c{ROUNDS}.k = a.k"""


ORACLE = _oracle()
