"""Connected components of an edge table of any size, by alternating stars.

Every partition first contracts its own edges by union-find.  Edges that then fit into one task
(``FIT``, counted) are contracted there.  As long as there are more, large-star and small-star rounds link
every node to the least neighbour it knows, until the edges are stars.  No node's neighbours are ever
collected: a round is a grouped minimum, which is summed up before its shuffle, and a join whose two
sides are fresh exchanges, so AQE can split the neighbours of a hub.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Edges (16 bytes each) that one task contracts by itself.
FIT = 2_000_000


def contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of these edges, roots left out."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while True:  # hooking to the lesser root and pointer jumping
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            break
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not (root == (up := root[root])).all():
            root = up
    moved = root != np.arange(len(ids))
    return ids[moved], ids[root[moved]]


def _local(batches):
    u: list[np.ndarray] = []
    v: list[np.ndarray] = []

    def out():
        a, b = contract(np.concatenate(u), np.concatenate(v))
        u.clear(), v.clear()
        return pa.record_batch([pa.array(a), pa.array(b)], names=["u", "v"])

    held = 0
    for batch in batches:
        u.append(batch.column(0).to_numpy())
        v.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held >= 1 << 21:
            yield out()
            held = 0
    if held:
        yield out()


def _rooted(batches):
    """(node, root) of all nodes of the edges that come, roots too."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not held:
        return
    node, root = contract(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]))
    tops = np.unique(root)
    yield pa.record_batch([pa.array(np.concatenate([node, tops])), pa.array(np.concatenate([root, tops]))], names=["node", "root"])


def components(edges: DataFrame, rounds: int = 60, fit: int = FIT) -> DataFrame:
    """node, root: for every node with an edge, the least node of its component (roots too).

    ``edges`` has longs u and v; loops and repeats are allowed.
    """
    now = materialise(edges.where("u <> v").mapInArrow(_local, "u long, v long"), "edges")
    before = None
    for _ in range(rounds):
        if now.count() <= fit:
            return now.coalesce(1).mapInArrow(_rooted, "node long, root long")
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").distinct()
        large = materialise(large, "large")  # u > v
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        now = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
