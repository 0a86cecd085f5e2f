"""Sums along and below the branches of a forest, dominators, and reach, all by doubling.

A forest is a table (node, up) with one row for every node that has a parent.  Its *steps* are the tables of
ancestors 1, 2, 4, ... levels up: at most one row a node each, and as many as the depth has binary digits.  Sums over
what lies below a node, or above it, take one pass over the nodes for each step, so nothing here writes the pairs of
ancestors and descendants, but for ``pairs``, whose result they are.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import running
from ..state import settle, settle_counted

CAP = 10_000
#: Passes that one job makes.
LONG = 6


def _double(step: DataFrame) -> tuple[DataFrame, int]:
    return settle_counted(step.select("node", F.col("up").alias("_m")).join(step.select(F.col("node").alias("_m"), "up"), "_m").select("node", "up"))


def steps(parents: DataFrame, most: int = 64) -> list[DataFrame]:
    """The tables (node, up) of ancestors 1, 2, 4, ... levels up, as long as there are any, ``most`` at most."""
    step, n = settle_counted(parents.select("node", "up"))
    out = []
    while n:
        if len(out) > most:
            raise RuntimeError("the parents go round in a cycle")
        out.append(step)
        step, n = _double(step)
    return out


def below(ups: list[DataFrame], values: DataFrame, *columns: str, by: tuple[str, ...] = ()) -> DataFrame:
    """node, ``by``, ``columns``: sums over the node and all nodes below it.  ``values``: node, by and columns.

    After the pass of step 2^k a node has the sum of what is fewer than 2^(k+1) levels below it: every row stays
    where it is and is sent up too.
    """
    total = [F.sum(c).alias(c) for c in columns]
    s = values.groupBy("node", *by).agg(*total)
    for k, up in enumerate(ups):
        both = F.filter(F.array("node", "up"), lambda x: x.isNotNull())
        s = s.join(up, "node", "left").select(F.explode(both).alias("node"), *by, *columns).groupBy("node", *by).agg(*total)
        s = settle(s) if k % LONG == LONG - 1 else s
    return settle(s)


def above(ups: list[DataFrame], values: DataFrame, *columns: str) -> DataFrame:
    """node, ``columns``: sums over the node and all its ancestors.  ``values`` has a row for every node.

    The same passes the other way: every row stays where it is and is sent down to those that step up to it.
    """
    s = settle(values.select("node", *columns))
    own = s.select("node", F.col("node").alias("down"))
    for k, up in enumerate(ups):
        to = up.select(F.col("up").alias("node"), F.col("node").alias("down")).unionByName(own)
        s = s.join(to, "node").groupBy(F.col("down").alias("node")).agg(*[F.sum(c).alias(c) for c in columns])
        s = settle(s) if k % LONG == LONG - 1 else s
    return settle(s)


def tops(ups: list[DataFrame], nodes: DataFrame) -> DataFrame:
    """node, top: the root of each node's tree; every node goes as high as it can, by the longest step first."""
    t = nodes.select("node", F.col("node").alias("top"))
    for k, up in enumerate(reversed(ups)):
        t = t.join(up.select(F.col("node").alias("top"), "up"), "top", "left").select("node", F.coalesce("up", "top").alias("top"))
        t = settle(t) if k % LONG == LONG - 1 else t
    return settle(t)


def pairs(ups: list[DataFrame], nodes: DataFrame) -> DataFrame:
    """node, anc: every given node with itself and each of its ancestors; every pair is made once."""
    p = settle(nodes.select("node", F.col("node").alias("anc")))
    for up in ups:
        p = settle(p.unionByName(p.join(up.withColumnRenamed("node", "anc"), "anc").select("node", F.col("up").alias("anc"))))
    return p


def under(ups: list[DataFrame], tops: DataFrame, *columns: str) -> DataFrame:
    """node, ``columns``: every node of ``tops`` (node, columns) and each node below it, with that row's columns; from the top
    down by doubling, so each pair is made once and none but those asked for."""
    p = settle(tops.select("node", *columns))
    for up in ups:
        p = settle(p.unionByName(p.withColumnRenamed("node", "up").join(up, "up").select("node", *columns)))
    return p


def intervals(ups: list[DataFrame], nodes: DataFrame) -> DataFrame:
    """node, enter, size: a numbering in which the nodes below a node, itself included, are those from enter to
    enter + size - 1.  A node's number is the sum, up to its root, of the sizes of earlier siblings, and one a level."""
    size = below(ups, nodes.select("node").withColumn("size", F.lit(1).cast("long")), "size")
    up = ups[0] if ups else nodes.select("node", F.col("node").alias("up")).limit(0)
    kin = size.join(up, "node", "left")
    kin = settle(running(kin, "prior", "size", F.col("up").asc_nulls_first(), F.col("node").asc()))
    first = kin.groupBy("up").agg(F.min("prior").alias("_first")).withColumnRenamed("up", "_u")
    step = kin.join(first, F.col("up").eqNullSafe(F.col("_u"))).select("node", (F.col("prior") - F.col("_first") + F.col("up").isNotNull().cast("long")).alias("enter"))
    return settle(above(ups, step, "enter").join(size, "node"))


def ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


class Forest(NamedTuple):
    """A graph as trees of nodes with one entering edge; ``heads`` are the nodes that are entered otherwise (by several
    edges, or where a cycle was cut open) and ``entering`` (head, tail) their edges."""

    ups: list[DataFrame]
    heads: DataFrame
    entering: DataFrame
    plain: bool


def forest(edges: DataFrame) -> Forest:
    """Any directed graph as a forest and its heads; a graph that is a forest has no heads (``plain``)."""
    e = settle(edges.where("src <> dst").select("src", "dst"))
    into = settle(e.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("_n"), F.min("src").alias("up")))
    heads = into.where("_n > 1").select("node")
    parents = settle(into.where("_n = 1").select("node", "up"))
    n = parents.count()
    ups, (step, left) = [], settle_counted(parents)
    while left and 2 ** len(ups) <= n:
        ups.append(step)
        step, left = _double(step)
    if left:  # more levels than nodes: what is still on its way goes round; its least nodes cut the cycles open
        ups.append(step)
        ring = settle(ups[-1].select(F.col("up").alias("node")).distinct())
        low = ups[0].join(ring, "node", "left_semi").select("node", F.col("up").alias("low"))
        for up in ups:
            far = low.select(F.col("node").alias("up"), F.col("low").alias("_l"))
            low = settle(low.join(up, "node").join(far, "up").select("node", F.least("low", "_l").alias("low")))
        cut = low.where("low = node").select("node")
        heads = heads.unionByName(cut)
        ups = steps(parents.join(cut, "node", "left_anti"))
    heads = settle(heads)
    entering = settle(e.join(heads.withColumnRenamed("node", "dst"), "dst", "left_semi").select(F.col("dst").alias("head"), F.col("src").alias("tail")).distinct())
    return Forest(ups, heads, entering, not heads.limit(1).count())


def heads_reached(f: Forest, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, head: the heads that each node reaches by one edge or more; node, top).

    What a node reaches is the rest of its own tree below it and the whole trees of these heads, which are disjoint.
    The table has a row for each ancestor of a tail within its tree, and pairs of heads: nothing else is multiplied.
    """
    top = tops(f.ups, nodes)
    near = settle(pairs(f.ups, f.entering.select(F.col("tail").alias("node")).distinct()).join(f.entering, F.col("node") == F.col("tail")).select(F.col("anc").alias("node"), "head").distinct())
    hop = f.entering.join(top, F.col("tail") == F.col("node")).select(F.col("top").alias("from"), "head").join(f.heads.select(F.col("node").alias("from")), "from", "left_semi").distinct()
    far = settle(hop)
    n = far.count()
    for _ in range(64):
        longer = far.select("from", F.col("head").alias("_m")).join(far.select(F.col("from").alias("_m"), "head"), "_m").select("from", "head")
        far = settle(far.unionByName(longer).distinct())
        if (m := far.count()) == n:
            break
        n = m
    via = near.join(far.select(F.col("from").alias("head"), F.col("head").alias("_h")), "head").select("node", F.col("_h").alias("head"))
    return settle(near.unionByName(via).distinct()), top


def reach_sums(f: Forest, nodes: DataFrame, values: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, columns: sums over the node and all that it reaches, each once; node, head reached; node, top)."""
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns]
    own = below(f.ups, nodes.join(values, "node", "left").select("node", *zero), *columns)
    if f.plain:
        none = nodes.limit(0)
        return own, none.select("node", F.col("node").alias("head")), none.select("node", F.col("node").alias("top"))
    heads, top = heads_reached(f, nodes)
    tree = own.select(F.col("node").alias("head"), *columns)
    more = heads.join(tree, "head").groupBy("node").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    inside = heads.join(top, (heads["node"] == top["node"]) & (heads["head"] == top["top"]), "left_semi").select("node", F.lit(True).alias("_in"))
    whole = own.join(more, "node", "left").join(inside, "node", "left")
    sums = [(F.when(F.col("_in"), F.lit(0)).otherwise(F.col(c)) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in columns]
    return settle(whole.select("node", *sums)), heads, top


def _common(ups: list[DataFrame], depth: DataFrame, groups: DataFrame) -> DataFrame:
    """m, up: the deepest common ancestor of the nodes (x) of each group, all of one tree.

    The groups' nodes rise to the level of the highest, then together as long as they stay apart.
    """
    group = Window.partitionBy("m")
    g = groups.join(depth.withColumnRenamed("node", "x"), "x").select("m", "x", (F.col("depth") - F.min("depth").over(group)).alias("rise"))
    apart = F.coalesce(F.min("up").over(group) != F.max("up").over(group), F.lit(False))
    passes = [(up, F.shiftright("rise", k) % 2 == 1) for k, up in enumerate(ups)] + [(up, apart) for up in reversed(ups)]
    for k, (up, go) in enumerate(passes):
        g = g.join(up.withColumnRenamed("node", "x"), "x", "left").select("m", F.when(go, F.col("up")).otherwise(F.col("x")).alias("x"), "rise")
        g = settle(g) if k % LONG == LONG - 1 else g
    one = settle(g.groupBy("m").agg((F.min("x") != F.max("x")).alias("_apart"), F.min("x").alias("x")))
    up = ups[0].select(F.col("node").alias("x"), "up") if ups else one.select("x", F.col("x").alias("up")).limit(0)
    return one.where("_apart").select("m", "x").join(up, "x").select("m", "up").unionByName(one.where("not _apart").select("m", F.col("x").alias("up")))


class Dominators(NamedTuple):
    """``ups``: steps of the dominator forest of the nodes that a source reaches; ``fed`` (node, seg_id): nodes that a
    single edge feeds.  The removal of that edge cuts off just that node and all below it in the forest."""

    ups: list[DataFrame]
    fed: DataFrame


def dominators(edges: DataFrame, sources: DataFrame) -> Dominators:
    """Of an acyclic graph (seg_id, src, dst), by rounds over nodes with several feeds: such a node hangs below
    the deepest node that all its feeds share.  Nodes with one feed need no round, so a tree has none.

    A node with a feed is dry if no source reaches it; dry feeds don't count.  Raises ValueError on a cycle.
    """
    src = settle(sources.select("node").distinct())
    e = settle(edges.where("src <> dst").select("seg_id", "src", "dst").join(src.withColumnRenamed("node", "dst"), "dst", "left_anti"))
    into = e.groupBy("dst").agg(F.count(F.lit(1)).alias("_n"))
    one = settle(e.join(into.where("_n = 1"), "dst").select(F.col("dst").alias("node"), F.col("src").alias("up"), "seg_id"))
    many = e.join(into.where("_n > 1"), "dst").select(F.col("dst").alias("m"), F.col("src").alias("x"), "seg_id")
    nodes, number = settle_counted(ends(edges).unionByName(src).distinct())
    wet = src  # roots that are supplied: sources, and nodes that feeds from different ones meet in
    parents, fed = one.select("node", "up"), one.select("node", "seg_id")
    many, left = settle_counted(many)
    for _ in range(CAP):
        try:
            ups = steps(parents, max(1, number).bit_length())
        except RuntimeError:
            raise ValueError("a cycle of feeds: use reach_after_removal") from None
        top = tops(ups, nodes)
        if not left:
            break
        state = many.join(top.withColumnRenamed("node", "x"), "x").join(wet.select(F.col("node").alias("top"), F.lit(True).alias("_wet")), "top", "left")
        state = settle(state.join(many.select(F.col("m").alias("top"), F.lit(True).alias("_open")).distinct(), "top", "left"))
        ready, n = settle_counted(state.join(state.where("_open").select("m").distinct(), "m", "left_anti"))
        if not n:
            raise ValueError("a cycle of feeds: use reach_after_removal")
        per = settle(ready.where("_wet").groupBy("m").agg(F.count(F.lit(1)).alias("_n"), (F.min("top") != F.max("top")).alias("_tops"), F.min("x").alias("x"), F.min("seg_id").alias("seg_id")))
        depth = above(ups, nodes.withColumn("depth", F.lit(1).cast("long")), "depth")
        share = _common(ups, depth, ready.where("_wet").join(per.where("_n > 1 and not _tops").select("m"), "m", "left_semi").select("m", "x").distinct())
        parents = settle(parents.unionByName(per.where("_n = 1").select(F.col("m").alias("node"), F.col("x").alias("up"))).unionByName(share.select(F.col("m").alias("node"), "up")))
        fed = fed.unionByName(per.where("_n = 1").select(F.col("m").alias("node"), "seg_id"))
        wet = wet.unionByName(per.where("_tops").select(F.col("m").alias("node")))
        many, left = settle_counted(many.join(ready.select("m").distinct(), "m", "left_anti"))
    supplied = top.join(wet.withColumnRenamed("node", "top"), "top", "left_semi").select("node")
    return Dominators(ups, settle(fed.join(supplied, "node", "left_semi")))
