"""Graph operators over edge tables (seg_id, src, dst, length_m, ...).

Loops keep their state in tables (``state.settle``), run until nothing changes, and raise if they have
not settled within a cap.  No operator collects nodes or edges to the driver.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.stats import first_by
from ..state import ranked, settle, settle_counted
from . import tree

CAP = 10_000
#: Tables of a loop's rounds that are added up at a time.
FOLD = 32


def simple_edges(edges: DataFrame, order: str = "seq") -> DataFrame:
    """Drops self loops; of parallel edges (either direction) keeps the longest, of equal ones the first."""
    e = edges.where("src <> dst").withColumn("_a", F.least("src", "dst")).withColumn("_b", F.greatest("src", "dst"))
    return first_by(e, ["_a", "_b"], [F.desc("length_m"), F.asc(order)]).drop("_a", "_b")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node): labels pass along edges, then jump to the label's label."""
    both = settle(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).unionByName(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"))).where("a <> b").distinct())
    label = settle(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    for _ in range(CAP):
        far = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("m"))
        low = label.join(far, F.col("node") == F.col("a"), "left").select("node", F.least("component", F.coalesce("m", "component")).alias("component"))
        jump = low.select(F.col("node").alias("c"), F.col("component").alias("up"))
        new = settle(low.join(jump, F.col("component") == F.col("c"), "left").select("node", F.least("component", F.coalesce("up", "component")).alias("component")))
        changed = new.join(label.withColumnRenamed("component", "old"), "node").where("component <> old").limit(1).count()
        label = new
        if not changed:
            loops = edges.where("src = dst").select(F.col("src").alias("node")).distinct().join(label, "node", "left_anti")
            return label.unionByName(loops.withColumn("component", F.col("node")))
    raise RuntimeError("components did not settle")


def component_report(edges: DataFrame, expected: int = 5, labels: DataFrame | None = None) -> DataFrame:
    """component, place (0 for the largest), nodes, km, too_many: whether there are more than ``expected``."""
    comp = components(edges) if labels is None else labels
    km = edges.join(comp, F.col("src") == F.col("node")).groupBy("component").agg((F.sum("length_m") / 1000).alias("km"))
    c = settle(comp.groupBy("component").agg(F.count(F.lit(1)).alias("nodes")).join(km, "component", "left"))
    return ranked(c, "place", F.desc("nodes"), F.asc("component")).select("component", (F.col("place") - 1).alias("place"), "nodes", F.coalesce("km", F.lit(0.0)).alias("km"), F.lit(c.count() > expected).alias("too_many"))


def closure(edges: DataFrame) -> DataFrame:
    """anc, des: every pair with a directed path of one edge or more (cycles are fine).

    What a node reaches is the rest of its own tree below it and the whole trees of the heads that it reaches, which
    are disjoint (``tree.heads_reached``).  So each pair is made once, from rows of trees, and none is compared with others.
    """
    f = tree.forest(edges)
    nodes = settle(tree.ends(edges))
    within = tree.pairs(f.ups, nodes).where("node <> anc").select("anc", F.col("node").alias("des"))
    loops = edges.where("src = dst").select(F.col("src").alias("anc"), F.col("dst").alias("des")).distinct()
    if f.plain:
        return within.unionByName(loops)
    heads, top = tree.heads_reached(f, nodes)
    # a node that reaches the top of its own tree reaches all of that tree, itself too
    round_ = settle(heads.join(top, (heads["node"] == top["node"]) & (heads["head"] == top["top"]), "left_semi").select(F.col("node").alias("anc")))
    own = within.unionByName(loops).join(round_, "anc", "left_anti")
    return own.unionByName(heads.select(F.col("node").alias("anc"), "head").join(top.select(F.col("top").alias("head"), F.col("node").alias("des")), "head").select("anc", "des"))


def hops(edges: DataFrame, sources: DataFrame, directed: bool = False, scenario: bool = False) -> DataFrame:
    """node, level (and scenario): the least number of edges from any source (column node).

    With ``scenario``, sources have a scenario column and edges a column ``removed_in``: an array of
    scenarios that they are missing from.
    """
    key = ["scenario"] if scenario else []
    out = [F.col("src").alias("a"), F.col("dst").alias("b")] + ([F.col("removed_in")] if scenario else [])
    step = edges.select(*out)
    if not directed:
        step = step.unionByName(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"), *out[2:]))
    step = settle(step)
    seen = settle(sources.select("node", *key).distinct().withColumn("level", F.lit(0).cast("long")))
    edge_of = seen
    for level in range(1, CAP):
        new = edge_of.join(step, F.col("node") == F.col("a"))
        if scenario:
            new = new.where(~F.array_contains("removed_in", F.col("scenario")))
        new = settle(new.select(F.col("b").alias("node"), *key).distinct().join(seen, ["node", *key], "left_anti").withColumn("level", F.lit(level).cast("long")))
        if not new.limit(1).count():
            return seen
        seen = settle(seen.unionByName(new)) if level % 16 == 0 else seen.unionByName(new)
        edge_of = new
    raise RuntimeError("hop levels did not settle")


def orient(edges: DataFrame, levels: DataFrame) -> DataFrame:
    """Edges from the lower to the higher level; on equal levels the stored direction stays."""
    u = levels.select(F.col("node").alias("src"), F.col("level").alias("_lu"))
    v = levels.select(F.col("node").alias("dst"), F.col("level").alias("_lv"))
    e = edges.join(u, "src", "left").join(v, "dst", "left")
    swap = F.coalesce(F.col("_lu") > F.col("_lv"), F.lit(False))
    return e.withColumns({"src": F.when(swap, F.col("dst")).otherwise(F.col("src")), "dst": F.when(swap, F.col("src")).otherwise(F.col("dst"))}).drop("_lu", "_lv")


def downstream_sum(edges: DataFrame, value: str, f: tree.Forest | None = None) -> DataFrame:
    """seg_id, own, total: an edge's value and that of every other edge whose tail its head can reach.

    On trees this is a sum below each head, by doubling.  Where edges meet again or go round, the whole trees below
    the meeting nodes that a head reaches are added, each once (``tree.heads_reached``).  ``f``: the edges' forest, if known.
    """
    e = settle(edges.select("seg_id", F.col("src").alias("_s"), F.col("dst").alias("_d"), F.col(value).cast("double").alias("own")))
    f = f or tree.forest(edges)
    nodes = settle(tree.ends(edges))
    here = e.groupBy(F.col("_s").alias("node")).agg(F.sum("own").alias("total"))
    total, heads, top = tree.reach_sums(f, nodes, here, "total")
    out = e.join(total.withColumnRenamed("node", "_d"), "_d")
    if not f.plain:
        # an edge whose tail its own head reaches is among what it reaches: it counts once
        tails = out.select("seg_id", "_d", "_s").join(top.select(F.col("node").alias("_s"), F.col("top").alias("head")), "_s")
        round_ = tails.join(heads.withColumnRenamed("node", "_d"), ["_d", "head"], "left_semi").select("seg_id", F.lit(True).alias("_back"))
        out = out.join(round_, "seg_id", "left")
    else:
        out = out.withColumn("_back", F.lit(None).cast("boolean"))
    loop = F.coalesce("_back", F.lit(False)) | (F.col("_s") == F.col("_d"))
    return out.select("seg_id", "own", (F.col("total") + F.when(loop, 0.0).otherwise(F.col("own"))).alias("total"))


def tree_betweenness(edges: DataFrame, f: tree.Forest | None = None) -> DataFrame:
    """seg_id, betweenness of a forest: (1 + ancestors of tail) * (1 + descendants of head) / (n (n - 1)).

    Raises ValueError where a node has several entering edges or a cycle: ``betweenness`` is for those.
    """
    f = f or tree.forest(edges)
    if not f.plain:
        raise ValueError("not a forest: use betweenness")
    nodes = settle(tree.ends(edges).withColumn("_k", F.lit(1).cast("long")))
    n = nodes.count()
    up, down = tree.above(f.ups, nodes, "_k"), tree.below(f.ups, nodes, "_k")
    e = edges.select("seg_id", "src", "dst").join(up.select(F.col("node").alias("src"), F.col("_k").alias("_up")), "src").join(down.select(F.col("node").alias("dst"), F.col("_k").alias("_down")), "dst")
    return e.select("seg_id", (F.col("_up") * F.col("_down") / float(max(1, n * (n - 1)))).alias("betweenness"))


#: Rows (source, node) that a batch of ``betweenness`` is made for.
REACHED = 20_000_000


def betweenness(edges: DataFrame, weight: str = "length_m", sources: int = 2_000, pivots: int | None = None, risk: float = 0.01) -> DataFrame:
    """seg_id, betweenness on weighted shortest directed paths, ties split, over n (n - 1).

    Tables of (source, node) rows, ``sources`` sources at a time, or as many more as reach ``REACHED`` nodes together
    (every batch takes the same number of rounds, so few large ones beat many small): least distances by relaxing what the last round
    improved, then the arcs of all shortest paths, numbers of paths carried down them and shares carried back up
    (``_carried``).  Rounds are as many as the edges of the longest shortest path; nothing is held by a task or
    the driver.  Every pair within reach is met, so on a large network ``pivots`` takes that many sources, of least
    hash, instead of all, and adds the column ``error``: no edge's estimate is off by more, except with
    probability ``risk`` (Hoeffding).  Loops lie on no path; weights that are null, NaN, or not above 0 raise.
    """
    e = settle(edges.select("seg_id", "src", "dst", F.col(weight).cast("double").alias("w")))
    if e.where("w is null or isnan(w) or w <= 0").limit(1).count():
        raise ValueError("weights have to be positive")
    nodes, n = settle_counted(tree.ends(edges).select("node"))
    if pivots is not None and pivots < n:
        chosen, k = settle(nodes.orderBy(F.xxhash64("node"), "node").limit(pivots)), pivots
    else:
        chosen, k = nodes, n
    steps = settle(e.where("src <> dst").select("seg_id", F.col("src").alias("u"), F.col("dst").alias("v"), "w"))
    batches = max(1, -(-k // sources))
    if batches > 1 and pivots is None:
        reach, _, _ = tree.reach_sums(tree.forest(e), nodes, nodes.withColumn("rows", F.lit(1).cast("long")), "rows")
        batches = min(batches, max(1, -(-reach.agg(F.sum("rows")).first()[0] // REACHED)))
    dealt = chosen.withColumn("_batch", F.pmod(F.xxhash64(F.lit("batch"), "node"), F.lit(batches)))
    shares = [settle(_path_shares(steps, dealt.where(F.col("_batch") == i).select(F.col("node").alias("source")))) for i in range(batches)]
    total = functools.reduce(DataFrame.unionByName, shares).groupBy("seg_id").agg(F.sum("share").alias("share"))
    out = e.select("seg_id").distinct().join(total, "seg_id", "left")
    out = out.select("seg_id", (F.coalesce("share", F.lit(0.0)) / float(max(1, k * (n - 1)))).alias("betweenness"))
    if pivots is None:
        return out
    bound = 0.0 if k == n else math.sqrt(math.log(2 * max(1, e.count()) / risk) / (2 * k))
    return out.withColumn("error", F.lit(bound))


def _tie(d: Column) -> Column:
    """How far apart two sums may lie that count as equal."""
    return F.lit(1e-12) * (1 + d)


def _path_shares(steps: DataFrame, chosen: DataFrame) -> DataFrame:
    """seg_id, share: the shares of shortest paths from ``chosen`` (source) that pass an edge of ``steps`` (seg_id, u, v, w)."""
    best = settle(chosen.select("source", F.col("source").alias("node"), F.lit(0.0).alias("d"), F.lit(True).alias("better")))
    moved = True
    while moved:
        tried = best.where("better").join(steps, F.col("node") == F.col("u")).select("source", F.col("v").alias("node"), (F.col("d") + F.col("w")).alias("d"), F.lit(None).cast("double").alias("was"))
        both = best.select("source", "node", "d", F.col("d").alias("was")).unionByName(tried).groupBy("source", "node").agg(F.min("d").alias("d"), F.min("was").alias("was"))
        better = F.col("was").isNull() | (F.col("d") < F.col("was") - _tie(F.col("was")))
        seen = Observation()
        best = settle(both.select("source", "node", F.when(better, F.col("d")).otherwise(F.col("was")).alias("d"), better.alias("better")).observe(seen, F.count_if("better").alias("rows")))
        moved = seen.get["rows"] > 0
    a = best.select("source", F.col("node").alias("u"), F.col("d").alias("_du"))
    b = best.select("source", F.col("node").alias("v"), F.col("d").alias("_dv"))
    on_path = (F.abs(F.col("_du") + F.col("w") - F.col("_dv")) <= _tie(F.col("_dv"))) & (F.col("_du") < F.col("_dv"))
    arcs = settle(a.join(steps, "u").join(b, ["source", "v"]).where(on_path).select("source", "seg_id", "u", "v"))
    paths = settle(_carried(arcs, chosen.select("source", F.col("source").alias("node"), F.lit(1.0).alias("x")), "u", "v"))
    # a node's part of the paths to all that lies behind it, by its own number of paths
    behind = _carried(arcs, paths.select("source", "node", (1 / F.col("x")).alias("x")), "v", "u")
    out = arcs.join(paths.select("source", F.col("node").alias("u"), F.col("x").alias("_paths")), ["source", "u"])
    out = out.join(behind.select("source", F.col("node").alias("v"), F.col("x").alias("_behind")), ["source", "v"])
    return out.groupBy("seg_id").agg(F.sum(F.col("_paths") * F.col("_behind")).alias("share"))


def _carried(arcs: DataFrame, start: DataFrame, tail: str, head: str) -> DataFrame:
    """source, node, x: ``start`` and what walks of every length along ``arcs`` (acyclic) carry from tails to heads, summed."""
    held, front, rows = [settle(start)], start, 1
    while rows:
        step = front.withColumnRenamed("node", tail).join(arcs, ["source", tail]).groupBy("source", F.col(head).alias("node")).agg(F.sum("x").alias("x"))
        front, rows = settle_counted(step)
        held.append(front)
        if len(held) == FOLD or not rows:
            held = [settle(functools.reduce(DataFrame.unionByName, held).groupBy("source", "node").agg(F.sum("x").alias("x")))]
    return held[0]


def parents(edges: DataFrame, levels: DataFrame) -> DataFrame:
    """node, parent_seg, parent: the edge of least seg_id from the level above, for shortest paths by hops."""
    u = levels.select(F.col("node").alias("src"), F.col("level").alias("_lu"))
    v = levels.select(F.col("node").alias("dst"), F.col("level").alias("_lv"))
    e = edges.join(u, "src").join(v, "dst").where(F.col("_lv") == F.col("_lu") + 1)
    return e.groupBy(F.col("dst").alias("node")).agg(F.min(F.struct("seg_id", "src")).alias("_m")).select("node", F.col("_m.seg_id").alias("parent_seg"), F.col("_m.src").alias("parent"))


def supply_paths(edges: DataFrame, levels: DataFrame) -> DataFrame:
    """seg_id, on_path: each edge and the edges on the shortest path to its tail; by pointer doubling.

    Only tails are led up their ways, and each pair is made once."""
    up = settle(parents(edges, levels))
    tails = settle(edges.select("seg_id", F.col("src").alias("tail")))
    ways = tree.pairs(tree.steps(up.select("node", F.col("parent").alias("up"))), tails.select(F.col("tail").alias("node")).distinct())
    on = ways.join(up.select(F.col("node").alias("anc"), "parent_seg"), "anc").select(F.col("node").alias("tail"), "parent_seg")
    reach = edges.join(levels, F.col("src") == F.col("node"), "left_semi").select("seg_id", F.col("seg_id").alias("on_path"))
    return tails.join(on, "tail").select("seg_id", F.col("parent_seg").alias("on_path")).unionByName(reach)


def chainage(edges: DataFrame, sources: DataFrame, weight: str = "length_m") -> DataFrame:
    """node, metres: the least weighted distance from any source (column node), by relaxation to the fixpoint."""
    step = settle(edges.select("src", "dst", F.col(weight).cast("double").alias("w")))
    best = settle(sources.select("node").distinct().withColumn("metres", F.lit(0.0)))
    front = best
    for _ in range(CAP):
        new = front.join(step, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg(F.min(F.col("metres") + F.col("w")).alias("metres"))
        old = best.withColumnRenamed("metres", "_old")
        front = settle(new.join(old, "node", "left").where("_old is null or metres < _old").select("node", "metres"))
        if not front.limit(1).count():
            return best
        best = settle(best.unionByName(front).groupBy("node").agg(F.min("metres").alias("metres")))
    raise RuntimeError("chainage did not settle")


def named_above(segs: DataFrame, parent: DataFrame, named: Column, most: int = 80) -> DataFrame:
    """seg_id, above: the nearest named edge upstream within ``most`` steps; by pointer doubling.

    ``parent`` has seg_id and up (the one predecessor); ``named`` is a condition on ``segs``.
    """
    flag = segs.select("seg_id", named.alias("_named"))
    at = parent.join(flag.withColumnsRenamed({"seg_id": "up", "_named": "stop"}), "up").select("seg_id", "up", "stop", F.lit(1).alias("steps"))
    at = settle(at)
    for _ in range(12):
        nxt = at.select(F.col("seg_id").alias("_s"), F.col("up").alias("_up"), F.col("stop").alias("_stop"), F.col("steps").alias("_n"))
        j = at.join(nxt, (~F.col("stop")) & (F.col("up") == F.col("_s")), "left")
        moved = F.col("_s").isNotNull()
        new = settle(j.select("seg_id", F.when(moved, F.col("_up")).otherwise(F.col("up")).alias("up"), F.when(moved, F.col("_stop")).otherwise(F.col("stop")).alias("stop"), F.when(moved, F.col("steps") + F.col("_n")).otherwise(F.col("steps")).alias("steps")))
        settled = not new.join(at.select("seg_id", F.col("up").alias("_u")), "seg_id").where("up <> _u").limit(1).count()
        at = new
        if settled:
            break
    return at.where(F.col("stop") & (F.col("steps") <= most)).select("seg_id", F.col("up").alias("above"))


def reach_after_removal(edges: DataFrame, sources: DataFrame, scenarios: DataFrame) -> DataFrame:
    """scenario, node: nodes that no source reaches once a scenario's edge is gone (columns scenario, seg_id).

    Exact on any graph.  Only what lies below a removed edge can be lost, so a scenario's work is its region:
    the nodes that the edge's head reaches.  Of these, a source, or a node that an edge from outside the
    region still feeds, keeps its supply and passes it on within the region; the others are lost.  Where every scenario
    removes one edge of an acyclic graph, regions are not walked: what is lost is read off the dominator forest.
    """
    gone = settle(scenarios.select("scenario", "seg_id").distinct())
    if (d := _single(edges, sources, gone)) is not None:
        return tree.under(d.ups, d.fed.join(gone, "seg_id"), "scenario").select("scenario", "node")
    none = F.array().cast("array<" + scenarios.schema["scenario"].dataType.simpleString() + ">")
    e = edges.select("seg_id", "src", "dst").join(gone.groupBy("seg_id").agg(F.collect_set("scenario").alias("removed_in")), "seg_id", "left")
    e = settle(e.withColumn("removed_in", F.coalesce("removed_in", none)))
    before = settle(hops(edges, sources, directed=True).select("node"))
    tails = gone.join(e, "seg_id").join(before.withColumnRenamed("node", "src"), "src", "left_semi").select("scenario", F.col("dst").alias("node"))
    # every node of the region was reached before, as the head of an edge that was
    region = settle(hops(e.withColumn("removed_in", none), tails, directed=True, scenario=True).select("scenario", "node"))
    into = region.join(e, F.col("node") == F.col("dst")).where(~F.array_contains("removed_in", F.col("scenario"))).select("scenario", "node", "src")
    into = into.join(before.withColumnRenamed("node", "src"), "src", "left_semi")
    inner = region.withColumnRenamed("node", "src")
    fed = into.join(inner, ["scenario", "src"], "left_anti").select("scenario", "node")
    fed = fed.unionByName(region.join(sources.select("node").distinct(), "node", "left_semi").select("scenario", "node"))
    kept = settle(fed.distinct())
    front, step = kept, settle(into.join(inner, ["scenario", "src"], "left_semi"))
    for _ in range(CAP):
        new = front.select("scenario", F.col("node").alias("src")).join(step, ["scenario", "src"]).select("scenario", "node").distinct()
        front = settle(new.join(kept, ["scenario", "node"], "left_anti"))
        if not front.limit(1).count():
            return region.join(kept, ["scenario", "node"], "left_anti")
        kept = settle(kept.unionByName(front))
    raise RuntimeError("supply within the regions did not settle")


def _single(edges: DataFrame, sources: DataFrame, gone: DataFrame) -> tree.Dominators | None:
    """The dominators, if each scenario (scenario, seg_id) removes one edge and the graph has no cycle of feeds."""
    of_edges = edges.select("seg_id").join(gone.select("seg_id").distinct(), "seg_id").groupBy("seg_id").count().where("count > 1")
    if gone.groupBy("scenario").count().where("count > 1").limit(1).count() or of_edges.limit(1).count():
        return None
    try:
        return tree.dominators(edges, sources)
    except ValueError:
        return None


def losses(edges: DataFrame, sources: DataFrame, dominated: tree.Dominators | None = None) -> DataFrame:
    """scenario, node for the removal of every single edge of an acyclic graph: what no source reaches any more.

    What an edge's removal cuts off is what its head dominates (``tree.dominators``), so the pairs are read off a
    forest, each once; sums over what is lost need no pairs (``failure.single_failures``).  Scenarios whose removal
    loses nothing have no row.
    """
    d = dominated or tree.dominators(edges, sources)
    return tree.under(d.ups, d.fed.withColumnRenamed("seg_id", "scenario"), "scenario").select("scenario", "node")


def nearest_node(nodes: DataFrame, x: float, y: float) -> DataFrame:
    """One row: the node nearest to a point, ties to the lesser id."""
    return nodes.select("node", F.hypot(F.col("x") - x, F.col("y") - y).alias("distance")).orderBy("distance", "node").limit(1)
