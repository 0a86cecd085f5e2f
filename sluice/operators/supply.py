"""Supply along paths, budgets, and the ranking of segments.

``paths`` is a sparse table (seg_id, on_path): the segments that supply seg_id, itself included.
``segs`` has seg_id, local_ha and health; rivers and connectors are no segments here and conduct freely.
"""

from __future__ import annotations

import functools
import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..functions.params import VALUES
from ..functions.scalar import clip, uniform
from ..state import if_small, ranked, settle, settle_counted, spread
from . import graph, tree

TARGET = VALUES["target_health"]
CAP = 10_000


def supply_probability(segs: DataFrame, paths: DataFrame) -> DataFrame:
    """seg_id, p_supply: the product of the healths along the path, each held to [0.01, 1]."""
    h = segs.select(F.col("seg_id").alias("on_path"), F.ln(clip(F.col("health"), 0.01, 1.0)).alias("_l"))
    p = paths.join(h, "on_path").groupBy("seg_id").agg(F.exp(F.sum("_l")).alias("p_supply"))
    return segs.select("seg_id").join(p, "seg_id", "left").select("seg_id", F.coalesce("p_supply", F.lit(1.0)).alias("p_supply"))


class Routes(NamedTuple):
    """The ways from the sources as a forest, a row a node: ``edges`` (seg_id, src, dst), ``nodes`` that are reached,
    ``up`` (node, parent_seg) and the forest's steps.  It stands for the pairs of ``graph.supply_paths``."""

    edges: DataFrame
    nodes: DataFrame
    up: DataFrame
    ups: list[DataFrame]


def routes(edges: DataFrame, levels: DataFrame) -> Routes:
    up = settle(graph.parents(edges, levels))
    return Routes(settle(edges.select("seg_id", "src", "dst")), settle(levels.select("node")), up.select("node", "parent_seg"), tree.steps(up.select("node", F.col("parent").alias("up"))))


def route_probability(segs: DataFrame, way: Routes) -> DataFrame:
    """seg_id, p_supply as ``supply_probability`` has it: sums of log health up the forest, by doubling."""
    h = settle(segs.select("seg_id", F.ln(clip(F.col("health"), 0.01, 1.0)).alias("_l")))
    entry = way.nodes.join(way.up, "node", "left").join(h.withColumnRenamed("seg_id", "parent_seg"), "parent_seg", "left").select("node", F.coalesce("_l", F.lit(0.0)).alias("_sum"))
    at = tree.above(way.ups, entry, "_sum").withColumnRenamed("node", "src")
    p = way.edges.join(h, "seg_id").join(at, "src").select("seg_id", F.exp(F.col("_l") + F.col("_sum")).alias("p_supply"))
    return segs.select("seg_id").join(p, "seg_id", "left").select("seg_id", F.coalesce("p_supply", F.lit(1.0)).alias("p_supply"))


def route_marginals(segs: DataFrame, way: Routes, target: float = TARGET) -> DataFrame:
    """seg_id, marginal_ha as ``marginals`` has it: expected supply is summed below each segment, by doubling."""
    s = segs.join(route_probability(segs, way), "seg_id").select("seg_id", (F.col("local_ha") * F.col("p_supply")).alias("_s"))
    s = settle(way.edges.join(s, "seg_id"))
    reached = s.join(way.nodes.withColumnRenamed("node", "src"), "src", "left_semi")
    fed = tree.below(way.ups, way.nodes.join(reached.select(F.col("src").alias("node"), "_s"), "node", "left").select("node", F.coalesce("_s", F.lit(0.0)).alias("_s")), "_s")
    under = way.up.join(fed, "node").select(F.col("parent_seg").alias("seg_id"), F.col("_s").alias("_under"))
    served = reached.select("seg_id", "_s").join(under, "seg_id", "left").select("seg_id", (F.col("_s") + F.coalesce("_under", F.lit(0.0))).alias("_s"))
    h = clip(F.col("health"), 0.01, 1.0)
    return segs.join(served, "seg_id", "left").select("seg_id", ((F.greatest(h, F.lit(target)) / h - 1) * F.coalesce("_s", F.lit(0.0))).alias("marginal_ha"))


def expected_loss(segs: DataFrame, probability: DataFrame) -> DataFrame:
    """One row: at_risk_ha, the area that a failure along its path would leave dry, in expectation."""
    return segs.join(probability, "seg_id").agg(F.sum(F.col("local_ha") * (1 - F.col("p_supply"))).alias("at_risk_ha"))


def route_protected(segs: DataFrame, way: Routes, chosen: DataFrame) -> DataFrame:
    """One row: protected_ha, what cleaning the chosen segments takes off the area at risk."""
    a = expected_loss(segs, route_probability(segs, way))
    b = expected_loss(segs, route_probability(cleaned(segs, chosen), way)).withColumnRenamed("at_risk_ha", "_after")
    return a.join(b).select((F.col("at_risk_ha") - F.col("_after")).alias("protected_ha"))


def at_risk(segs: DataFrame, paths: DataFrame) -> DataFrame:
    """One row: at_risk_ha, the area that a failure along its path would leave dry, in expectation."""
    return segs.join(supply_probability(segs, paths), "seg_id").agg(F.sum(F.col("local_ha") * (1 - F.col("p_supply"))).alias("at_risk_ha"))


def cleaned(segs: DataFrame, chosen: DataFrame, target: float = TARGET) -> DataFrame:
    """``segs`` with the health of the chosen ones raised to the target."""
    c = chosen.select("seg_id").distinct().withColumn("_c", F.lit(True))
    return segs.join(c, "seg_id", "left").withColumn("health", F.when(F.col("_c"), F.greatest("health", F.lit(target))).otherwise(F.col("health"))).drop("_c")


def protected(segs: DataFrame, paths: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row: protected_ha, what cleaning the chosen segments takes off the area at risk."""
    a, b = at_risk(segs, paths), at_risk(cleaned(segs, chosen), paths).withColumnRenamed("at_risk_ha", "_after")
    return a.join(b).select((F.col("at_risk_ha") - F.col("_after")).alias("protected_ha"))


def marginals(segs: DataFrame, paths: DataFrame, target: float = TARGET) -> DataFrame:
    """seg_id, marginal_ha: what cleaning one segment alone protects, in closed form: the relative rise of
    its health times the expected supply of all that it is on the path of."""
    p = segs.join(supply_probability(segs, paths), "seg_id").select("seg_id", (F.col("local_ha") * F.col("p_supply")).alias("_s"))
    served = paths.join(p, "seg_id").groupBy(F.col("on_path").alias("seg_id")).agg(F.sum("_s").alias("_s"))
    h = clip(F.col("health"), 0.01, 1.0)
    return segs.join(served, "seg_id", "left").select("seg_id", ((F.greatest(h, F.lit(target)) / h - 1) * F.coalesce("_s", F.lit(0.0))).alias("marginal_ha"))


def greedy_plan(segs: DataFrame, paths: DataFrame, budgets: DataFrame, target: float = TARGET, most: int = 20_000_000) -> DataFrame:
    """scenario, work_order, seg_id, cost_inr, marginal_ha, cumulative_ha: the best hectares a rupee, round by round.

    ``segs`` also has cost_inr and rank (ties go to the lesser rank); ``budgets`` has scenario and budget.
    Scenarios run side by side.  One task holds one network, so ``paths`` is the unit to split by: a
    network's components are independent but for the budget.  Of more than ``most`` pairs of paths (16 bytes
    each) it raises an error, rather than bring them to one place.
    """
    import numpy as np
    import pandas as pd

    spark = segs.sparkSession
    if (pairs := paths.count()) > most:
        raise ValueError(f"{pairs} path pairs are more than the {most} that one plan takes: split the network")
    table = segs.select("seg_id", F.col("local_ha").cast("double"), clip(F.col("health"), 0.01, 1.0).alias("health"), F.col("cost_inr").cast("double"), "rank").orderBy("rank", "seg_id").toPandas()
    pairs = paths.toPandas()
    sent = spark.sparkContext.broadcast((table, pairs))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t, pr = sent.value
        at = pd.Series(np.arange(len(t)), index=t["seg_id"])
        keep = pr["seg_id"].isin(at.index) & pr["on_path"].isin(at.index)
        i, c = at[pr["seg_id"][keep]].to_numpy(), at[pr["on_path"][keep]].to_numpy()
        h, cost, local = t["health"].to_numpy(), t["cost_inr"].to_numpy(), t["local_ha"].to_numpy()
        order = np.argsort(c, kind="stable")
        i, c = i[order], c[order]
        head = np.searchsorted(c, np.arange(len(t) + 1))
        rise = np.maximum(h, target) / h - 1
        p = np.ones(len(t))
        np.multiply.at(p, i, h[c])
        out = []
        for scenario, budget in zip(pdf["scenario"], pdf["budget"], strict=True):
            s, left, spent, total, n = local * p, rise.copy(), 0.0, 0.0, 0
            while True:
                gain = left * np.bincount(c, weights=s[i], minlength=len(t))
                score = np.where((spent + cost <= budget) & (gain > 0), gain / np.maximum(cost, 1.0), -1.0)
                b = int(score.argmax()) if len(score) else 0
                if not len(score) or score[b] <= 0:
                    break
                n, spent, total = n + 1, spent + cost[b], total + gain[b]
                out.append((scenario, n, t["seg_id"][b], cost[b], gain[b], total))
                s[i[head[b] : head[b + 1]]] *= 1 + rise[b]
                left[b] = 0
        return pd.DataFrame(out, columns=["scenario", "work_order", "seg_id", "cost_inr", "marginal_ha", "cumulative_ha"])

    kinds = f"scenario {budgets.schema['scenario'].dataType.simpleString()}, work_order int, seg_id {segs.schema['seg_id'].dataType.simpleString()}, cost_inr double, marginal_ha double, cumulative_ha double"
    return budgets.select("scenario", F.col("budget").cast("double")).groupBy("scenario").applyInPandas(run, kinds)


#: Candidates that a plan starts with, and that it takes on at a time.
CANDIDATES = 5_000


def route_plan(segs: DataFrame, way: Routes, budgets: DataFrame, target: float = TARGET, most: int = CANDIDATES) -> DataFrame:
    """The plan of ``greedy_plan`` without the pairs of paths.

    A pick raises what the segments below it serve by a factor, and what those above it serve by an amount, and changes
    nothing else.  So gains are summed once, by doubling, and followed from pick to pick by places in the forest
    (``tree.intervals``).  The driver plans over the ``most`` best candidates; then every other segment is led through
    these picks, and those that would have beaten one of them become candidates too (the earliest first, ``most`` at a
    time), until there are none: the plan is then that over all segments.
    """
    import numpy as np

    spark = segs.sparkSession
    h = clip(F.col("health"), 0.01, 1.0)
    segs = settle(segs.select("seg_id", F.col("local_ha").cast("double").alias("local_ha"), h.alias("health"), F.col("cost_inr").cast("double").alias("cost_inr"), "rank"))
    at = tree.intervals(way.ups, way.nodes)
    head = way.up.join(at, "node").select(F.col("parent_seg").alias("seg_id"), F.col("enter").alias("low"), (F.col("enter") + F.col("size")).alias("high"))
    place = way.edges.join(at.select(F.col("node").alias("src"), F.col("enter").alias("at")), "src").select("seg_id", "at").join(head, "seg_id", "left")
    rise = F.greatest(F.col("health"), F.lit(target)) / F.col("health") - 1
    able = route_marginals(segs, way, target).where("marginal_ha > 0").join(segs, "seg_id").join(place, "seg_id").withColumn("up", rise)
    none = F.lit(-1).cast("long")  # segments that nothing lies below
    able = settle(able.select("seg_id", "rank", "cost_inr", "up", (F.col("marginal_ha") / F.col("up")).alias("served"), "at", F.coalesce("low", none).alias("low"), F.coalesce("high", none).alias("high")))
    per = F.col("up") * F.col("served") / F.greatest("cost_inr", F.lit(1.0))
    kept = StructType([*able.schema.fields, StructField("_t", IntegerType()), StructField("_score", DoubleType())])
    out = []
    for scenario, budget in budgets.select("scenario", F.col("budget").cast("double")).collect():  # a few
        top = able.where(F.col("cost_inr") <= budget).orderBy(per.desc(), "rank", "seg_id").limit(most).collect()
        for _ in range(CAP):
            top.sort(key=lambda r: (r["rank"], r["seg_id"]))
            picks = _greedy(np, top, budget)
            late = able.mapInPandas(_beaten(picks, {r["seg_id"] for r in top}, budget), kept)
            late = late.orderBy("_t", F.desc("_score"), "rank", "seg_id").limit(most).drop("_t", "_score").collect()
            if not late:
                break
            top += late
        else:
            raise RuntimeError("segments outside the candidates were still better after the last round")
        total = 0.0
        for n, p in enumerate(picks):
            total += p.gain
            out.append((scenario, n + 1, p.row["seg_id"], p.row["cost_inr"], p.gain, total))
    kinds = f"scenario {budgets.schema['scenario'].dataType.simpleString()}, work_order int, seg_id {segs.schema['seg_id'].dataType.simpleString()}, cost_inr double, marginal_ha double, cumulative_ha double"
    return spark.createDataFrame(out, kinds)


class _Pick(NamedTuple):
    row: Row
    score: float
    spent: float  # before it
    gain: float


def _greedy(np, top: list[Row], budget: float) -> list[_Pick]:
    """The picks among these candidates, which are in the order of ties."""
    col = lambda c, kind: np.array([r[c] for r in top], dtype=kind)
    cost, up, served = col("cost_inr", float), col("up", float), col("served", float)
    at, low, high = col("at", np.int64), col("low", np.int64), col("high", np.int64)
    picks, spent = [], 0.0
    while len(top):
        score = np.where((spent + cost <= budget) & (up * served > 0), up * served / np.maximum(cost, 1.0), -1.0)
        b = int(score.argmax())
        if score[b] <= 0:
            break
        gain = float(up[b] * served[b])
        picks.append(_Pick(top[b], float(score[b]), spent, gain))
        spent += float(cost[b])
        served[(low <= at[b]) & (at[b] < high)] += gain
        served[(at >= low[b]) & (at < high[b])] *= 1 + up[b]
        up[b] = 0.0
    return picks


def _beaten(picks: list[_Pick], known: set, budget: float):
    """Rows that are no candidates and would have come before a pick, or after the last one: with the first such place
    and their score there.  Their gains go through the very steps that those of candidates go through."""

    def run(batches):
        import numpy as np

        for pdf in batches:
            pdf = pdf[~pdf["seg_id"].isin(known) & (pdf["cost_inr"] <= budget)]
            cost, up, served = (pdf[c].to_numpy(dtype=float) for c in ("cost_inr", "up", "served"))
            served, at, low, high = served.copy(), pdf["at"].to_numpy(), pdf["low"].to_numpy(), pdf["high"].to_numpy()
            rank, ids, base = pdf["rank"].to_numpy(), pdf["seg_id"].to_numpy(), np.maximum(cost, 1.0)
            first, best, spent = np.full(len(pdf), -1, dtype=np.int32), np.zeros(len(pdf)), 0.0
            for t, p in enumerate(picks):
                score, r = up * served / base, p.row
                near = np.flatnonzero((score >= p.score) & (first < 0))
                if len(near):
                    tied = (rank[near] < r["rank"]) | ((rank[near] == r["rank"]) & (ids[near] < r["seg_id"]))
                    near = near[(p.spent + cost[near] <= budget) & ((score[near] > p.score) | tied)]
                    first[near], best[near] = t, score[near]
                served[(low <= r["at"]) & (r["at"] < high)] += p.gain
                served[(at >= r["low"]) & (at < r["high"])] *= 1 + r["up"]
                spent = p.spent + r["cost_inr"]
            left = (first < 0) & (spent + cost <= budget) & (up * served > 0)
            first[left], best[left] = len(picks), (up * served / base)[left]
            pdf = pdf.assign(_t=first, _score=best)
            yield pdf[pdf["_t"] >= 0]

    return run


def complaint_weight(health, length_m):
    """How likely a segment is to be picked by complaint: poor and long ones more."""
    return F.greatest((1 - health) * F.sqrt(length_m), F.lit(1e-9))


#: Rows of a trial that one task ranks, about.
RANGE_ROWS = 100_000


def _keys(segs: DataFrame, trials: int, seed: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """trial, seg_id, cost_inr, _k = -ln(u) / weight, which orders a trial, from ``low`` to below ``high``; a missing weight
    comes first.  Keys are held to the bounds where they are made, so that each is made once."""
    t = spread(segs, "seg_id").withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))
    k = F.coalesce(F.nanvl(-F.ln(uniform(F.lit(seed), F.col("trial"), F.col("seg_id"))) / F.col("weight"), F.lit(math.inf)), F.lit(-1.0))
    within = lambda x: (F.lit(True) if low is None else x >= low) & (F.lit(True) if high is None else x < high)
    return t.select("trial", "seg_id", "cost_inr", k.alias("_k") if low is high is None else F.explode(F.filter(F.array(k), within)).alias("_k"))


def _placed(t: DataFrame, n: int) -> DataFrame:
    """``t`` (trial, seg_id, _k and more, of ``n`` segments) with each row's place in its trial as pos, from 1.

    Rows meet by trial and range of ln(_k), and ranges are counted before.  Whatever the weights, no more than 1 / e of a
    trial's keys are expected in a range of width 1 (the density of ln(-ln(u)) has its maximum there), so a width for
    ``RANGE_ROWS`` rows is known without a sample, and rows are shuffled once.
    """
    width = min(1.0, math.e * RANGE_ROWS / max(1, n))
    t = t.withColumn("_b", F.coalesce(F.floor(F.ln("_k") / width), F.lit(-(2**62))))
    counts, ranges = settle_counted(t.groupBy("trial", "_b").agg(F.count(F.lit(1)).alias("_n")))
    ahead = Window.partitionBy("trial").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("trial", "_b", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_first"))
    own = F.row_number().over(Window.partitionBy("trial", "_b").orderBy("_k", "seg_id"))
    return t.withColumn("_own", own).join(if_small(first, ranges), ["trial", "_b"]).withColumn("pos", F.col("_first") + F.col("_own")).drop("_b", "_own", "_first")


def weighted_orders(segs: DataFrame, trials: int, seed: int = 42) -> DataFrame:
    """trial, pos, seg_id, cost_inr: for each trial a weighted random order, by exponential keys -ln(u) / weight."""
    s, n = settle_counted(segs.select("seg_id", "cost_inr", "weight"))
    return _placed(settle(_keys(s, trials, seed)), n).select("trial", F.col("pos").cast("int").alias("pos"), "seg_id", "cost_inr")


#: Rows of a trial's front that ``weighted_fill`` ranks first, about, and by how much each next front is longer.
FRONT, LONGER = 2000, 16


def weighted_fill(segs: DataFrame, trials: int, budget: float, seed: int = 42, front: int = FRONT) -> DataFrame:
    """trial, seg_id as ``skip_fill`` has them for ``weighted_orders``, without ranking whole trials.

    The fronts of all trials, keys below some bound, are filled first.  Of what comes later only items that cost no more
    than what is left can be taken, so every next front has only those; it ends when there are none, or with the last key.
    """
    spark = segs.sparkSession
    s = settle(segs.select("seg_id", F.col("cost_inr").cast("double").alias("cost_inr"), "weight"))
    rest = spark.range(trials).select(F.col("id").cast("int").alias("trial"), F.lit(float(budget)).alias("rest"))
    n, weight = s.agg(F.count(F.lit(1)), F.sum(F.when(~F.isnan("weight"), F.col("weight")))).first()
    out, low, share = [], None, front
    while True:
        most = rest.agg(F.max("rest")).first()[0]
        able, items = settle_counted(s.where(F.col("cost_inr") <= F.lit(most)))
        if out and not items:
            break
        high = None if share >= n or not weight else share / weight  # no more than share keys are expected below it
        t = settle(_keys(able, trials, seed, low, high).join(if_small(rest, trials), "trial").where(F.col("cost_inr") <= F.col("rest")))
        out.append(settle(_filled(_placed(t, items).withColumnRenamed("cost_inr", "cost"))))
        if high is None:
            break
        spent = out[-1].groupBy("trial").agg(F.sum("cost").alias("_s"))
        rest = settle(rest.join(spent, "trial", "left").select("trial", (F.col("rest") - F.coalesce("_s", F.lit(0.0))).alias("rest")))
        low, share = high, share * LONGER
    return functools.reduce(DataFrame.unionByName, out).select("trial", "seg_id")


#: Items of a trial that one range of positions is made for.
RANGE_ITEMS = 2000


def skip_fill(orders: DataFrame, budget: float) -> DataFrame:
    """trial, seg_id of the items taken: each in turn if it still fits."""
    left = orders.select("trial", "pos", "seg_id", F.col("cost_inr").cast("double").alias("cost"), F.lit(float(budget)).alias("rest"))
    return _filled(left.where(F.col("cost") <= F.col("rest"))).select("trial", "seg_id")


def _filled(left: DataFrame) -> DataFrame:
    """trial, seg_id, cost of the items taken from ``left`` (trial, pos, seg_id, cost, rest: what the trial has left).

    A round takes, in every trial, the longest run of items from the front that fits as a whole, which the walk would take
    too, passes the one that ends it, and drops what is dearer than what is left.  Costs are summed by ranges of
    positions first, so a trial is spread over tasks.  Every round takes one item at least, and mostly many.
    """
    left = left.select("trial", F.col("pos").cast("long").alias("pos"), "seg_id", "cost", "rest")
    out = []
    for _ in range(CAP):
        left, n = settle_counted(left)
        if not n and out:
            return functools.reduce(DataFrame.unionByName, out)
        part = F.floor(F.col("pos") / RANGE_ITEMS).alias("part")
        sums = left.groupBy("trial", part).agg(F.sum("cost").alias("s"))
        ahead = sums.select("trial", "part", F.coalesce(F.sum("s").over(Window.partitionBy("trial").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("ahead"))
        run = F.sum("cost").over(Window.partitionBy("trial", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
        x = settle(left.withColumn("part", part).withColumn("run", run).join(ahead, ["trial", "part"]).withColumn("sum", F.col("ahead") + F.col("run")).drop("part", "run", "ahead"))
        fits = F.col("sum") <= F.col("rest")  # sums grow along a trial, so what fits is its front
        out.append(x.where(fits).select("trial", "seg_id", "cost"))
        per = x.groupBy("trial").agg(F.min(F.when(~fits, F.col("pos"))).alias("stop"), F.coalesce(F.max(F.when(fits, F.col("sum"))), F.lit(0.0)).alias("spent"))
        left = x.where(~fits).join(per, "trial").where("pos > stop").withColumn("rest", F.col("rest") - F.col("spent")).where("cost <= rest").select("trial", "pos", "seg_id", "cost", "rest")
    raise RuntimeError("items were left after the last round")


def trial_outcomes(segs: DataFrame, paths: DataFrame, taken: DataFrame, target: float = TARGET) -> DataFrame:
    """trial, protected_ha: what each trial's choice protects; all trials in one job."""
    h = clip(F.col("health"), 0.01, 1.0)
    rise = segs.select(F.col("seg_id").alias("on_path"), F.ln(F.greatest(h, F.lit(target)) / h).alias("_r"))
    base = segs.join(supply_probability(segs, paths), "seg_id").select("seg_id", (F.col("local_ha") * F.col("p_supply")).alias("_s"))
    up = taken.select("trial", F.col("seg_id").alias("on_path")).join(rise, "on_path").join(paths, "on_path").groupBy("trial", "seg_id").agg(F.sum("_r").alias("_r"))
    got = up.join(base, "seg_id").groupBy("trial").agg(F.sum(F.col("_s") * (F.exp("_r") - 1)).alias("protected_ha"))
    return taken.select("trial").distinct().join(got, "trial", "left").select("trial", F.coalesce("protected_ha", F.lit(0.0)).alias("protected_ha"))


def route_outcomes(segs: DataFrame, way: Routes, taken: DataFrame, target: float = TARGET) -> DataFrame:
    """trial, protected_ha as ``trial_outcomes`` has it, without the pairs of paths: what an item protects alone, times the
    rises of the trial's items above it, summed.  Ways up are followed for the items taken only."""
    h = clip(F.col("health"), 0.01, 1.0)
    items = settle(taken.select("trial", "seg_id").distinct())
    once = settle(items.select("seg_id").distinct().join(way.edges.select("seg_id", "src"), "seg_id"))
    above = tree.pairs(way.ups, once.select(F.col("src").alias("node")).distinct())
    above = above.join(way.up.withColumnRenamed("node", "anc"), "anc").select(F.col("node").alias("src"), F.col("parent_seg").alias("above"))
    above = settle(above.join(once.select(F.col("seg_id").alias("above")), "above", "left_semi").join(once, "src").select("seg_id", "above"))
    rise = segs.select(F.col("seg_id").alias("above"), F.ln(F.greatest(h, F.lit(target)) / h).alias("_r"))
    lifted = items.join(above, "seg_id").join(items.withColumnRenamed("seg_id", "above"), ["trial", "above"]).join(rise, "above").groupBy("trial", "seg_id").agg(F.sum("_r").alias("_r"))
    got = items.join(route_marginals(segs, way, target), "seg_id").join(lifted, ["trial", "seg_id"], "left").groupBy("trial").agg(F.sum(F.col("marginal_ha") * F.exp(F.coalesce("_r", F.lit(0.0)))).alias("protected_ha"))
    return items.select("trial").distinct().join(got, "trial", "left").select("trial", F.coalesce("protected_ha", F.lit(0.0)).alias("protected_ha"))


def trial_summary(outcomes: DataFrame, plan_ha: float) -> DataFrame:
    """trials, mean, median, p10, p90, factor of the plan over the mean, share of trials that the plan beats."""
    x = F.col("protected_ha")
    s = outcomes.agg(F.count(F.lit(1)).alias("trials"), F.avg(x).alias("mean_ha"), F.median(x).alias("median_ha"), F.percentile(x, F.lit(0.1)).alias("p10_ha"), F.percentile(x, F.lit(0.9)).alias("p90_ha"), F.avg((x < plan_ha).cast("double")).alias("beaten"))
    return s.withColumn("factor", F.try_divide(F.lit(float(plan_ha)), F.col("mean_ha")))


def rank_segments(segs: DataFrame, alpha: float = VALUES["betweenness_weight"]) -> DataFrame:
    """Adds bc_norm, health (median where missing), priority, priority_norm and rank.

    ``segs`` has seg_id, command_ha, betweenness and health_score (null where there are no points).
    """
    top = segs.agg(F.max("betweenness").alias("_b"), F.percentile("health_score", F.lit(0.5)).alias("_h"))
    s = segs.join(F.broadcast(top)).withColumn("bc_norm", F.when(F.col("_b") > 0, F.col("betweenness") / F.col("_b")).otherwise(0.0)).withColumn("health", F.coalesce("health_score", "_h"))
    s = settle(s.withColumn("priority", F.col("command_ha") * (1 - F.col("health")) * (1 + alpha * F.col("bc_norm"))).drop("_b", "_h"))
    s = s.join(F.broadcast(s.agg(F.max("priority").alias("_m")))).withColumn("priority_norm", F.when(F.col("_m") > 0, F.col("priority") / F.col("_m")).otherwise(0.0)).drop("_m")
    return ranked(s, "rank", F.desc("priority"), F.asc("seg_id"))
