"""What steps make, rather than what they return: pairs made once, fronts instead of whole trials, regions not walked."""

import math
import random

import pytest

from sluice import state
from sluice.operators import graph, spatial, supply, tree


@pytest.fixture
def settled(monkeypatch):
    """The columns and plans of the tables that graph and tree write."""
    seen = []

    def kept(df):
        seen.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return state.settle(df)

    monkeypatch.setattr(graph, "settle", kept)
    monkeypatch.setattr(tree, "settle", kept)
    return seen


def made(spark, pairs):
    return spark.createDataFrame([(i, a, b, 1.0) for i, (a, b) in enumerate(pairs)], "seg_id long, src long, dst long, length_m double")


def test_large_sides_are_not_broadcast_while_settled(spark, monkeypatch):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(state, "BROADCAST_BYTES", 1000)
    seen = []
    with state._few_broadcasts(spark):
        seen.append(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
        assert "BroadcastHashJoin" not in spark.range(5000).join(spark.range(5000), "id")._jdf.queryExecution().executedPlan().toString()
    assert seen == ["1000"] and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == was


def test_closure_makes_each_pair_once(spark, settled):
    rng = random.Random(5)
    pairs = [(i // 2, i) for i in range(1, 14)] + [(rng.randrange(14), rng.randrange(14)) for _ in range(4)] + [(20, 21), (21, 22), (22, 20), (22, 23), (30, 30)]
    want = {(a, b) for a, b in pairs}
    while more := {(a, d) for a, b in want for c, d in want if b == c} - want:
        want |= more
    got = [tuple(r) for r in graph.closure(made(spark, pairs)).select("anc", "des").collect()]
    assert len(got) == len(want) and set(got) == want
    assert not any(set(c) == {"anc", "des"} and "Aggregate" in plan for c, plan in settled)


def test_supply_paths_make_each_pair_once(spark, settled):
    e = made(spark, [(i // 2, i) for i in range(1, 14)])
    got = [tuple(r) for r in graph.supply_paths(e, graph.hops(e, spark.createDataFrame([(0,)], "node long"), directed=True)).collect()]
    up = {i: i // 2 for i in range(1, 14)}
    want = set()
    for i in up:
        n = i
        while n in up:
            want.add((i - 1, n - 1))
            n = up[n]
    assert len(got) == len(want) and set(got) == want
    assert not any(set(c) == {"anc", "des"} and "Aggregate" in plan for c, plan in settled)


def test_single_removals_walk_no_regions(spark, monkeypatch):
    e = made(spark, [(i // 2, i) for i in range(1, 14)] + [(2, 7), (3, 10)])
    gone = e.selectExpr("seg_id as scenario", "seg_id")
    src = spark.createDataFrame([(0,)], "node long")
    edges = [(r["seg_id"], r["src"], r["dst"]) for r in e.collect()]

    def reached(without):
        seen, front = {0}, [0]
        while front:
            front = [b for i, a, b in edges if i != without and a in front and b not in seen]
            seen |= set(front)
        return seen

    want = {(i, n) for i, _, _ in edges for n in reached(None) - reached(i)}

    def walked(*_, **__):
        raise AssertionError("a region was walked")

    monkeypatch.setattr(graph, "hops", walked)
    assert {tuple(r) for r in graph.reach_after_removal(e, src, gone).select("scenario", "node").collect()} == want


@pytest.mark.parametrize(("budget", "front"), [(60.0, 5), (900.0, 5), (1e9, 5), (0.5, 5), (60.0, 10_000)])
def test_fronts_take_what_whole_trials_take(spark, budget, front):
    rng = random.Random(3)
    rows = [(i, float(rng.randint(1, 40)), rng.choice([None, 1e-9, 0.5, 2.0, 30.0])) for i in range(150)]
    s = spark.createDataFrame(rows, "seg_id long, cost_inr double, weight double")
    orders = supply.weighted_orders(s, 4).collect()
    cost, want = {i: c for i, c, _ in rows}, set()
    for trial in range(4):
        mine = sorted((r["pos"], r["seg_id"]) for r in orders if r["trial"] == trial)
        assert [p for p, _ in mine] == list(range(1, 151))
        left = budget
        for _, i in mine:
            if cost[i] <= left:
                left -= cost[i]
                want.add((trial, i))
    got = [tuple(r) for r in supply.weighted_fill(s, 4, budget, front=front).collect()]
    assert len(got) == len(want) and set(got) == want


def test_clusters_link_cells_not_points(spark, monkeypatch):
    rng = random.Random(8)
    pts = [(i, rng.uniform(0, 400), rng.uniform(0, 400)) for i in range(150)] + [(200 + i, 500 + rng.uniform(0, 3), 500 + rng.uniform(0, 3)) for i in range(150)]
    pts += [(400 + i, 20.0, 20.0) for i in range(50)] + [(500, None, 1.0), (501, float("nan"), 1.0), (502, float("nan"), 1.0), (503, float("inf"), 1.0)]
    root = list(range(len(pts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x, y) in enumerate(pts):
        for j, (_, u, v) in enumerate(pts[:i]):
            if x is not None and u is not None and (x - u) ** 2 + (y - v) ** 2 <= 25.0**2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    seen = []
    whole = graph.components
    monkeypatch.setattr(spatial, "components", lambda e: seen.append(e.count()) or whole(e))
    got = {r["id"]: r["cluster"] for r in spatial.cluster_points(spark.createDataFrame(pts, "id long, x double, y double"), 25.0).collect()}
    assert got == {p[0]: pts[find(i)][0] for i, p in enumerate(pts)}
    assert seen[0] <= 12 * 204  # the 150 points of one cell have no links of their own, which would be 11,175


def test_nearest_by_rank_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(9)
    spot = lambda i: (i, rng.gauss(0, 30), rng.gauss(0, 30))
    left = [spot(i) for i in range(300)] + [(i, 5.0, 5.0) for i in range(300, 330)] + [(330, None, 1.0), (331, float("nan"), 1.0), (332, 500.0, 500.0)]
    right = [(*spot(i), i % 3) for i in range(1000, 1600)] + [(i, 300 + rng.uniform(0, 1e-3), 300.0, 1) for i in range(1600, 2200)]
    right += [(i, 6.0, 5.0, 2) for i in range(2300, 2200, -1)] + [(2301, float("nan"), 1.0, 0), (2302, float("inf"), 1.0, 0)]
    left += [(400 + i, 300 + rng.uniform(-6, 6), 300 + rng.uniform(-6, 6)) for i in range(100)]  # around a clump of 600
    want = {}
    for i, x, y in left:
        got = [(r, math.hypot(x - u, y - v), j) for j, u, v, r in right if x is not None and math.hypot(x - u, y - v) <= 7.0]
        if got:
            want[i] = min(got)[::2]
    seen = []
    whole = spatial._nearer
    monkeypatch.setattr(spatial, "_nearer", lambda held, *a: seen.append(held.count()) or whole(held, *a))
    df = spark.createDataFrame(left, "id long, x double, y double"), spark.createDataFrame(right, "id long, x double, y double, rank int")
    assert {r["id"]: (r["rank"], r["rid"]) for r in spatial.best_within(*df, 7.0).collect()} == want
    # all pairs within the radius would be over 60,000 at the clump alone
    assert len(seen) > 2 and max(seen) < 20 * len(left)


def test_a_forest_reads_its_rows_once(spark):
    from pyspark.sql import functions as F

    from sluice.operators import health
    from sluice.plans import network

    read = spark.sparkContext.accumulator(0)

    def seen(v):
        read.add(1)
        return v

    rows = spark.createDataFrame([(float(i % 17), "good" if i % 3 else "bad") for i in range(200)], "a double, label string")
    made = rows.withColumn("a", F.udf(seen, "double").asNondeterministic()("a"))
    health.train_forest(made, ["a"], "label", trees=3)
    assert read.value == 200
    plan = network.labelled(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan and "Join" not in plan


def test_payload_scores_and_plants_once(spark, monkeypatch):
    from sluice.operators import naming
    from sluice.plans import network, registry

    calls, plans = [], []
    for module, name in ((tree, "forest"), (network, "scored_segments")):
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name), n=name: calls.append(n) or f(*a))
    monkeypatch.setattr(naming, "settle", lambda df: plans.append(df) or state.settle(df))
    out = registry.QUERIES["N2_payload"](spark, "/root/testdata/sf0.001")
    assert sorted(calls) == ["forest", "scored_segments"]
    # most reaches have no canal of their own: no window holds all of those
    for df in [*plans, out]:
        assert "windowspecdefinition(canal" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()
