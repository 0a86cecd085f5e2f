"""Graph, supply, failure and naming on hand-made networks."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from sluice.functions import geo
from sluice.functions import params as P
from sluice.operators import failure, graph, lines, naming, spatial, supply
from sluice.sources import grids
from sluice.state import ranked

EDGES = "seg_id string, src long, dst long, length_m double"


def edges(spark, *rows):
    return spark.createDataFrame([(f"e{a}-{b}", a, b, float(w)) for a, b, w in rows], EDGES)


def nodes(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "node long")


@pytest.fixture(scope="module")
def diamond(spark):
    return edges(spark, (0, 1, 1), (0, 2, 1), (1, 3, 1), (2, 3, 1), (3, 4, 1))


def pairs(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_closure_of_a_cycle(spark):
    e = edges(spark, (1, 2, 1), (2, 3, 1), (3, 1, 1), (3, 4, 1))
    assert pairs(graph.closure(e), "anc", "des") == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4)}


def test_components_and_loops(spark):
    e = edges(spark, (5, 4, 1), (4, 9, 1), (7, 8, 1), (6, 6, 1), *[(i, i + 1, 1) for i in range(20, 60)])
    got = dict(pairs(graph.components(e), "node", "component"))
    assert got == {4: 4, 5: 4, 9: 4, 7: 7, 8: 7, 6: 6, **{i: 20 for i in range(20, 61)}}


def test_parallel_edges(spark):
    rows = [("a", 1, 2, 5.0, 0), ("b", 2, 1, 7.0, 1), ("c", 1, 2, 7.0, 2), ("d", 3, 3, 9.0, 3)]
    e = spark.createDataFrame(rows, EDGES + ", seq long")
    assert pairs(graph.simple_edges(e), "seg_id") == {("b",)}


def test_levels_and_orientation(spark):
    e = edges(spark, (2, 1, 1), (1, 0, 1), (2, 3, 1), (3, 2, 1))
    level = graph.hops(e, nodes(spark, 0))
    assert dict(pairs(level, "node", "level")) == {0: 0, 1: 1, 2: 2, 3: 3}
    assert pairs(graph.orient(e, level), "src", "dst") == {(1, 2), (0, 1), (2, 3)}


def test_failures_of_a_diamond(spark, diamond):
    lost = graph.losses(diamond, nodes(spark, 0))
    assert pairs(lost, "scenario", "node") == {("e0-1", 1), ("e0-2", 2), ("e3-4", 4)}
    every = diamond.select(F.col("seg_id").alias("scenario"), "seg_id")
    assert pairs(graph.reach_after_removal(diamond, nodes(spark, 0), every), "scenario", "node") == pairs(lost, "scenario", "node")
    joint = spark.createDataFrame([("j", "e1-3"), ("j", "e2-3")], "scenario string, seg_id string")
    assert pairs(graph.reach_after_removal(diamond, nodes(spark, 0), joint), "node") == {(3,), (4,)}
    cut = failure.lost_segments(diamond, lost, every)
    assert pairs(cut.where("scenario = 'e0-1'"), "seg_id") == {("e0-1",), ("e1-3",)}


def random_tree(n, seed):
    rng = random.Random(seed)
    return [(rng.randrange(i), i, rng.randrange(1, 9)) for i in range(1, n)]


def test_tree_forms_agree(spark):
    t = random_tree(40, 3)
    e = edges(spark, *t)
    a = dict(pairs(graph.tree_betweenness(e), "seg_id", "betweenness"))
    b = dict(pairs(graph.betweenness(e), "seg_id", "betweenness"))
    assert a == pytest.approx(b)
    e = e.withColumn("ha", F.col("length_m"))
    total = dict(pairs(graph.downstream_sum(e, "ha"), "seg_id", "total"))
    kids = {}
    for s, d, w in t:
        kids.setdefault(s, []).append((d, w))

    def below(v):
        return sum(w + below(d) for d, w in kids.get(v, []))

    assert total == {f"e{s}-{d}": w + below(d) for s, d, w in t}


def test_betweenness_splits_ties(spark, diamond):
    b = dict(pairs(graph.betweenness(diamond), "seg_id", "betweenness"))
    n = 5 * 4
    assert b["e0-1"] == pytest.approx((1 + 0.5 + 0.5) / n) and b["e3-4"] == pytest.approx(4 / n)


def plain_betweenness(nodes, arcs):
    """By the counts of shortest paths between all pairs; weights are integers."""
    far = {(s, t): 0 if s == t else math.inf for s in nodes for t in nodes}
    for _, u, v, w in arcs:
        far[u, v] = min(far[u, v], w) if u != v else 0
    for m in nodes:
        for s in nodes:
            for t in nodes:
                far[s, t] = min(far[s, t], far[s, m] + far[m, t])
    ways = {}
    for s in nodes:
        for t in sorted(nodes, key=lambda t: far[s, t]):
            into = [ways[s, u] for _, u, v, w in arcs if v == t and u != v and far[s, u] < math.inf and far[s, u] + w == far[s, t]]
            ways[s, t] = 1 if s == t else sum(into)
    n = len(nodes)
    return {
        i: sum(ways[s, u] * ways[v, t] / ways[s, t] for s in nodes for t in nodes if s != t and u != v and far[s, t] < math.inf and far[s, u] + w + far[v, t] == far[s, t]) / (n * (n - 1))
        for i, u, v, w in arcs
    }


def test_betweenness_against_all_pairs(spark):
    """Cycles, ties, edges side by side, loops and a part of its own; one batch of sources or several."""
    rng = random.Random(8)
    arcs = [(f"r{i}", rng.randrange(14), rng.randrange(14), rng.randrange(1, 4)) for i in range(40)] + [("twin", 0, 1, 1), ("twin2", 0, 1, 1), ("far", 20, 21, 5), ("loop", 20, 20, 1)]
    e = spark.createDataFrame(arcs, "seg_id string, src long, dst long, length_m long")
    nodes = sorted({x for _, u, v, _ in arcs for x in (u, v)})
    want = plain_betweenness(nodes, arcs)
    assert dict(pairs(graph.betweenness(e), "seg_id", "betweenness")) == pytest.approx(want)
    assert dict(pairs(graph.betweenness(e, sources=6), "seg_id", "betweenness")) == pytest.approx(want)
    got = graph.betweenness(e, pivots=9).collect()
    assert {r["seg_id"] for r in got} == set(want) and all(0 < r["error"] and abs(r["betweenness"] - want[r["seg_id"]]) <= r["error"] for r in got)
    for bad in (0, None):
        with pytest.raises(ValueError, match="positive"):
            graph.betweenness(spark.createDataFrame([("a", 0, 1, 1), ("b", 1, 2, bad)], "seg_id string, src long, dst long, length_m long"))
    assert graph.betweenness(e.limit(0)).count() == 0


def test_downstream_sum_in_a_cycle(spark):
    e = edges(spark, (1, 2, 1), (2, 3, 10), (3, 1, 100), (3, 4, 1000)).withColumn("v", F.col("length_m"))
    assert dict(pairs(graph.downstream_sum(e, "v"), "seg_id", "total")) == {"e1-2": 1111, "e2-3": 1111, "e3-1": 1111, "e3-4": 1000}


def test_chainage_and_named_above(spark):
    e = edges(spark, (0, 1, 5), (1, 2, 5), (0, 2, 20), (2, 3, 1))
    assert dict(pairs(graph.chainage(e, nodes(spark, 0)), "node", "metres")) == {0: 0, 1: 5, 2: 10, 3: 11}
    segs = spark.createDataFrame([(i, "n" if i == 0 else "") for i in range(100)], "seg_id long, name string")
    up = spark.createDataFrame([(i, i - 1) for i in range(1, 100)], "seg_id long, up long")
    got = dict(pairs(graph.named_above(segs, up, F.col("name") != ""), "seg_id", "above"))
    assert got == {i: 0 for i in range(1, 81)}


def brute_supply(tree, health, local):
    parent = {d: (s, f"e{s}-{d}") for s, d, _ in tree}
    p, path = {}, {}
    for s, d, _ in tree:
        at, on = d, []
        while at in parent:
            at, seg = parent[at]
            on.append(seg)
        path[f"e{s}-{d}"] = on
        p[f"e{s}-{d}"] = math.prod(health[x] for x in on)
    return path, p


@pytest.fixture(scope="module")
def net(spark):
    tree = random_tree(30, 8)
    rng = random.Random(1)
    health = {f"e{s}-{d}": round(rng.uniform(0.2, 1), 3) for s, d, _ in tree}
    local = {k: float(rng.randrange(50)) for k in health}
    e = edges(spark, *tree)
    segs = spark.createDataFrame([(k, local[k], health[k], float(100 + 10 * i), i) for i, k in enumerate(health)], "seg_id string, local_ha double, health double, cost_inr double, rank long")
    paths = graph.supply_paths(e, graph.hops(e, nodes(spark, 0), directed=True))
    return tree, health, local, segs, paths


def test_supply(net, spark):
    tree, health, local, segs, paths = net
    path, p = brute_supply(tree, health, local)
    assert pairs(paths, "seg_id", "on_path") == {(a, b) for a, on in path.items() for b in on}
    assert dict(pairs(supply.supply_probability(segs, paths), "seg_id", "p_supply")) == pytest.approx(p)
    risk = supply.at_risk(segs, paths).first()[0]
    assert risk == pytest.approx(sum(local[k] * (1 - p[k]) for k in p)) and 0 <= risk <= sum(local.values())
    m = dict(pairs(supply.marginals(segs, paths), "seg_id", "marginal_ha"))
    for k in list(health)[:6]:
        _, q = brute_supply(tree, health | {k: max(health[k], 0.95)}, local)
        want = sum(local[x] * (q[x] - p[x]) for x in p)
        assert m[k] == pytest.approx(want, abs=1e-9)
        assert supply.protected(segs, paths, segs.where(F.col("seg_id") == k)).first()[0] == pytest.approx(want, abs=1e-9)


def test_greedy(net, spark):
    tree, health, local, segs, paths = net
    rows = segs.orderBy("rank").collect()
    cost = {r["seg_id"]: r["cost_inr"] for r in rows}
    budgets = spark.createDataFrame([("a", 500.0), ("b", 2500.0)], "scenario string, budget double")
    got = supply.greedy_plan(segs, paths, budgets).collect()
    for name, budget in (("a", 500.0), ("b", 2500.0)):
        h, spent, want = dict(health), 0.0, []
        left = [r["seg_id"] for r in rows]
        while True:
            _, p = brute_supply(tree, h, local)
            best = None
            for k in left:
                if spent + cost[k] <= budget:
                    _, q = brute_supply(tree, h | {k: max(h[k], 0.95)}, local)
                    g = sum(local[x] * (q[x] - p[x]) for x in p)
                    if g / max(cost[k], 1) > (best[0] if best else 1e-12):
                        best = (g / max(cost[k], 1), k)
            if not best:
                break
            left.remove(best[1])
            h[best[1]] = max(h[best[1]], 0.95)
            spent += cost[best[1]]
            want.append(best[1])
        own = sorted((r for r in got if r["scenario"] == name), key=lambda r: r["work_order"])
        assert [r["seg_id"] for r in own] == want and sum(r["cost_inr"] for r in own) <= budget
        assert own[-1]["cumulative_ha"] == pytest.approx(sum(r["marginal_ha"] for r in own))
        chosen = segs.where(F.col("seg_id").isin(want))
        assert supply.protected(segs, paths, chosen).first()[0] == pytest.approx(own[-1]["cumulative_ha"])


def test_plan_by_routes_is_the_greedy_plan(net, spark):
    """One batch, and batches of few candidates, make the picks that the pairs of paths make."""
    tree_, _, _, segs, paths = net
    e = edges(spark, *tree_)
    way = supply.routes(e, graph.hops(e, nodes(spark, 0), directed=True))
    budgets = spark.createDataFrame([("a", 500.0), ("b", 2500.0)], "scenario string, budget double")
    want = sorted(supply.greedy_plan(segs, paths, budgets).collect())
    for most in (100, 9):
        got = sorted(supply.route_plan(segs, way, budgets, most=most).collect())
        assert [r[:4] for r in got] == [r[:4] for r in want]
        assert [x for r in got for x in r[4:]] == pytest.approx([x for r in want for x in r[4:]])


def test_plan_and_outcomes_without_pairs(net, spark, monkeypatch):
    """One candidate at the start: the others are found by what they would have beaten, and gains are summed but once."""
    tree_, _, _, segs, paths = net
    e = edges(spark, *tree_)
    way = supply.routes(e, graph.hops(e, nodes(spark, 0), directed=True))
    budgets = spark.createDataFrame([("a", 2500.0)], "scenario string, budget double")
    want = sorted(supply.greedy_plan(segs, paths, budgets).collect())
    sums, whole = [], supply.route_marginals
    monkeypatch.setattr(supply, "route_marginals", lambda *a, **k: sums.append(1) or whole(*a, **k))
    got = sorted(supply.route_plan(segs, way, budgets, most=4).collect())
    assert [r[:4] for r in got] == [r[:4] for r in want] and len(sums) == 1
    assert [x for r in got for x in r[4:]] == pytest.approx([x for r in want for x in r[4:]])
    ids = [r["seg_id"] for r in segs.select("seg_id").collect()]
    taken = spark.createDataFrame([(t, s) for t in range(4) for k, s in enumerate(sorted(ids)) if k % (t + 1) == 0], f"trial int, seg_id {segs.schema['seg_id'].dataType.simpleString()}")
    a, b = ({r["trial"]: r["protected_ha"] for r in f(segs, x, taken).collect()} for f, x in ((supply.trial_outcomes, paths), (supply.route_outcomes, way)))
    assert b == pytest.approx(a)


def test_baseline_trials(net, spark):
    _, _, _, segs, paths = net
    orders = supply.weighted_orders(segs.withColumn("weight", F.lit(1.0)), 6)
    assert orders.groupBy("trial").count().where("count <> 29").count() == 0
    taken = supply.skip_fill(orders, 900.0)
    by = {}
    for r in orders.orderBy("trial", "pos").collect():
        spent, items = by.setdefault(r["trial"], [0.0, []])
        if spent + r["cost_inr"] <= 900:
            by[r["trial"]][0] += r["cost_inr"]
            items.append(r["seg_id"])
    assert pairs(taken, "trial", "seg_id") == {(t, s) for t, (_, items) in by.items() for s in items}
    out = {r["trial"]: r["protected_ha"] for r in supply.trial_outcomes(segs, paths, taken).collect()}
    for t, (_, items) in by.items():
        assert out[t] == pytest.approx(supply.protected(segs, paths, segs.where(F.col("seg_id").isin(items))).first()[0])


def test_ranking(spark):
    rows = [("a", 10.0, 2.0, 0.5), ("b", 20.0, 0.0, None), ("c", 20.0, 0.0, 0.9)]
    got = {r["seg_id"]: r for r in supply.rank_segments(spark.createDataFrame(rows, "seg_id string, command_ha double, betweenness double, health_score double")).collect()}
    assert got["b"]["health"] == pytest.approx(0.7) and got["a"]["priority"] == pytest.approx(10) and [got[k]["rank"] for k in "abc"] == [1, 2, 3]


def test_failure_record_and_decisions(spark, diamond):
    every = diamond.select(F.col("seg_id").alias("scenario"), "seg_id")
    lost = failure.lost_segments(diamond, graph.losses(diamond, nodes(spark, 0)), every)
    segs = diamond.select("seg_id", F.when(F.col("src") == 0, "D1").otherwise("D2").alias("district"), F.when(F.col("dst") == 4, 0.0).otherwise(100.0).alias("cost_inr"), F.lit(10.0).alias("local_ha"))
    cells = segs.select("seg_id", "district", F.lit("paddy").alias("crop_class"), F.lit(10.0).alias("area_ha"))
    eco = spark.createDataFrame([("D1", 2.0), ("D2", 3.0)], "district string, revenue_per_ha double")
    r = {x["scenario"]: x for x in failure.failure_records(lost, segs, cells, eco).collect()}
    assert r["e0-1"]["segments_cut_off"] == 2 and r["e0-1"]["area_lost_ha"] == 20 and r["e0-1"]["revenue_at_risk_inr"] == 40
    assert r["e0-1"]["ha_by_crop"] == {"paddy": 20.0} and [tuple(x) for x in r["e0-1"]["ha_by_district"]] == [("D1", 10.0), ("D2", 10.0)]
    assert r["e3-4"]["benefit_cost_ratio"] is None
    combined = {x["district"]: x for x in failure.combined_impact(lost, every.where("scenario in ('e0-1', 'e3-4')"), segs, eco).collect()}
    assert combined["D2"]["area_ha"] == 20 and combined["D2"]["revenue_inr"] == 60
    assert sum(x["area_ha"] for x in combined.values()) == 30
    scored = spark.createDataFrame([("x", 10.0, 0.5, 4.0), ("y", 5.0, 0.9, 8.0)], "canal string, revenue_inr double, health double, area_ha double")
    v = failure.verdict(failure.decision_score(scored)).first()
    assert v["winner"] == "x" and v["gap"] == pytest.approx(100 * (0.4 + 0.175 + 0.125) - 100 * (0.2 + 0.035 + 0.25))
    assert failure.verdict(failure.decision_score(scored.limit(1))).count() == 0


def test_reach_names(spark):
    segs = spark.createDataFrame(
        [(1, 0, "Main", "Main Canal", "P", 1000.0), (2, 1, "Main", "Main Canal", "P", 2000.0), (3, 2, " nan", "Distributary", "P", 500.0), (4, 9, None, "Minor", "Q", 700.0), (5, 9, "", "Minor", "Q", 800.0)],
        "seg_id long, src long, can_name string, can_type string, prj_name string, length_m double",
    )
    chain = spark.createDataFrame([(0, 0.0), (1, 1000.0), (2, 3000.0)], "node long, metres double")
    up = spark.createDataFrame([(2, 1), (3, 2)], "seg_id long, up long")
    n = {r["seg_id"]: r for r in naming.reach_names(segs, chain, up).collect()}
    assert n[1]["name"] == "Main · head reach" and n[2]["name"] == "Main · reach 2/2" and n[1]["label"] == "head reach · 1.0 km" and n[2]["label"] == "reach 2/2 · 2.0 km · from km 1.0"
    assert n[3]["name"] == "Distributary off Main at km 3.0" and n[3]["group"] == "Distributaries off Main" and n[3]["derived"]
    assert n[4]["name"] == "Minor, Q at km ? (0.7 km)" and n[5]["name"] == "Minor, Q at km ? (0.8 km)" and n[4]["group"] == "Q · unnamed reaches"
    assert n[3]["km_from"] == 3.0 and n[4]["km_from"] is None
    assert n[3]["label"] == "at km 3.0 · 0.5 km" and n[4]["label"] == "Minor at km ? · 0.7 km"
    # a canal whose head lies at km 20: an offtake 1 km below it is at km 1 of that canal
    far = chain.withColumn("metres", F.col("metres") + 20_000)
    n = {r["seg_id"]: r for r in naming.reach_names(segs, far, up).collect()}
    assert n[3]["name"] == "Distributary off Main at km 3.0" and n[3]["km_from"] == 23.0 and n[2]["label"] == "reach 2/2 · 2.0 km · from km 1.0"


def line(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in pts]


def test_segment_keys(spark):
    """Ids that depend on the ends and the length in whole metres, ties to even, and on nothing else."""
    rows = [(line((0.5, 1.5), (10.2, -0.3)),), (line((2.5, -0.0), (3, 4), (355000.49, 1800000.5)),)]
    g = spark.createDataFrame(rows, "geom array<struct<x:double,y:double>>")
    for r in g.select("geom", lines.segment_key(F.col("geom"), geo.length(F.col("geom"))).alias("k")).collect():
        p = [(q["x"], q["y"]) for q in r["geom"]]
        size = sum(math.dist(a, b) for a, b in zip(p[:-1], p[1:], strict=True))
        text = f"{p[0][0]:.0f},{p[0][1]:.0f}|{p[-1][0]:.0f},{p[-1][1]:.0f}|{size:.0f}"
        assert r["k"] == "SEG_" + hashlib.md5(text.encode()).hexdigest()[:10]


def test_removals_on_a_cyclic_graph(spark):
    """Against a search from the sources for every scenario, with cycles, two sources and several cuts at once."""
    rng = random.Random(6)
    edges = [(i, rng.randrange(14), rng.randrange(14)) for i in range(30)]
    cuts = [(s, rng.randrange(30)) for s in range(25) for _ in range(rng.randrange(1, 4))]
    sources = [0, 5]

    def reached(gone):
        seen, todo = set(sources), list(sources)
        while todo:
            u = todo.pop()
            for i, a, b in edges:
                if a == u and i not in gone and b not in seen:
                    seen.add(b)
                    todo.append(b)
        return seen

    want = {(s, v) for s in range(25) for v in reached(set()) - reached({i for t, i in cuts if t == s})}
    e = spark.createDataFrame(edges, "seg_id long, src long, dst long")
    got = graph.reach_after_removal(e, nodes(spark, *sources), spark.createDataFrame(cuts, "scenario long, seg_id long"))
    assert pairs(got, "scenario", "node") == want and want


def test_ranks_without_one_task(spark):
    rows = [(i, float(i * 7919 % 101)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, v double").repartition(7)
    got = {r["id"]: r["n"] for r in ranked(df, "n", F.desc("v"), F.asc("id")).collect()}
    assert got == {i: k + 1 for k, (i, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}


def test_nearest_says_when_it_finds_none(spark):
    one = spark.createDataFrame([(1, 0.0, 0.0)], "id long, x double, y double")
    far = spark.createDataFrame([(2, 1e9, 0.0)], "id long, x double, y double")
    with pytest.raises(RuntimeError):
        spatial.nearest(one, far, 1.0, rounds=3)
    assert spatial.nearest(one, far.limit(0), 1.0).count() == 0


def test_noding_and_building(spark):
    rows = [(1, line((0, 0), (1000, 0))), (2, line((500, 10), (500, 400))), (3, line((500, 402), (700, 600)))]
    g = spark.createDataFrame(rows, "id long, geom array<struct<x:double,y:double>>")
    pieces = lines.node_lines(g)
    got = sorted((r["id"], r["piece"], [(p["x"], p["y"]) for p in r["geom"]]) for r in pieces.collect())
    assert got[0] == (1, 0, [(0, 0), (500, 0)]) and got[1] == (1, 1, [(500, 0), (1000, 0)]) and len(got) == 4
    e, n = lines.build_segments(pieces)
    assert e.count() == 4 and n.count() == 5 and e.select("seg_id").distinct().count() == 4
    assert graph.components(e).select("component").distinct().count() == 1


def test_attach_loose_parts(spark):
    geo_t = "seg_id string, src long, dst long, length_m double, geom array<struct<x:double,y:double>>, is_river int, is_virtual int"
    rows = [("m", 1, 2, 1000.0, line((0, 0), (1000, 0)), 0, 0), ("l", 3, 4, 100.0, line((400, 300), (400, 400)), 0, 0), ("r", 5, 6, 50.0, line((0, 900), (50, 900)), 1, 0), ("far", 7, 8, 10.0, line((0, 9000), (10, 9000)), 0, 0)]
    at = spark.createDataFrame([(1, 0.0, 0.0), (2, 1000.0, 0.0), (3, 400.0, 300.0), (4, 400.0, 400.0), (5, 0.0, 900.0), (6, 50.0, 900.0), (7, 0.0, 9000.0), (8, 10.0, 9000.0)], "node long, x double, y double")
    e, n = lines.attach(spark.createDataFrame(rows, geo_t), at, 0.0, 0.0)
    got = {r["seg_id"]: r for r in e.collect()}
    key = lambda *k: "SEG_" + hashlib.md5("|".join(k).encode()).hexdigest()[:10]
    head, tail = key("0,0", "400,0", "400"), key("400,0", "1000,0", "600")
    assert set(got) == {head, tail, "l", "CONN_001", "far"} and got["CONN_001"]["length_m"] == pytest.approx(300) and got["CONN_001"]["is_virtual"] == 1
    assert got[head]["length_m"] == pytest.approx(400) and n.count() == 9
    # a connector says that it is one, and a place within a decimal of a node is that node
    more = spark.createDataFrame(rows, geo_t).withColumns({"can_type": F.lit("Main"), "prj_name": F.lit("P"), "can_name": F.lit("M")})
    made = {r["seg_id"]: r for r in lines.attach(more, at, 0.0, 0.0)[0].collect()}
    assert (made["CONN_001"]["can_type"], made["CONN_001"]["prj_name"], made["CONN_001"]["can_name"]) == ("Connector", "CONNECTOR", "virtual offtake link") and made[head]["can_type"] == "Main"
    near = [rows[0], ("l", 3, 4, 100.0, line((0.04, 300), (0.04, 400)), 0, 0)]
    close = at.where("node in (1, 2)").unionByName(spark.createDataFrame([(3, 0.04, 300.0), (4, 0.04, 400.0)], at.schema))
    e2, n2 = lines.attach(spark.createDataFrame(near, geo_t), close, 0.0, 0.0)
    assert {r["seg_id"]: (r["src"], r["dst"]) for r in e2.collect()} == {"m": (1, 2), "l": (3, 4), "CONN_001": (1, 3)} and n2.count() == 4
    out, nn = lines.orient_network(e, n, 0.0, 0.0)
    assert {r["seg_id"]: (r["src"], r["dst"]) for r in out.collect()}["l"] == (3, 4)
    assert nn.where("is_source").count() == 2


def test_spatial_joins(spark):
    rng = random.Random(2)
    pts = [(i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(120)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    d = lambda p, q: math.hypot(p[1] - q[1], p[2] - q[2])
    assert pairs(spatial.within(df, df, 12.0), "id", "rid") == {(p[0], q[0]) for p in pts for q in pts if d(p, q) <= 12}
    near = spatial.nearest(df.where("id < 10"), df.where("id >= 60"), 1.0)
    assert dict(pairs(near, "id", "rid")) == {p[0]: min(pts[60:], key=lambda q: (d(p, q), q[0]))[0] for p in pts[:10]}
    ls = spark.createDataFrame([("s1", line((-50, 0), (0, 0), (0, 50)), 1), ("s0", line((10, -50), (10, 50)), 0)], "seg_id string, geom array<struct<x:double,y:double>>, rank int")

    def dl(p, pts2):
        best = math.inf
        for (ax, ay), (bx, by) in zip(pts2[:-1], pts2[1:], strict=True):
            t = max(0, min(1, ((p[1] - ax) * (bx - ax) + (p[2] - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
            best = min(best, math.hypot(ax + t * (bx - ax) - p[1], ay + t * (by - ay) - p[2]))
        return best

    want = {}
    for p in pts:
        c = [(k, x, s) for s, k, g in (("s1", 1, [(-50, 0), (0, 0), (0, 50)]), ("s0", 0, [(10, -50), (10, 50)])) if (x := dl(p, g)) <= 15]
        if c:
            want[p[0]] = min(c)[2]
    assert dict(pairs(spatial.serve(df, ls, 15.0), "id", "seg_id")) == want


def test_wkb_round_trip(spark):
    g = spark.createDataFrame([(1, line((0, 1), (2.5, -3)))], "id long, geom array<struct<x:double,y:double>>")
    back = g.select(grids.from_wkb(grids.to_wkb("geom")).alias("g")).first()["g"]
    assert [(p["x"], p["y"]) for p in back] == [(0, 1), (2.5, -3)]


def test_parameters(spark):
    assert P.params(spark).where("status = 'assumed'").count() > 0 and set(P.CROP_PRICE) == set(P.CROP_YIELD)


def test_noding_and_betweenness_take_whole_tables(spark, sf):
    from sluice.plans import extra, network, registry  # noqa: F401
    from sluice.plans import testmap as T

    q = registry.QUERIES
    edges = {r["seg_id"] for r in T.network(spark, sf).collect()}
    assert {r["seg_id"] for r in q["G7_betweenness"](spark, sf).collect()} == edges
    ids = {r["vec_id"] for r in T.table(spark, sf, "embeddings").select("vec_id").collect()}
    assert {r["id"] for r in q["X4_noding"](spark, sf).select("id").distinct().collect()} == ids


def test_betweenness_batches_follow_reach(spark, monkeypatch):
    rows = [(i, (i + 1) // 2, i + 1, 1.0 + i % 3) for i in range(40)] + [(100 + s, 3 * s + 1, 7 * s + 11, 2.0) for s in range(1, 4)]
    e = spark.createDataFrame(rows, "seg_id long, src long, dst long, length_m double")
    made, shares = [], graph._path_shares
    monkeypatch.setattr(graph, "_path_shares", lambda *a: made.append(1) or shares(*a))
    want = {r["seg_id"]: r["betweenness"] for r in graph.betweenness(e).collect()}
    got = {r["seg_id"]: r["betweenness"] for r in graph.betweenness(e, sources=5).collect()}
    assert len(made) == 2 and got == pytest.approx(want)  # one batch each, where five sources a batch had made nine
