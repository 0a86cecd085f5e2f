"""Sums by doubling, dominators and reach against plain walks, on trees, acyclic graphs and graphs with cycles."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import failure, graph, supply, tree

EDGES = "seg_id string, src long, dst long, length_m double, v double"


def build(spark, rows):
    return spark.createDataFrame([(f"e{i}", s, d, 1.0, float(3 ** (i % 7) + i)) for i, (s, d) in enumerate(rows)], EDGES)


def reached(rows, start, gone=None):
    out, todo = set(start), list(start)
    while todo:
        u = todo.pop()
        for i, (s, d) in enumerate(rows):
            if s == u and i != gone and d not in out:
                out.add(d)
                todo.append(d)
    return out


def acyclic(seed, n=22, extra=7):
    rng = random.Random(seed)
    rows = [(rng.randrange(max(0, i - 6), i), i) for i in range(1, n)]
    rows += [tuple(sorted(rng.sample(range(n), 2))) for _ in range(extra)]
    rows += [(101, 102), (102, 103), (101, 103), (103, 7)]  # a part without a source, which also feeds one with a source
    return rows + [(200, 201), (201, 12)]  # a second source


def brute_losses(rows, sources):
    before = reached(rows, sources)
    return {(f"e{i}", v) for i in range(len(rows)) for v in before - reached(rows, sources, i)}


@pytest.mark.parametrize("seed", [1, 2])
def test_losses_by_dominators(spark, seed):
    rows = acyclic(seed)
    e, sources = build(spark, rows), spark.createDataFrame([(0,), (200,)], "node long")
    want = brute_losses(rows, [0, 200])
    forest = tree.dominators(e, sources)
    assert {(r["scenario"], r["node"]) for r in graph.losses(e, sources, forest).collect()} == want
    cells = e.select("seg_id", F.when(F.col("src") % 2 == 0, "D").otherwise("E").alias("district"), F.when(F.col("dst") % 3 == 0, "x").otherwise("y").alias("crop_class"), F.col("v").alias("area_ha"))
    counts, area = failure.single_failures(e, forest, cells)
    lost = {f"e{i}": {j for j, (s, _) in enumerate(rows) if j == i or (f"e{i}", s) in want} for i in range(len(rows))}
    assert {r["scenario"]: r["segments_cut_off"] for r in counts.collect()} == {k: len(x) for k, x in lost.items()}
    sums = {}
    for k, x in lost.items():
        for j in x:
            s, d = rows[j]
            key = (k, "ED"[s % 2 == 0], "yx"[d % 3 == 0])
            sums[key] = sums.get(key, 0) + 3 ** (j % 7) + j
    assert {(r["scenario"], r["district"], r["crop_class"]): r["ha"] for r in area.collect()} == sums
    canals = e.select("seg_id", F.when(F.col("dst") % 4 > 0, F.concat(F.lit("c"), (F.col("dst") % 4).cast("string"))).otherwise("").alias("canal"))
    got = {r["scenario"]: r["canals"] for r in failure.cut_canals(e, forest, canals).collect()}
    named = {k: sorted({f"c{rows[j][1] % 4}" for j in x if rows[j][1] % 4}) for k, x in lost.items()}
    assert got == {k: x for k, x in named.items() if x}


def test_dominators_refuse_cycles(spark):
    sources = spark.createDataFrame([(0,)], "node long")
    with pytest.raises(ValueError, match="cycle"):
        tree.dominators(build(spark, [(0, 1), (1, 2), (2, 3), (3, 1)]), sources)
    with pytest.raises(ValueError, match="cycle"):
        tree.dominators(build(spark, [(0, 9), (1, 2), (2, 3), (3, 1)]), sources)


@pytest.mark.parametrize(("seed", "back"), [(3, 0), (4, 6)])
def test_downstream_sums_on_any_graph(spark, seed, back):
    rng = random.Random(seed)
    rows = acyclic(seed) + [tuple(sorted(rng.sample(range(22), 2), reverse=True)) for _ in range(back)]
    rows += [(300, 301), (301, 302), (302, 300), (302, 303)] + [(400, 400)]  # a ring that nothing enters, and a loop
    value = [3 ** (i % 7) + i for i in range(len(rows))]
    want = {}
    for i, (_, d) in enumerate(rows):
        below = reached(rows, [d])
        want[f"e{i}"] = value[i] + sum(x for j, x in enumerate(value) if j != i and rows[j][0] in below)
    got = {r["seg_id"]: (r["own"], r["total"]) for r in graph.downstream_sum(build(spark, rows), "v").collect()}
    assert got == {k: (value[int(k[1:])], x) for k, x in want.items()}


def test_tree_betweenness_refuses_what_is_no_forest(spark):
    with pytest.raises(ValueError, match="forest"):
        graph.tree_betweenness(build(spark, [(0, 1), (0, 2), (1, 3), (2, 3)]))
    with pytest.raises(ValueError, match="forest"):
        graph.tree_betweenness(build(spark, [(0, 1), (1, 2), (2, 0)]))


def test_routes_stand_for_paths(spark):
    """Supply, marginals and protected hectares by doubling equal those from the pairs, with parts without supply."""
    rows = acyclic(5) + [(26, 27)]
    e, sources = build(spark, rows), spark.createDataFrame([(0,), (200,)], "node long")
    rng = random.Random(6)
    segs = spark.createDataFrame([(f"e{i}", float(rng.randrange(40)), rng.choice([0.0, 0.3, rng.random(), 1.0])) for i in range(len(rows)) if i % 9], "seg_id string, local_ha double, health double")
    level = graph.hops(e, sources, directed=True)
    way, paths = supply.routes(e, level), graph.supply_paths(e, level)
    plain = lambda df: {r[0]: r[1] for r in df.collect()}
    assert plain(supply.route_probability(segs, way)) == pytest.approx(plain(supply.supply_probability(segs, paths)))
    assert plain(supply.route_marginals(segs, way)) == pytest.approx(plain(supply.marginals(segs, paths)))
    some = segs.where("seg_id in ('e1', 'e4', 'e20')")
    assert supply.route_protected(segs, way, some).first()[0] == pytest.approx(supply.protected(segs, paths, some).first()[0])


def test_intervals_number_what_lies_below(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(i), i) for i in range(1, 30)] + [(50, 51), (50, 52)] + [(60, 61 + i) for i in range(12)]
    e = build(spark, rows)
    got = {r["node"]: (r["enter"], r["size"]) for r in tree.intervals(tree.forest(e).ups, tree.ends(e)).collect()}
    assert sorted(a for a, _ in got.values()) == list(range(len(got)))
    for v, (a, n) in got.items():
        assert {u for u, (b, _) in got.items() if a <= b < a + n} == reached(rows, [v])


def test_a_long_chain(spark):
    """20,000 edges in a row: passes grow with the logarithm of the depth."""
    n = 20_000
    e = spark.range(n).select(F.col("id").alias("seg_id"), F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1.0).alias("v"))
    f = tree.forest(e)
    assert f.plain and len(f.ups) == 15
    total = graph.downstream_sum(e, "v")
    assert total.where(F.col("total") == n - F.col("seg_id")).count() == n
    depth = tree.above(f.ups, tree.ends(e).withColumn("k", F.lit(1)), "k")
    assert depth.where(F.col("k") == F.col("node") + 1).count() == n + 1
