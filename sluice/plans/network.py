"""Registered queries over the network: graph, supply, budget, failure, naming, spatial, labels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import scalar as S
from ..functions import stats
from ..operators import economics, failure, graph, health, naming, spatial, supply, tree
from ..state import ranked, settle, spread
from ..streaming import events as ev
from ..streaming import labels as lb
from . import testmap as T
from .registry import query

L = "bigint"
ROOT = 0
# The health of segments, from their points; segments without points get the median.
HEALTH = f"{T.POINTS}, hp AS (SELECT seg_id, 1 - avg(p_impaired) AS h0 FROM pt GROUP BY 1), hs AS (SELECT seg_id, round(coalesce(h0, (SELECT median(h0) FROM hp)), 6)::DOUBLE AS h FROM seg LEFT JOIN hp USING (seg_id))"
CLOSE = "cl(anc, des) AS (SELECT src, dst FROM {e} UNION SELECT anc, dst FROM cl JOIN {e} ON des = src)"
TREE = f"WITH RECURSIVE {T.SEG}, {CLOSE.format(e='seg')}"


def root(spark):
    return spark.createDataFrame([(ROOT,)], "node long")


def scored_segments(spark, d):
    """Segments with local_ha, health (rounded to 6 places) and length."""
    h = T.points(spark, d).groupBy("seg_id").agg((1 - F.avg("p_impaired")).alias("h0"))
    s = T.segments(spark, d).join(h, "seg_id", "left").join(T.local_area(spark, d), "seg_id", "left")
    m = h.agg(F.median("h0").alias("_m"))
    return s.join(F.broadcast(m)).withColumns({"health": F.round(F.coalesce("h0", "_m"), 6), "local_ha": F.coalesce("local_ha", F.lit(0.0))}).drop("h0", "_m")


# --- graph


@query("G1_components", "WITH RECURSIVE e AS (SELECT p_partkey + 1 AS a, (p_partkey + 1) // 2 AS b FROM part WHERE p_partkey % 7 <> 3), b AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), r(node, lab) AS (SELECT a, a FROM b UNION SELECT b.b, lab FROM r JOIN b ON r.node = b.a WHERE lab < b.b) SELECT node::BIGINT AS node, min(lab)::BIGINT AS component FROM r GROUP BY 1")
def _(spark, d):
    return graph.components(T.segments(spark, d).where("seg_id % 7 <> 3"))


@query("G1_report", f"WITH RECURSIVE {T.SEG}, s AS (SELECT * FROM seg WHERE seg_id % 7 <> 3), b AS (SELECT src AS a, dst AS b FROM s UNION ALL SELECT dst, src FROM s), r(node, lab) AS (SELECT a, a FROM b UNION SELECT b.b, lab FROM r JOIN b ON r.node = b.a WHERE lab < b.b), c AS (SELECT node, min(lab) AS component FROM r GROUP BY 1), k AS (SELECT component, sum(length_m) / 1000 AS km FROM s JOIN c ON node = src GROUP BY 1), g AS (SELECT component, count(*) AS nodes FROM c GROUP BY 1) SELECT component::BIGINT AS component, (row_number() OVER (ORDER BY nodes DESC, component) - 1)::BIGINT AS place, nodes::BIGINT AS nodes, round(km, 6) AS km, count(*) OVER () > 5 AS too_many FROM g JOIN k USING (component)")
def _(spark, d):
    e = T.segments(spark, d).where("seg_id % 7 <> 3")  # a cut network, which falls into many parts
    return graph.component_report(e).withColumn("km", F.round("km", 6))


@query("G2_simple_edges", "WITH e AS (SELECT event_id AS seq, user_id % 50 AS src, event_id % 37 AS dst, round(value) AS len FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY least(src, dst), greatest(src, dst) ORDER BY len DESC, seq) AS rn FROM e WHERE src <> dst) SELECT seq::BIGINT AS seq, src::BIGINT AS src, dst::BIGINT AS dst, len AS length_m FROM r WHERE rn = 1")
def _(spark, d):
    e = T.table(spark, d, "events").select(F.col("event_id").alias("seq"), (F.col("user_id") % 50).alias("src"), (F.col("event_id") % 37).alias("dst"), F.round("value").alias("length_m"))
    return graph.simple_edges(e)


@query("G4_orient", f"WITH RECURSIVE {T.SEG}, l(node, level) AS (SELECT 0, 0 UNION ALL SELECT dst, level + 1 FROM l JOIN seg ON src = node) SELECT seg_id, src::BIGINT AS src, dst::BIGINT AS dst, level::BIGINT AS level FROM seg JOIN l ON node = dst")
def _(spark, d):
    s = T.segments(spark, d)
    flipped = s.select("seg_id", F.when(F.col("seg_id") % 3 == 0, F.col("dst")).otherwise(F.col("src")).alias("src"), F.when(F.col("seg_id") % 3 == 0, F.col("src")).otherwise(F.col("dst")).alias("dst"))
    level = settle(graph.hops(flipped, root(spark)))
    return graph.orient(flipped, level).join(level, F.col("dst") == F.col("node")).select("seg_id", "src", "dst", "level")


@query("G5_closure", f"WITH RECURSIVE {T.NET}, {CLOSE.format(e='net')} SELECT anc::BIGINT AS anc, des::BIGINT AS des FROM cl")
def _(spark, d):
    return graph.closure(T.network(spark, d))


@query("G6_downstream", f"{TREE}, {T.LOCAL}, v AS (SELECT seg_id, src, dst, coalesce(local_ha, 0) AS ha FROM seg LEFT JOIN loc USING (seg_id)), b AS (SELECT src, sum(ha) AS ha FROM v GROUP BY 1) SELECT v.seg_id, v.ha AS own, v.ha + coalesce(any_value(h.ha), 0) + coalesce(sum(b.ha), 0) AS total FROM v LEFT JOIN b h ON h.src = v.dst LEFT JOIN cl ON anc = v.dst LEFT JOIN b ON b.src = des GROUP BY v.seg_id, v.ha")
def _(spark, d):
    s = T.segments(spark, d).join(T.local_area(spark, d), "seg_id", "left").withColumn("local_ha", F.coalesce("local_ha", F.lit(0.0)))
    return graph.downstream_sum(s, "local_ha")


@query("G7_tree_betweenness", f"{TREE}, n AS (SELECT count(*) + 1 AS n FROM seg), a AS (SELECT des, count(*) AS c FROM cl GROUP BY 1), b AS (SELECT anc, count(*) AS c FROM cl GROUP BY 1) SELECT seg_id, round((1 + coalesce(a.c, 0)) * (1 + coalesce(b.c, 0)) / (n * (n - 1))::DOUBLE, 12) AS betweenness FROM seg LEFT JOIN a ON a.des = src LEFT JOIN b ON b.anc = dst, n")
def _(spark, d):
    return graph.tree_betweenness(T.segments(spark, d)).withColumn("betweenness", F.round("betweenness", 12))


@query("G7_betweenness")
def _(spark, d):
    return graph.betweenness(T.network(spark, d)).withColumn("betweenness", F.round("betweenness", 10))


@query("G8_supply_paths", f"{TREE} SELECT s.seg_id, p.seg_id AS on_path FROM seg s JOIN seg p ON p.dst = s.src UNION ALL SELECT s.seg_id, p.seg_id FROM seg s JOIN cl ON des = s.src JOIN seg p ON p.dst = anc UNION ALL SELECT seg_id, seg_id FROM seg")
def _(spark, d):
    s = T.segments(spark, d)
    return graph.supply_paths(s, settle(graph.hops(s, root(spark), directed=True)))


@query("G9_chainage", f"WITH RECURSIVE {T.NET}, r(node, m) AS (SELECT 0, 0.0::DOUBLE UNION SELECT dst, m + length_m FROM r JOIN net ON src = node) SELECT node::BIGINT AS node, min(m)::DOUBLE AS metres FROM r GROUP BY 1")
def _(spark, d):
    return graph.chainage(T.network(spark, d), root(spark))


@query("G10_named_above", f"WITH RECURSIVE {T.SEG}, r(seg_id, up, steps) AS (SELECT s.seg_id, p.seg_id, 1 FROM seg s JOIN seg p ON p.dst = s.src UNION ALL SELECT r.seg_id, p.seg_id, steps + 1 FROM r JOIN seg c ON c.seg_id = r.up JOIN seg p ON p.dst = c.src WHERE r.up % 5 <> 0 AND steps < 80) SELECT seg_id, up AS above FROM r WHERE up % 5 = 0")
def _(spark, d):
    s = T.segments(spark, d)
    up = s.select("seg_id", F.col("src").alias("n")).join(s.select(F.col("dst").alias("n"), F.col("seg_id").alias("up")), "n").select("seg_id", "up")
    return graph.named_above(s, up, F.col("seg_id") % 5 == 0)


@query("G11_removal", f"WITH RECURSIVE {T.NET}, sc AS (SELECT seg_id AS scenario FROM net ), r(scenario, node) AS (SELECT scenario, 0 FROM sc UNION SELECT scenario, dst FROM r JOIN net ON src = node AND seg_id <> scenario), a(node) AS (SELECT 0 UNION SELECT dst FROM a JOIN net ON src = node) SELECT scenario, node::BIGINT AS node FROM sc, a EXCEPT SELECT scenario, node FROM r")
def _(spark, d):
    n = T.network(spark, d)
    sc = n.select(F.col("seg_id").alias("scenario"), "seg_id")
    return graph.reach_after_removal(n, root(spark), sc)


@query("G13_nearest_node", f"WITH {T.SPOTS} SELECT id AS node FROM sp ORDER BY sqrt((x - 0.1) ** 2 + (y + 0.05) ** 2), id LIMIT 1")
def _(spark, d):
    return graph.nearest_node(T.spots(spark, d).withColumnRenamed("id", "node"), 0.1, -0.05).select("node")


# --- spatial


@query("J8_within", f"WITH {T.SPOTS} SELECT a.id, b.id AS rid, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 8) AS d FROM sp a JOIN sp b ON sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.02 WHERE a.label < 5 AND b.label >= 5")
def _(spark, d):
    s = T.spots(spark, d)
    return spatial.within(s.where("label < 5"), s.where("label >= 5"), 0.02).select("id", "rid", F.round("d", 8).alias("d"))


@query("J9_priority_nearest", f"WITH {T.SPOTS}, j AS (SELECT a.id, b.id AS rid, b.label % 3 AS rank, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM sp a JOIN sp b ON sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.05 WHERE a.label < 5 AND b.label >= 5) SELECT id, rid AS seg_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rank, d, rid) AS rn FROM j) WHERE rn = 1")
def _(spark, d):
    s = T.spots(spark, d)
    to = s.where("label >= 5").withColumn("rank", F.col("label") % 3)
    return spatial.best_within(s.where("label < 5"), to, 0.05).select("id", F.col("rid").alias("seg_id"))


@query("J10_nearest", f"WITH {T.SPOTS}, j AS (SELECT a.id, b.id AS rid, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM sp a, sp b WHERE a.label < 2 AND b.label >= 5) SELECT id, rid, round(d, 8) AS d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, rid) AS rn FROM j) WHERE rn = 1")
def _(spark, d):
    s = T.spots(spark, d)
    return spatial.nearest(s.where("label < 2"), s.where("label >= 5"), 0.02).select("id", "rid", F.round("d", 8).alias("d"))


_BOX = "VALUES ('A', -0.2, -0.2, 0.05, 0.05), ('B', 0.0, 0.0, 0.3, 0.3), ('C', -0.3, 0.05, 0.0, 0.3)"


@query("J11_containing", f"WITH {T.SPOTS}, b(name, x0, y0, x1, y1) AS ({_BOX}) SELECT id, coalesce(min(name), 'UNKNOWN') AS name FROM sp LEFT JOIN b ON x > x0 AND x < x1 AND y > y0 AND y < y1 GROUP BY 1")
def _(spark, d):
    boxes = [("A", -0.2, -0.2, 0.05, 0.05), ("B", 0.0, 0.0, 0.3, 0.3), ("C", -0.3, 0.05, 0.0, 0.3)]
    ring = lambda a, b, c, e: [(a, b), (c, b), (c, e), (a, e), (a, b)]
    areas = spark.createDataFrame([(n, ring(*b)) for n, *b in boxes], "name string, ring array<struct<x:double,y:double>>")
    return spatial.containing(T.spots(spark, d), areas)


@query("J12_self_theta", f"WITH {T.SPOTS} SELECT a.id AS a, b.id AS b FROM sp a JOIN sp b ON a.id < b.id AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.01")
def _(spark, d):
    s = T.spots(spark, d).select("id", "x", "y")
    return spatial.within(s, s, 0.01).where("id < rid").select(F.col("id").alias("a"), F.col("rid").alias("b"))


_GRID = "(-0.5, -0.5, 0.5, 0.5)"
_CELLS = f"{T.SPOTS}, ix AS (SELECT id, x, y, least(greatest(round_even((x + 0.5) * 20 - 0.5, 0), 0), 19)::BIGINT AS col, least(greatest(round_even((0.5 - y) * 20 - 0.5, 0), 0), 19)::BIGINT AS row FROM sp), ce AS (SELECT row, col, avg(x) AS v, count(*) AS n FROM ix GROUP BY 1, 2)"
BOUNDS = (-0.5, -0.5, 0.5, 0.5)


def _indexed(spark, d):
    r, c = geo.cell_index(F.col("x"), F.col("y"), BOUNDS, 20, 20)
    return T.spots(spark, d).select("id", "x", "y", r.alias("row"), c.alias("col"))


@query("J13_raster_value", f"WITH {_CELLS} SELECT id, round(v, 8) AS v FROM ix JOIN ce USING (row, col)")
def _(spark, d):
    ix = _indexed(spark, d)
    return ix.join(ix.groupBy("row", "col").agg(F.avg("x").alias("v")), ["row", "col"]).select("id", F.round("v", 8).alias("v"))


@query("A15_focal_mean", f"WITH {_CELLS} SELECT a.row, a.col, round(avg(b.v), 8) AS mean FROM ce a JOIN ce b ON (a.row - b.row) ** 2 + (a.col - b.col) ** 2 <= 4 GROUP BY 1, 2")
def _(spark, d):
    ce = _indexed(spark, d).groupBy("row", "col").agg(F.avg("x").alias("v"))
    return spatial.focal_mean(ce, "v", 2).select("row", "col", F.round("mean", 8).alias("mean"))


@query("A29_zonal_first", f"WITH {_CELLS} SELECT id, n::BIGINT AS n FROM ix JOIN ce USING (row, col)")
def _(spark, d):
    ix = _indexed(spark, d)
    return ix.join(ix.groupBy("row", "col").agg(F.count(F.lit(1)).alias("n")), ["row", "col"]).select("id", "n")


@query("X2_explode", "SELECT doc_id, i::BIGINT AS i, string_split(lang || '-' || source, '-')[i + 1] AS part FROM documents, (SELECT unnest([0, 1]) AS i)")
def _(spark, d):
    return T.table(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.concat("lang", F.lit("-"), "source"), "-")).alias("i", "part")).select("doc_id", F.col("i").cast(L), "part")


@query("X6_sample_points", f"WITH {T.SEG}, n AS (SELECT seg_id, length_m, greatest(1, floor(length_m / 200))::BIGINT AS n FROM seg), k AS (SELECT *, unnest(range(n)) AS k FROM n) SELECT seg_id || '_' || lpad(CAST(k AS VARCHAR), 3, '0') AS point_id, k::BIGINT AS k, round_even((k + 0.5) * length_m / n, 1) AS chainage_m FROM k")
def _(spark, d):
    geom = F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), F.struct(F.col("length_m").alias("x"), F.lit(0.0).alias("y")))
    s = T.segments(spark, d).select(F.col("seg_id").cast("string").alias("seg_id"), geom.alias("geom"))
    return spatial.sample_points(s).select("point_id", "k", "chainage_m")


@query("X7_cell_centres", f"WITH {_CELLS} SELECT row, col, round(-0.5 + (col + 0.5) / 20, 10)::DOUBLE AS x, round(0.5 - (row + 0.5) / 20, 10)::DOUBLE AS y, n::BIGINT AS n FROM ce")
def _(spark, d):
    """The centres of the cells that hold points."""
    x, y = geo.cell_centre(F.col("row"), F.col("col"), BOUNDS, 20, 20)
    return _indexed(spark, d).groupBy("row", "col").agg(F.count(F.lit(1)).alias("n")).select("row", "col", F.round(x, 10).alias("x"), F.round(y, 10).alias("y"), "n")


@query("X8_cell_index", f"WITH {_CELLS} SELECT id, row, col FROM ix")
def _(spark, d):
    return _indexed(spark, d).select("id", "row", "col")


@query("X5_clusters", f"WITH RECURSIVE {T.SPOTS}, e AS (SELECT a.id AS a, b.id AS b FROM sp a JOIN sp b ON sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.008), r(node, lab) AS (SELECT id, id FROM sp UNION SELECT b, lab FROM r JOIN e ON node = a WHERE lab < b) SELECT node AS id, min(lab) AS cluster FROM r GROUP BY 1")
def _(spark, d):
    return spatial.cluster_points(T.spots(spark, d), 0.008).select("id", "cluster")


# --- ranking, supply, budget


RANKED = f"""{TREE}, {T.LOCAL}, {T.POINTS}, hp AS (SELECT seg_id, 1 - avg(p_impaired) AS h0 FROM pt GROUP BY 1),
v AS (SELECT seg_id, src, dst, coalesce(local_ha, 0) AS ha FROM seg LEFT JOIN loc USING (seg_id)), b AS (SELECT src, sum(ha) AS ha FROM v GROUP BY 1),
dn AS (SELECT v.seg_id, v.ha + coalesce(any_value(h.ha), 0) + coalesce(sum(b.ha), 0) AS command FROM v LEFT JOIN b h ON h.src = v.dst LEFT JOIN cl ON anc = v.dst LEFT JOIN b ON b.src = des GROUP BY v.seg_id, v.ha),
up AS (SELECT des, count(*) AS c FROM cl GROUP BY 1), lo AS (SELECT anc, count(*) AS c FROM cl GROUP BY 1),
bt AS (SELECT seg_id, (1 + coalesce(up.c, 0)) * (1 + coalesce(lo.c, 0)) AS bc FROM seg LEFT JOIN up ON up.des = src LEFT JOIN lo ON lo.anc = dst),
pr AS (SELECT seg_id, command, round(coalesce(h0, (SELECT median(h0) FROM hp)), 6) AS health, bc / (max(bc) OVER ())::DOUBLE AS bcn FROM dn JOIN bt USING (seg_id) LEFT JOIN hp USING (seg_id)),
pp AS (SELECT *, round(command * (1 - health) * (1 + bcn), 4) AS priority FROM pr)
SELECT seg_id, command AS command_ha, health, round(bcn, 8) AS bc_norm, priority, row_number() OVER (ORDER BY priority DESC, seg_id)::BIGINT AS rank FROM pp"""


@query("B10_priority", RANKED)
def ranking(spark, d, scored=None):
    """The flagship: local area -> command area -> centrality -> health -> priority -> rank.  ``scored``: the scored
    segments, where they have been written out already."""
    s = settle(scored_segments(spark, d)) if scored is None else scored
    f = tree.forest(s)
    command = graph.downstream_sum(s, "local_ha", f).select("seg_id", F.col("total").alias("command_ha"))
    central = graph.tree_betweenness(s, f)
    j = s.select("seg_id", F.col("health").alias("health_score")).join(command, "seg_id").join(central, "seg_id")
    r = supply.rank_segments(j).withColumn("priority", F.round("priority", 4))
    r = ranked(r.drop("rank"), "rank", F.desc("priority"), F.asc("seg_id"))
    return r.select("seg_id", "command_ha", "health", F.round("bc_norm", 8).alias("bc_norm"), "priority", "rank")


PATHS = f"{TREE}, {HEALTH}, {T.LOCAL}, pa AS (SELECT s.seg_id, p.seg_id AS on_path FROM seg s JOIN seg p ON p.dst = s.src UNION ALL SELECT s.seg_id, p.seg_id FROM seg s JOIN cl ON des = s.src JOIN seg p ON p.dst = anc UNION ALL SELECT seg_id, seg_id FROM seg), sv AS (SELECT seg_id, exp(sum(ln(least(greatest(h, 0.01), 1.0)))) AS p FROM pa JOIN (SELECT seg_id AS on_path, h FROM hs) USING (on_path) GROUP BY 1), lh AS (SELECT seg.seg_id, coalesce(local_ha, 0) AS ha, h, p FROM seg LEFT JOIN loc USING (seg_id) JOIN hs USING (seg_id) JOIN sv USING (seg_id))"


def supplied(spark, d):
    """(segments, paths), both written out."""
    s = settle(scored_segments(spark, d))
    return s, settle(graph.supply_paths(s, settle(graph.hops(s, root(spark), directed=True))))


def routed(spark, d):
    """(segments, routes from the root), both written out."""
    s = settle(scored_segments(spark, d))
    return s, supply.routes(s, settle(graph.hops(s, root(spark), directed=True)))


@query("B1_supply", f"{PATHS} SELECT seg_id, round(p, 8) AS p_supply FROM lh")
def _(spark, d):
    return supply.route_probability(*routed(spark, d)).withColumn("p_supply", F.round("p_supply", 8))


@query("A17_at_risk", f"{PATHS} SELECT round(sum(ha * (1 - p)), 4) AS at_risk_ha FROM lh")
def _(spark, d):
    s, way = routed(spark, d)
    return supply.expected_loss(s, supply.route_probability(s, way)).withColumn("at_risk_ha", F.round("at_risk_ha", 4))


@query("B2_protected", f"{PATHS}, h2 AS (SELECT seg_id AS on_path, CASE WHEN seg_id % 40 = 0 THEN greatest(h, 0.95) ELSE h END AS h FROM hs), s2 AS (SELECT seg_id, exp(sum(ln(least(greatest(h, 0.01), 1.0)))) AS p2 FROM pa JOIN h2 USING (on_path) GROUP BY 1) SELECT round(sum(ha * (1 - p)) - sum(ha * (1 - p2)), 4) AS protected_ha FROM lh JOIN s2 USING (seg_id)")
def _(spark, d):
    s, way = routed(spark, d)
    return supply.route_protected(s, way, s.where("seg_id % 40 = 0")).withColumn("protected_ha", F.round("protected_ha", 4))


@query("B3_first_pick", f"{PATHS}, sd AS (SELECT on_path AS seg_id, sum(ha * p) AS s FROM pa JOIN lh USING (seg_id) GROUP BY 1), mg AS (SELECT seg_id, (greatest(h, 0.95) / h - 1) * s AS g, length_m / 1000 * 239644 AS cost FROM sd JOIN hs USING (seg_id) JOIN seg USING (seg_id)) SELECT seg_id, round(g, 6) AS marginal_ha FROM mg")
def _(spark, d):
    return supply.route_marginals(*routed(spark, d)).withColumn("marginal_ha", F.round("marginal_ha", 6))


@query("B3_greedy_plan")
def _(spark, d):
    s, way = routed(spark, d)
    s = s.withColumn("cost_inr", economics.desilt_cost(F.col("length_m"), F.lit(1.0))).withColumn("rank", F.col("seg_id"))
    budgets = spark.createDataFrame([("small", 5e6), ("large", 5e7)], "scenario string, budget double")
    plan = supply.route_plan(s, way, budgets)
    return plan.select("scenario", "work_order", "seg_id", "cost_inr", F.round("marginal_ha", 4).alias("marginal_ha"), F.round("cumulative_ha", 4).alias("cumulative_ha"))


TRIALS, BUDGET = 200, 5_000_000.0
_ORDER = f"{HEALTH}, wt AS (SELECT seg_id, length_m / 1000 * 239644 AS cost, greatest((1 - h) * sqrt(length_m), 1e-9) AS w FROM seg JOIN hs USING (seg_id)), ky AS (SELECT trial, seg_id, cost, -ln((CAST('0x' || substr(md5('42:' || trial || ':' || seg_id), 1, 12) AS BIGINT) + 1.0) / 281474976710656.0) / w AS k FROM wt, (SELECT unnest(range({TRIALS})) AS trial)), od AS (SELECT *, row_number() OVER (PARTITION BY trial ORDER BY k, seg_id) AS pos FROM ky)"


def _weighted(spark, d):
    return scored_segments(spark, d).withColumns({"cost_inr": economics.desilt_cost(F.col("length_m"), F.lit(1.0)), "weight": supply.complaint_weight(F.col("health"), F.col("length_m"))})


@query("B4_weighted_order", f"WITH {T.SEG}, {_ORDER} SELECT trial::BIGINT AS trial, seg_id, pos::BIGINT AS pos FROM od")
def _(spark, d):
    return supply.weighted_orders(_weighted(spark, d), TRIALS).select(F.col("trial").cast(L), "seg_id", F.col("pos").cast(L))


_FILL = f"it AS (SELECT trial, list({{'c': cost::DOUBLE, 's': seg_id}} ORDER BY pos) AS xs FROM od GROUP BY 1), fl AS (SELECT trial, list_reduce(xs, lambda a, x: CASE WHEN a.spent + x.c <= {BUDGET} THEN {{'spent': a.spent + x.c, 'taken': list_append(a.taken, x.s)}} ELSE a END, {{'spent': 0.0::DOUBLE, 'taken': []::BIGINT[]}}) AS r FROM it)"


@query("B5_skip_fill", f"WITH RECURSIVE {T.SEG}, {_ORDER}, w(trial, pos, spent, took, seg_id) AS (SELECT trial, 1::BIGINT, CASE WHEN cost <= {BUDGET} THEN cost ELSE 0.0 END, cost <= {BUDGET}, seg_id FROM od WHERE pos = 1 UNION ALL SELECT w.trial, o.pos, CASE WHEN w.spent + o.cost <= {BUDGET} THEN w.spent + o.cost ELSE w.spent END, w.spent + o.cost <= {BUDGET}, o.seg_id FROM w JOIN od o ON o.trial = w.trial AND o.pos = w.pos + 1) SELECT trial::BIGINT AS trial, seg_id FROM w WHERE took")
def _(spark, d):
    return supply.weighted_fill(_weighted(spark, d), TRIALS, BUDGET).select(F.col("trial").cast(L), "seg_id")


@query("B6_trials")
def _(spark, d):
    s, way = routed(spark, d)
    taken = settle(supply.weighted_fill(_weighted(spark, d), TRIALS, BUDGET))
    costed = s.withColumn("cost_inr", economics.desilt_cost(F.col("length_m"), F.lit(1.0))).withColumn("rank", F.col("seg_id"))
    plan = supply.route_plan(costed, way, spark.createDataFrame([("plan", BUDGET)], "scenario string, budget double"))
    out = supply.trial_summary(supply.route_outcomes(s, way, taken), plan.agg(F.max("cumulative_ha")).first()[0] or 0.0)
    return out.select(*[F.round(c, 6).alias(c) if c != "trials" else F.col(c) for c in out.columns])


@query("A18_trial_summary", "WITH x AS (SELECT event_type, value FROM events) SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90, round(avg((value < 40)::INT), 8) AS below FROM x GROUP BY 1")
def _(spark, d):
    x = F.col("value")
    return T.table(spark, d, "events").groupBy("event_type").agg(F.round(F.avg(x), 6).alias("mean"), F.round(stats.quantile(x, 0.1), 6).alias("p10"), F.round(stats.quantile(x, 0.9), 6).alias("p90"), F.round(F.avg((x < 40).cast("double")), 8).alias("below"))


# --- failure and decisions


LOST = f"WITH RECURSIVE {T.NET}, ind AS (SELECT dst, count(*) AS k FROM net GROUP BY 1)"


@query("B9_all_failures", f"{TREE}, {T.LOCAL}, ls AS (SELECT e.seg_id AS scenario, e.seg_id FROM seg e UNION ALL SELECT e.seg_id, s.seg_id FROM seg e JOIN seg s ON s.src = e.dst UNION ALL SELECT e.seg_id, s.seg_id FROM seg e JOIN cl ON anc = e.dst JOIN seg s ON s.src = des) SELECT scenario, count(*)::BIGINT AS segments_cut_off, coalesce(sum(local_ha), 0)::DOUBLE AS area_lost_ha FROM ls LEFT JOIN loc USING (seg_id) GROUP BY 1")
def _(spark, d):
    s = settle(T.segments(spark, d).select("seg_id", "src", "dst"))
    cells = T.local_area(spark, d).select("seg_id", F.lit("d").alias("district"), F.lit("c").alias("crop_class"), F.col("local_ha").alias("area_ha"))
    counts, area = failure.single_failures(s, tree.dominators(s, root(spark)), cells)
    return counts.join(area, "scenario", "left").select("scenario", "segments_cut_off", F.coalesce("ha", F.lit(0.0)).alias("area_lost_ha"))


@query("B9_parallel_feeds", f"WITH RECURSIVE {T.NET}, nd AS (SELECT DISTINCT dst AS node FROM net), e AS (SELECT seg_id, src, dst FROM net), sc AS (SELECT seg_id AS scenario FROM e), r(scenario, node) AS (SELECT scenario, 0 FROM sc UNION SELECT scenario, dst FROM r JOIN e ON src = node AND seg_id <> scenario) SELECT scenario, node::BIGINT AS node FROM sc, nd EXCEPT SELECT scenario, node FROM r")
def _(spark, d):
    return graph.losses(T.network(spark, d), root(spark))


_BELOW = "ls AS (SELECT e.seg_id AS scenario, e.seg_id FROM seg e UNION ALL SELECT e.seg_id, s.seg_id FROM seg e JOIN seg s ON s.src = e.dst UNION ALL SELECT e.seg_id, s.seg_id FROM seg e JOIN cl ON anc = e.dst JOIN seg s ON s.src = des)"
# the economy of a district (here a brand): its crop mix is the area of its types of canal
_RECORD = f"""ce AS (SELECT seg_id, prj_name AS district, can_type AS crop, local_ha AS ha FROM loc JOIN seg USING (seg_id)),
mx AS (SELECT district, crop, sum(ha) AS a, sum(ha) / sum(sum(ha)) OVER (PARTITION BY district) AS sh FROM ce GROUP BY 1, 2),
m3 AS (SELECT district, string_agg(crop || ' ' || round_even(sh * 100, 0)::INT || '%', '; ' ORDER BY rn) AS mix FROM (SELECT *, row_number() OVER (PARTITION BY district ORDER BY sh DESC, crop) AS rn FROM mx) WHERE rn <= 3 GROUP BY 1),
ec AS (SELECT district, sum(sh * 10 * length(crop) * 2.5::DOUBLE) AS rev, sum(sh * (100 + 10 * length(crop))) / sum(sh) AS mm FROM mx GROUP BY 1),
ar AS (SELECT scenario, district, crop, sum(ha) AS ha FROM ls JOIN ce USING (seg_id) GROUP BY 1, 2, 3),
ad AS (SELECT scenario, sum(ha) AS ha, string_agg(district || '=' || printf('%.1f', ha), ',' ORDER BY ha DESC, district) AS t FROM (SELECT scenario, district, sum(ha) AS ha FROM ar GROUP BY 1, 2) GROUP BY 1),
ac AS (SELECT scenario, string_agg(crop || '=' || printf('%.1f', ha), ',' ORDER BY crop) AS t FROM (SELECT scenario, crop, sum(ha) AS ha FROM ar GROUP BY 1, 2) GROUP BY 1),
cn AS (SELECT scenario, count(*)::BIGINT AS n, string_agg(CAST(seg_id AS VARCHAR), ',' ORDER BY seg_id) AS ids FROM ls GROUP BY 1),
rec AS (SELECT c.scenario AS seg_id, CASE WHEN can_name = '' OR can_name IS NULL THEN '(unnamed)' ELSE can_name END AS can_name, can_type, round(length_m / 1000, 6) AS length_km, n AS segments_cut_off, coalesce(ad.ha, 0)::DOUBLE AS area_lost_ha,
  round(coalesce(ad.ha, 0) * rev, 4) AS revenue_at_risk_inr, round(length_m / 1000 * 239644, 4) AS desilt_cost_inr, round(coalesce(ad.ha, 0) * rev / (length_m / 1000 * 239644), 6) AS benefit_cost_ratio, prj_name AS district,
  round(rev, 6) AS revenue_per_ha, round(mm, 6) AS water_demand_mm, round(least(greatest(1 - 120 / mm, 0), 1), 8)::DOUBLE AS irrigation_dependency, mix AS crop_mix_top3, coalesce(ad.t, '') AS area_by_district, coalesce(ac.t, '') AS area_by_crop, ids
  FROM cn c JOIN seg ON seg.seg_id = c.scenario LEFT JOIN ad USING (scenario) LEFT JOIN ac USING (scenario) LEFT JOIN ec ON ec.district = prj_name LEFT JOIN m3 ON m3.district = prj_name)"""


def _economy(spark, d, s):
    """(cells by segment, economics by district, areas of the mix) of the segments."""
    cells = settle(T.local_area(spark, d).join(s.select("seg_id", F.col("prj_name").alias("district"), F.col("can_type").alias("crop_class")), "seg_id").withColumnRenamed("local_ha", "area_ha"))
    mix = settle(cells.select("district", F.col("crop_class").alias("crop"), F.col("area_ha").alias("area")).groupBy("district", "crop").agg(F.sum("area").alias("area")))
    sh = settle(economics.mix_shares(mix))
    size, crops = F.length("crop").cast("double"), sh.select("crop").distinct()
    revenue = economics.revenue_per_ha(sh, crops.select("crop", (10 * size).alias("price")), crops.select("crop", F.lit(2.5).alias("yield")))
    water = economics.water_demand(sh, crops.select("crop", F.col("crop").alias("water_crop")), crops.select(F.col("crop").alias("water_crop"), F.lit(100.0).alias("min_mm"), (100 + 20 * size).alias("max_mm")))
    eco = revenue.join(water, "district").withColumn("dependency", economics.irrigation_dependency(F.lit(120.0), F.col("water_mm")))
    return cells, settle(eco), mix


def _record(r):
    """A failure record with its maps shown as text."""
    shown = lambda xs, k, v: F.array_join(F.transform(xs, lambda x: F.concat(x[k], F.lit("="), F.format_string("%.1f", x[v]))), ",")
    crops = F.array_sort(F.map_entries(F.coalesce("ha_by_crop", F.create_map().cast("map<string,double>"))))
    return r.select(
        F.col("scenario").alias("seg_id"), "can_name", "can_type", F.round("length_km", 6).alias("length_km"), "segments_cut_off", "area_lost_ha", F.round("revenue_at_risk_inr", 4).alias("revenue_at_risk_inr"), F.round("cost_inr", 4).alias("desilt_cost_inr"),
        F.round("benefit_cost_ratio", 6).alias("benefit_cost_ratio"), F.col("own_district").alias("district"), F.round("revenue_per_ha", 6).alias("revenue_per_ha"), F.round("water_demand_mm", 6).alias("water_demand_mm"),
        F.round("irrigation_dependency", 8).alias("irrigation_dependency"), "crop_mix_top3", shown(F.col("ha_by_district"), "district", "ha").alias("area_by_district"), shown(crops, "key", "value").alias("area_by_crop"),
        *([F.array_join(F.transform("lost_seg_ids", lambda x: x.cast("string")), ",").alias("ids")] if "lost_seg_ids" in r.columns else []),
    )


def _costed(s):
    return s.select("seg_id", "can_name", "can_type", "length_m", F.col("prj_name").alias("district"), economics.desilt_cost(F.col("length_m"), F.lit(1.0)).alias("cost_inr"))


@query("B8_failure_record", f"{TREE}, {T.LOCAL}, {_BELOW}, {_RECORD} SELECT * EXCLUDE (ids) FROM rec")
def _(spark, d):
    """The whole record of every single failure."""
    s = settle(T.segments(spark, d))
    cells, eco, mix = _economy(spark, d, s)
    counts, area = failure.single_failures(s, tree.dominators(s, root(spark)), cells)
    return _record(failure.records(counts, area, _costed(s), eco, mix))


@query("B8_ranked_failures", f"""{RANKED.split("SELECT seg_id, command AS command_ha")[0].rstrip()}, tp AS (SELECT seg_id FROM pp ORDER BY priority DESC, seg_id LIMIT 3), {_BELOW}, {_RECORD} SELECT * FROM rec WHERE seg_id IN (SELECT seg_id FROM tp)""")
def _(spark, d):
    """The failures of the three segments ranked highest, with the ids of what they cut off."""
    s = settle(T.segments(spark, d))
    cells, eco, mix = _economy(spark, d, s)
    top = settle(ranking(spark, d).where("rank <= 3").select(F.col("seg_id").alias("scenario"), "seg_id"))
    lost = failure.lost_segments(s, graph.reach_after_removal(s, root(spark), top), top)
    return _record(failure.failure_records(lost, _costed(s), cells, eco, mix, ids=True))


@query("A26_combined_union", f"{TREE}, {T.LOCAL}, ls AS (SELECT e.seg_id FROM seg e WHERE e.seg_id IN (5, 11, 40) UNION SELECT s.seg_id FROM seg e JOIN seg s ON s.src = e.dst WHERE e.seg_id IN (5, 11, 40) UNION SELECT s.seg_id FROM seg e JOIN cl ON anc = e.dst JOIN seg s ON s.src = des WHERE e.seg_id IN (5, 11, 40)) SELECT prj_name AS district, count(*)::BIGINT AS segments, sum(coalesce(local_ha, 0))::DOUBLE AS area_ha FROM ls JOIN seg USING (seg_id) LEFT JOIN loc USING (seg_id) GROUP BY 1")
def _(spark, d):
    s = settle(scored_segments(spark, d))
    sc = s.where(F.col("seg_id").isin(5, 11, 40)).select(F.col("seg_id").alias("scenario"), "seg_id")
    lost = failure.lost_segments(s, graph.reach_after_removal(s.select("seg_id", "src", "dst"), root(spark), sc), sc)
    eco = s.select(F.col("prj_name").alias("district")).distinct().withColumn("revenue_per_ha", F.lit(1.0))
    return failure.combined_impact(lost, sc, s.withColumnRenamed("prj_name", "district"), eco).select("district", "segments", "area_ha")


@query("A26_combined_joint", f"WITH RECURSIVE {T.NET}, e AS (SELECT * FROM net WHERE seg_id NOT IN (5, 11, 40)), a(node) AS (SELECT 0 UNION SELECT dst FROM a JOIN net ON src = node), r(node) AS (SELECT 0 UNION SELECT dst FROM r JOIN e ON src = node) SELECT node::BIGINT AS node FROM a EXCEPT SELECT node FROM r")
def _(spark, d):
    n = T.network(spark, d)
    sc = n.where(F.col("seg_id").isin(5, 11, 40)).select(F.lit(1).cast(L).alias("scenario"), "seg_id")
    return graph.reach_after_removal(n, root(spark), sc).select("node")


@query("B11_crop_class", f"WITH {_CELLS} SELECT id, CASE WHEN v > 0 THEN 'paddy-like (inferred)' ELSE 'other cropland (inferred)' END AS crop FROM ix JOIN ce USING (row, col)")
def _(spark, d):
    ix = _indexed(spark, d)
    v = ix.groupBy("row", "col").agg(F.avg("x").alias("v"))
    return ix.join(v, ["row", "col"]).select("id", F.when(S.above(F.col("v"), 0), "paddy-like (inferred)").otherwise("other cropland (inferred)").alias("crop"))


@query("B12_district_summary", f"WITH {T.AREAS}, g AS (SELECT district, crop, sum(area) AS a FROM ar GROUP BY 1, 2), sh AS (SELECT *, a / sum(a) OVER (PARTITION BY district) AS s FROM g) SELECT district, sum(a) AS total, arg_max(crop, s) AS top_crop, round(max(s), 8) AS top_share FROM sh GROUP BY 1")
def _(spark, d):
    sh = economics.mix_shares(T.areas(spark, d))
    return sh.groupBy("district").agg(F.sum("area").alias("total"), F.max_by("crop", "share").alias("top_crop"), F.round(F.max("share"), 8).alias("top_share"))


_SC = "sc AS (SELECT p_brand AS canal, round(sum(p_retailprice) / 1000, 6) AS score FROM part GROUP BY 1)"


@query("N6_verdict", f"WITH {_SC}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, canal) AS rn, lead(canal) OVER (ORDER BY score DESC, canal) AS nxt, score - lead(score) OVER (ORDER BY score DESC, canal) AS gap FROM sc) SELECT canal AS winner, score, nxt AS runner_up, round(gap, 6) AS gap FROM r WHERE rn = 1")
def _(spark, d):
    sc = T.segments(spark, d).join(T.table(spark, d, "part").select(F.col("p_partkey").alias("seg_id"), "p_retailprice"), "seg_id").groupBy(F.col("prj_name").alias("canal")).agg(F.round(F.sum("p_retailprice") / 1000, 6).alias("score"))
    return failure.verdict(sc).withColumn("gap", F.round("gap", 6))


@query("N5_group_key", f"WITH {T.SEG} SELECT seg_id, CASE WHEN seg_id % 3 = 0 THEN CAST(seg_id AS VARCHAR) ELSE prj_name END AS g FROM seg")
def _(spark, d):
    return T.segments(spark, d).select("seg_id", naming.group_key(F.col("seg_id") % 3 == 0, F.col("seg_id").cast("string"), F.col("prj_name")).alias("g"))


@query("N4_covered_canals", f"{TREE}, ls AS (SELECT e.seg_id AS scenario, s.seg_id FROM seg e JOIN seg s ON s.src = e.dst UNION ALL SELECT e.seg_id, s.seg_id FROM seg e JOIN cl ON anc = e.dst JOIN seg s ON s.src = des UNION ALL SELECT seg_id, seg_id FROM seg) SELECT scenario, string_agg(DISTINCT prj_name, ',' ORDER BY prj_name) AS canals FROM ls JOIN seg USING (seg_id) GROUP BY 1")
def _(spark, d):
    s = settle(T.segments(spark, d).withColumn("canal", F.col("prj_name")))
    return failure.cut_canals(s, tree.dominators(s, root(spark)), s).select("scenario", F.array_join("canals", ",").alias("canals"))


def _km(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '?' ELSE format('{{:.1f}}', round_even({x} / 1000, 1)) END"


NAMED = f"""r(seg_id, up, steps) AS (SELECT s.seg_id, p.seg_id, 1 FROM seg s JOIN seg p ON p.dst = s.src UNION ALL SELECT r.seg_id, p.seg_id, steps + 1 FROM r JOIN seg c ON c.seg_id = r.up JOIN seg p ON p.dst = c.src WHERE r.up % 3 <> 0 AND steps < 80),
m(node, metres) AS (SELECT 0, 0.0::DOUBLE UNION ALL SELECT dst, metres + length_m FROM m JOIN seg ON src = node),
nb AS (SELECT seg.*, CASE WHEN seg_id % 3 = 0 THEN prj_name ELSE '' END AS canal, metres AS start FROM seg LEFT JOIN m ON node = src),
ns AS (SELECT *, row_number() OVER (PARTITION BY canal ORDER BY start NULLS LAST, seg_id) AS idx, count(*) OVER (PARTITION BY canal) AS n, min(start) OVER (PARTITION BY canal) AS head FROM nb),
nj AS (SELECT ns.*, p.canal AS pc, {_km("ns.length_m")} || ' km' AS size, CASE WHEN ns.idx = 1 THEN 'head reach' ELSE 'reach ' || ns.idx || '/' || ns.n END AS place,
  'at km ' || {_km("(CASE WHEN p.canal IS NOT NULL THEN ns.start - p.head ELSE ns.start END)")} AS loc FROM ns LEFT JOIN (SELECT seg_id, up FROM r WHERE up % 3 = 0) a ON a.seg_id = ns.seg_id LEFT JOIN ns p ON p.seg_id = a.up),
nk AS (SELECT *, CASE WHEN canal <> '' AND n = 1 THEN canal WHEN canal <> '' THEN canal || ' · ' || place WHEN pc IS NOT NULL THEN can_type || ' off ' || pc || ' ' || loc ELSE can_type || ', ' || prj_name || ' ' || loc END AS nm,
  CASE WHEN canal <> '' THEN place || ' · ' || size || CASE WHEN idx > 1 THEN ' · from km ' || {_km("(start - head)")} ELSE '' END WHEN pc IS NOT NULL THEN loc || ' · ' || size ELSE can_type || ' ' || loc || ' · ' || size END AS label,
  CASE WHEN canal <> '' THEN canal WHEN pc IS NOT NULL THEN regexp_replace(can_type, 'y$', 'ie') || 's off ' || pc ELSE prj_name || ' · unnamed reaches' END AS grp FROM nj),
nn AS (SELECT seg_id, grp, CASE WHEN count(*) OVER (PARTITION BY nm) > 1 THEN nm || ' (' || size || ')' ELSE nm END AS name, label, canal = '' AS derived, idx::BIGINT AS idx, n::BIGINT AS reaches, round_even(start / 1000, 2) AS km_from FROM nk)"""


def _names(spark, s):
    up = s.select("seg_id", F.col("src").alias("n")).join(s.select(F.col("dst").alias("n"), F.col("seg_id").alias("up")), "n").select("seg_id", "up")
    return naming.reach_names(s, graph.chainage(s, root(spark)), settle(up))


@query("N1_reach_names", f'WITH RECURSIVE {T.SEG}, {NAMED} SELECT seg_id, grp AS "group", name, label, derived, idx AS "index", reaches, km_from FROM nn')
def _(spark, d):
    return _names(spark, settle(T.segments(spark, d).withColumn("can_name", F.when(F.col("seg_id") % 3 == 0, F.col("prj_name")))))


@query("N2_payload", f"""{RANKED.split("SELECT seg_id, command AS command_ha")[0].rstrip()}, {NAMED}, rk AS (SELECT *, row_number() OVER (ORDER BY priority DESC, seg_id) AS rank, max(priority) OVER () AS top FROM pp)
SELECT seg_id AS id, nn.name, grp AS canal, label AS reach, km_from AS "kmFrom", derived, can_type AS type, prj_name AS project, upper(prj_name[1]) || lower(prj_name[2:]) AS district, round_even(length_m / 1000, 2) AS km,
  round_even(command, 0) AS area, round_even(v.ha, 0) AS local, round_even(round(rk.health * 1000, 6), 0) / 1000 AS health, round_even(bcn, 3) AS cent, round_even(priority, 0) AS priority, round_even(priority / top, 4) AS pnorm, rank::BIGINT AS rank,
  round_even(length_m / 1000 * 239644, 0) AS cost, format('{{:.1f}},{{:.1f}}', seg.src / 8, seg.dst / 8) AS coords FROM seg JOIN nn USING (seg_id) JOIN rk USING (seg_id) JOIN v USING (seg_id)""")
def _(spark, d):
    s = settle(scored_segments(spark, d).withColumns({"can_name": F.when(F.col("seg_id") % 3 == 0, F.col("prj_name")), "district": F.col("prj_name"), "cost_inr": economics.desilt_cost(F.col("length_m"), F.lit(1.0))}))
    at = ranking(spark, d, s).drop("health")
    top = at.agg(F.max("priority").alias("_t"))
    at = at.join(F.broadcast(top)).withColumn("priority_norm", F.col("priority") / F.col("_t")).drop("_t")
    point = lambda x: F.struct((F.col(x) / 8).alias("x"), F.lit(0.0).alias("y"))
    out = naming.payload(s.join(at, "seg_id").withColumn("geom", F.array(point("src"), point("dst"))), _names(spark, s))
    return out.withColumn("coords", F.array_join(F.transform("coords", lambda p: F.format_string("%.1f", F.bround(p[0], 1))), ","))


@query("N3_profiles", f"WITH {T.AREAS}, g AS (SELECT district, crop, sum(area) AS a FROM ar GROUP BY 1, 2), sh AS (SELECT *, a / sum(a) OVER (PARTITION BY district) AS s FROM g), r AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY s DESC, crop) AS rn FROM sh), z AS (SELECT district, sum(s * 10 * length(crop) * 2.5::DOUBLE) AS rev, sum(s * (100 + 10 * length(crop))) / sum(s) AS mm FROM sh GROUP BY 1) SELECT district, round_even(any_value(rev), 0) AS revenue, round_even(any_value(mm), 0) AS water, round_even(least(greatest(1 - 120 / any_value(mm), 0), 1), 3) AS dependency, -12.5::DOUBLE AS rain_dev, string_agg(crop, ',' ORDER BY rn) AS crops, round_even(max(s), 4) AS most FROM r JOIN z USING (district) WHERE rn <= 3 GROUP BY 1")
def _(spark, d):
    sh = settle(economics.mix_shares(T.areas(spark, d)))
    size, crops = F.length("crop").cast("double"), sh.select("crop").distinct()
    revenue = economics.revenue_per_ha(sh, crops.select("crop", (10 * size).alias("price")), crops.select("crop", F.lit(2.5).alias("yield")))
    water = economics.water_demand(sh, crops.select("crop", F.col("crop").alias("water_crop")), crops.select(F.col("crop").alias("water_crop"), F.lit(100.0).alias("min_mm"), (100 + 20 * size).alias("max_mm")))
    both = revenue.join(water, "district").withColumns({"dependency": economics.irrigation_dependency(F.lit(120.0), F.col("water_mm")), "deficit": economics.rain_deficit(F.lit(-12.5))})
    out = economics.district_profiles(both, sh, 3)
    return out.select("district", "revenue", "water", "dependency", "rain_dev", F.array_join("mix.crop", ",").alias("crops"), F.array_max("mix.share").alias("most"))


# --- health and sampling


@query("M2_class_weight", "WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1) SELECT doc_id, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n)::DOUBLE, 8)::DOUBLE AS weight FROM labels JOIN c USING (quality)")
def _(spark, d):
    return health.class_weights(T.table(spark, d, "labels").select("doc_id", "quality"), "quality").select("doc_id", F.round("weight", 8).alias("weight"))


@query("M4_group_split", "WITH g AS (SELECT DISTINCT source FROM documents), r AS (SELECT source, row_number() OVER (ORDER BY md5(source)) <= ceil(0.25 * count(*) OVER ()) AS held_out FROM g) SELECT doc_id, held_out FROM documents JOIN r USING (source)")
def _(spark, d):
    return health.held_out_groups(T.table(spark, d, "documents").select("doc_id", "source"), "source").select("doc_id", "held_out")


_HEUR = "WITH p AS (SELECT event_id, round(value, 1) AS veg, (event_id * 37) % 101 / 100.0 AS amp, (event_id % 7) / 20.0 AS water FROM events WHERE value IS NOT NULL), r AS (SELECT *, (rank() OVER (ORDER BY veg) + (count(*) OVER (PARTITION BY veg) - 1) / 2.0) / count(*) OVER () AS vr, (rank() OVER (ORDER BY amp) + (count(*) OVER (PARTITION BY amp) - 1) / 2.0) / count(*) OVER () AS ar FROM p), s AS (SELECT event_id, least(greatest(0.6 * vr + 0.4 * ar - 0.15 * (water > 0.10)::INT, 0), 1)::DOUBLE AS s FROM r)"


@query("M7_heuristic", f"{_HEUR} SELECT event_id, round(s, 6) AS p_impaired, CASE WHEN round(s, 6) > 0.66 THEN 'suspect' ELSE 'ok' END AS pred_class FROM s")
def _(spark, d):
    k = F.col("event_id")
    p = T.table(spark, d, "events").select("event_id", F.round("value", 1).alias("veg"), ((k * 37) % 101 / 100.0).alias("amp"), ((k % 7) / 20.0).alias("water"))
    h = health.heuristic(p)
    return h.select("event_id", F.round("p_impaired", 6).alias("p_impaired"), F.when(F.round("p_impaired", 6) > 0.66, "suspect").otherwise("ok").alias("pred_class"))


@query("M8_health", f"WITH {T.POINTS}, c AS (SELECT seg_id, pred_class, count(*) AS n FROM pt GROUP BY 1, 2), m AS (SELECT seg_id, pred_class AS dominant_class FROM (SELECT *, row_number() OVER (PARTITION BY seg_id ORDER BY n DESC, pred_class) AS rn FROM c) WHERE rn = 1), g AS (SELECT seg_id, count(*) AS n, avg(p_impaired) AS a, quantile_cont(p_impaired, 0.75) AS q, max(p_impaired) AS w FROM pt GROUP BY 1) SELECT seg_id, n::BIGINT AS n_points, round(a, 8) AS mean_p_impaired, round(q, 8) AS p75_p_impaired, w AS worst_p_impaired, round(least(greatest(1 - a, 0), 1), 8)::DOUBLE AS health_score, round(least(greatest(1 - q, 0), 1), 8)::DOUBLE AS health_score_worst_reach, dominant_class, 'heuristic' AS method FROM g JOIN m USING (seg_id)")
def _(spark, d):
    h = health.segment_health(T.points(spark, d))
    rounded = ["mean_p_impaired", "p75_p_impaired", "health_score", "health_score_worst_reach"]
    return h.select(*[F.round(c, 8).alias(c) if c in rounded else F.col(c) for c in h.columns])


@query("M9_guards", "SELECT count(DISTINCT quality)::BIGINT AS classes, min(n)::BIGINT AS least, (count(DISTINCT quality) >= 2)::BOOLEAN AS trainable FROM (SELECT quality, count(*) AS n FROM labels GROUP BY 1)")
def _(spark, d):
    g = T.table(spark, d, "labels").groupBy("quality").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least"))
    return g.withColumn("trainable", F.col("classes") >= 2)


@query("M10_stratified", "WITH p AS (SELECT doc_id, lang, n_chars // 2000 AS b, md5('42:' || doc_id) AS k FROM documents), s AS (SELECT *, row_number() OVER (PARTITION BY lang, b ORDER BY k, doc_id) AS rn, (SELECT count(*) FROM (SELECT DISTINCT lang, b FROM p)) AS g FROM p) SELECT doc_id FROM s ORDER BY rn <= greatest(1, 300 // g) DESC, k, doc_id LIMIT 300")
def _(spark, d):
    p = T.table(spark, d, "documents").select("doc_id", "lang", F.floor(F.col("n_chars") / 2000).alias("b"), F.col("doc_id").alias("point_id"))
    return health.stratified_queue(p, ["lang", "b"], 300, F.md5(F.concat_ws(":", F.lit(42), "doc_id"))).select("doc_id")


def labelled(spark, d):
    """doc_id, source, a, b, label of the labelled documents, written out: features are made before the join, which then
    moves no texts, and texts are read once, however often a forest reads its rows."""
    letters = (F.length("text") - F.length(F.regexp_replace("text", "[^a-z ]", ""))).cast("double")
    docs = T.table(spark, d, "documents").select("doc_id", "source", F.col("n_chars").cast("double").alias("a"), letters.alias("b"))
    rows = docs.join(T.table(spark, d, "labels"), "doc_id").select(*docs.columns, F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"))
    return settle(spread(rows, "doc_id"))


@query("M1_forest")
def _(spark, d):
    rows = labelled(spark, d)
    model = health.train_forest(rows, ["a", "b"], "label")
    return health.predict_forest(model, rows, ["bad"]).select("doc_id", F.round("p_bad", 6).alias("p_bad"), F.round("p_impaired", 6).alias("p_impaired"), "pred_class")


# --- the label log and event windows


@query("T1_resume", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, d):
    return lb.resume(T.table(spark, d, "documents").select("doc_id"), T.table(spark, d, "labels"), ["doc_id"])


@query("T2_label_lww", "SELECT conv_id, arg_max(role, turn) AS role, max(turn) AS turn FROM conversations GROUP BY 1")
def _(spark, d):
    return lb.last_labels(T.table(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id"], "turn")


@query("T3_undo", "WITH RECURSIVE l AS (SELECT conv_id, turn, turn % 3 = 2 AS undo, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations), w(conv_id, rn, turn, owed, stands) AS (SELECT conv_id, rn, turn, CASE WHEN undo THEN 1 ELSE 0 END, NOT undo FROM l WHERE rn = 1 UNION ALL SELECT l.conv_id, l.rn, l.turn, CASE WHEN undo THEN owed + 1 ELSE greatest(owed - 1, 0) END, NOT undo AND owed = 0 FROM w JOIN l ON l.conv_id = w.conv_id AND l.rn = w.rn + 1) SELECT conv_id, turn FROM w WHERE stands")
def _(spark, d):
    log = T.table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 2, "undo").otherwise("label").alias("op"))
    return lb.undo(log, "conv_id", "turn").select("conv_id", "turn")


@query("T4_next", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 1")
def _(spark, d):
    return lb.next_pending(T.table(spark, d, "documents").select("doc_id"), T.table(spark, d, "labels"), "doc_id", "doc_id")


@query("T5_validate", "SELECT doc_id, CASE WHEN doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en') THEN 'unknown id' WHEN quality <> 1 THEN 'unknown class' ELSE 'ok' END AS reason FROM labels")
def _(spark, d):
    good, bad = lb.validate(T.table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label")), T.table(spark, d, "documents").where("lang = 'en'"), "doc_id", ["1"])
    return good.select("doc_id", F.lit("ok").alias("reason")).unionByName(bad.select("doc_id", "reason"))


@query("T6_progress", "SELECT quality::VARCHAR AS label, count(*)::BIGINT AS n FROM labels GROUP BY 1")
def _(spark, d):
    return lb.progress(T.table(spark, d, "labels").select(F.col("quality").cast("string").alias("label")))


@query("T8_seasons", "SELECT event_type, count(*) FILTER (ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-16')::BIGINT AS wet, count(*) FILTER (ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-02-01')::BIGINT AS dry FROM events GROUP BY 1")
def _(spark, d):
    inside = lambda a, b: F.count_if((F.col("ts") >= F.lit(a).cast("timestamp")) & (F.col("ts") < F.lit(b).cast("timestamp")))
    return T.table(spark, d, "events").groupBy("event_type").agg(inside("2024-01-01", "2024-01-16").alias("wet"), inside("2024-01-16", "2024-02-01").alias("dry"))


@query("ext_tumbling", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*)::BIGINT AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def _(spark, d):
    return ev.tumbling_counts(T.table(spark, d, "events")).withColumn("total", F.round("total", 6))


@query("ext_sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS \"end\", count(*)::BIGINT AS n FROM s GROUP BY user_id, k")
def _(spark, d):
    return ev.sessions(T.table(spark, d, "events"))
