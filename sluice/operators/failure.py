"""What is lost when segments fail: records per failure, combined failures, and rollups for decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ratio
from ..functions.stats import top_share
from ..state import if_small, settle
from . import tree


def lost_segments(edges: DataFrame, lost_nodes: DataFrame, removed: DataFrame) -> DataFrame:
    """scenario, seg_id: edges whose tail is lost, and the removed ones themselves."""
    by_node = lost_nodes.join(edges.select("seg_id", "src"), F.col("node") == F.col("src")).select("scenario", "seg_id")
    return by_node.unionByName(removed.select("scenario", "seg_id")).distinct()


def failure_records(lost: DataFrame, segs: DataFrame, cells: DataFrame, economics: DataFrame, mix: DataFrame | None = None, ids: bool = False) -> DataFrame:
    """One row a scenario (the removed seg_id), from the pairs (scenario, seg_id) of what it cuts off; see ``records``.

    ``cells``: seg_id, district, crop_class, area_ha.  With ``ids``, lost_seg_ids has the sorted ids of what is cut off.
    """
    counts = lost.groupBy("scenario").agg(F.count(F.lit(1)).alias("segments_cut_off"), *([F.array_sort(F.collect_set("seg_id")).alias("lost_seg_ids")] if ids else []))
    area = lost.join(cells, "seg_id").groupBy("scenario", "district", "crop_class").agg(F.sum("area_ha").alias("ha"))
    return records(counts, area, segs, economics, mix)


def single_failures(edges: DataFrame, dominated: tree.Dominators, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scenario, segments_cut_off; scenario, district, crop_class, ha) for the removal of every single edge.

    What a removal cuts off is a subtree of the dominator forest (``tree.dominators``), so counts and areas are sums
    below its head, kept by district and crop: no pairs of removed and lost segments are made.
    """
    d = dominated
    e = settle(edges.select("seg_id", F.col("src").alias("node")))
    head = d.fed.select("node", F.col("seg_id").alias("scenario"))
    under = tree.below(d.ups, e.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "n").join(head, "node").select("scenario", "n")
    counts = e.select(F.col("seg_id").alias("scenario")).join(under, "scenario", "left").select("scenario", (1 + F.coalesce("n", F.lit(0))).alias("segments_cut_off"))
    own = settle(cells.groupBy("seg_id", "district", "crop_class").agg(F.sum("area_ha").alias("ha")))
    area = tree.below(d.ups, e.join(own, "seg_id").select("node", "district", "crop_class", "ha"), "ha", by=("district", "crop_class")).join(head, "node").select("scenario", "district", "crop_class", "ha")
    mine = own.join(e.select("seg_id"), "seg_id", "left_semi").withColumnRenamed("seg_id", "scenario")
    return counts, area.unionByName(mine.select(*area.columns)).groupBy("scenario", "district", "crop_class").agg(F.sum("ha").alias("ha"))


def cut_canals(edges: DataFrame, dominated: tree.Dominators, canals: DataFrame) -> DataFrame:
    """scenario, canals: the named canals (``canals``: seg_id, canal) that each single failure cuts off, sorted.

    Names, not segments, are carried up the dominator forest.
    """
    d = dominated
    named = settle(canals.where("canal <> ''").select("seg_id", "canal").distinct())
    at = edges.select("seg_id", F.col("src").alias("node")).join(named, "seg_id").select("node", "canal").distinct().withColumn("n", F.lit(1).cast("long"))
    under = tree.below(d.ups, at, "n", by=("canal",)).join(d.fed, "node").select("seg_id", "canal")
    return under.unionByName(named).groupBy(F.col("seg_id").alias("scenario")).agg(F.array_sort(F.collect_set("canal")).alias("canals"))


def records(counts: DataFrame, area: DataFrame, segs: DataFrame, economics: DataFrame, mix: DataFrame | None = None) -> DataFrame:
    """One row a scenario: what is cut off, areas by district and crop class, and money.

    ``counts``: scenario, segments_cut_off and more; ``area``: scenario, district, crop_class, ha; ``segs``: seg_id,
    district, cost_inr, and can_name, can_type, length_m if the record is to name them; ``economics``: district,
    revenue_per_ha, and water_mm and dependency if it is to have them; ``mix``: district, crop, area.  The
    revenue takes the removed segment's district for all hectares.
    """
    by_district = area.groupBy("scenario", "district").agg(F.sum("ha").alias("ha")).groupBy("scenario").agg(F.sum("ha").alias("area_lost_ha"), F.array_sort(F.collect_list(F.struct((-F.col("ha")).alias("o"), "district", "ha"))).alias("_d"))
    by_crop = area.groupBy("scenario", "crop_class").agg(F.sum("ha").alias("ha")).groupBy("scenario").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("crop_class", "ha")))).alias("ha_by_crop"))
    has = segs.columns
    named = [F.coalesce(F.nullif("can_name", F.lit("")), F.lit("(unnamed)")).alias("can_name")] if "can_name" in has else []
    named += [F.col("can_type")] if "can_type" in has else []
    named += [(F.col("length_m") / 1000).alias("length_km")] if "length_m" in has else []
    s = segs.select(F.col("seg_id").alias("scenario"), F.col("district").alias("own_district"), F.col("cost_inr").alias("cost_inr"), *named)
    eco = economics.withColumnsRenamed({"district": "own_district", "water_mm": "water_demand_mm", "dependency": "irrigation_dependency"})
    out = counts.join(s, "scenario").join(by_district, "scenario", "left").join(by_crop, "scenario", "left").join(if_small(eco), "own_district", "left")
    out = out.withColumn("area_lost_ha", F.coalesce("area_lost_ha", F.lit(0.0)))
    out = out.withColumn("ha_by_district", F.transform(F.coalesce("_d", F.array().cast("array<struct<o:double,district:string,ha:double>>")), lambda x: F.struct(x["district"].alias("district"), x["ha"].alias("ha")))).drop("_d")
    out = out.withColumn("revenue_at_risk_inr", F.col("area_lost_ha") * F.col("revenue_per_ha"))
    out = out.withColumn("benefit_cost_ratio", ratio(F.col("revenue_at_risk_inr"), F.col("cost_inr")))
    return out if mix is None else out.join(if_small(top_share(mix, ["district"], "crop", "area").select(F.col("district").alias("own_district"), F.col("mix").alias("crop_mix_top3"))), "own_district", "left")


def combined_impact(lost: DataFrame, selected: DataFrame, segs: DataFrame, economics: DataFrame) -> DataFrame:
    """district, segments, area_ha, revenue_inr of the union of the selected scenarios' cuts, none counted twice.

    The union of single cuts is the joint cut on trees; with parallel feeds use the joint frontier
    (``graph.reach_after_removal`` with one scenario for all removed edges).
    """
    cut = lost.join(selected.select("scenario").distinct(), "scenario", "left_semi").select("seg_id").distinct()
    d = cut.join(segs.select("seg_id", "district", "local_ha"), "seg_id").groupBy("district").agg(F.count(F.lit(1)).alias("segments"), F.sum("local_ha").alias("area_ha"))
    return d.join(if_small(economics), "district", "left").select("district", "segments", "area_ha", (F.col("area_ha") * F.col("revenue_per_ha")).alias("revenue_inr"))


def crop_split(impact: DataFrame, shares: DataFrame) -> DataFrame:
    """district, crop, area_ha: a combined area split by the district's crop shares."""
    return impact.join(shares.select("district", "crop", "share"), "district").select("district", "crop", (F.col("area_ha") * F.col("share")).alias("area_ha"))


def canal_rollup(segs: DataFrame) -> DataFrame:
    """One row a canal group: km and cost are summed, the largest area, revenue and cut stand for all (the
    head reach commands the rest), health is a mean by length, and the largest reach represents it."""
    return segs.groupBy("canal").agg(
        F.count(F.lit(1)).alias("reaches"), F.sum("km").alias("km"), F.sum("cost_inr").alias("cost_inr"), F.max("area_ha").alias("area_ha"), F.max("revenue_inr").alias("revenue_inr"),
        F.max("cut").alias("cut"), ratio(F.sum(F.col("health") * F.col("km")), F.sum("km")).alias("health"), F.min_by("seg_id", F.struct((-F.col("area_ha")).alias("a"), "seg_id")).alias("representative"),
    )


def decision_score(rows: DataFrame) -> DataFrame:
    """Adds score, 0 to 100, relative to these rows: revenue 0.40, poor health 0.35, area 0.25."""
    top = rows.agg(F.max("revenue_inr").alias("_r"), F.max("area_ha").alias("_a"))  # one row
    share = lambda c, m: F.coalesce(F.try_divide(F.col(c), F.col(m)), F.lit(0.0))
    score = 100 * (0.40 * share("revenue_inr", "_r") + 0.35 * (1 - F.col("health")) + 0.25 * share("area_ha", "_a"))
    return rows.join(F.broadcast(top)).withColumn("score", score).drop("_r", "_a")


def verdict(scored: DataFrame, key: str = "canal") -> DataFrame:
    """One row: winner, runner_up and gap; none for fewer than two rows."""
    best = scored.select(key, "score").orderBy(F.desc("score"), key).limit(2)
    two = best.agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("o"), F.col(key).alias("key"), "score"))).alias("_t")).where(F.size("_t") > 1)
    first, second = F.col("_t")[0], F.col("_t")[1]
    return two.select(first["key"].alias("winner"), first["score"].alias("score"), second["key"].alias("runner_up"), (first["score"] - second["score"]).alias("gap"))


def covered_canals(lost: DataFrame, segs: DataFrame) -> DataFrame:
    """scenario, canals: the named canals that a failure cuts off, sorted."""
    named = segs.where("canal <> ''").select("seg_id", "canal")
    return lost.join(named, "seg_id").groupBy("scenario").agg(F.array_sort(F.collect_set("canal")).alias("canals"))
