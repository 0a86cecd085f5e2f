"""Names of reaches: own chainage for named canals, place on the nearest named one for the others."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import blank_name, half_even, km_text, plural, title_case
from ..state import if_small, ranked, settle
from .graph import named_above


def reach_names(segs: DataFrame, chain: DataFrame, parent: DataFrame) -> DataFrame:
    """seg_id, group, name, label, derived, index, reaches, km_from.

    ``segs``: seg_id, src, can_name, can_type, prj_name, length_m; ``chain``: node, metres; ``parent``:
    seg_id, up.  A named canal's reaches, and the unnamed ones that take off from it, are measured from the
    canal's own head.  Equal names get their length appended.
    """
    s = segs.join(chain.select(F.col("node").alias("src"), F.col("metres").alias("start")), "src", "left").withColumn("canal", blank_name(F.col("can_name")))
    # places in one order of all reaches, counted from each canal's first: those without a name would be one window
    s = settle(ranked(s, "_at", "canal", F.asc_nulls_last("start"), "seg_id"))
    own = s.groupBy("canal").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("reaches"), F.min("start").alias("head"))
    s = s.join(if_small(own), "canal").withColumn("index", (F.col("_at") - F.col("_first") + 1).cast("int")).drop("_at", "_first")
    above = named_above(s, parent, F.col("canal") != "").join(s.select(F.col("seg_id").alias("above"), F.col("canal").alias("above_canal"), F.col("head").alias("above_head")), "above").select("seg_id", "above_canal", "above_head")
    s = s.join(above, "seg_id", "left")
    size = F.concat(km_text(F.col("length_m")), F.lit(" km"))
    own, off = F.col("canal") != "", F.col("above_canal").isNotNull()
    place = F.when(F.col("index") == 1, F.lit("head reach")).otherwise(F.concat(F.lit("reach "), F.col("index").cast("string"), F.lit("/"), F.col("reaches").cast("string")))
    at = F.concat(F.lit("at km "), km_text(F.when(off, F.col("start") - F.col("above_head")).otherwise(F.col("start"))))
    name = (
        F.when(own & (F.col("reaches") == 1), F.col("canal")).when(own, F.concat("canal", F.lit(" · "), place))
        .when(off, F.concat("can_type", F.lit(" off "), "above_canal", F.lit(" "), at)).otherwise(F.concat("can_type", F.lit(", "), "prj_name", F.lit(" "), at))
    )
    label = (
        F.when(own, F.concat(place, F.lit(" · "), size, F.when(F.col("index") > 1, F.concat(F.lit(" · from km "), km_text(F.col("start") - F.col("head")))).otherwise("")))
        .when(off, F.concat(at, F.lit(" · "), size)).otherwise(F.concat("can_type", F.lit(" "), at, F.lit(" · "), size))
    )
    group = F.when(own, F.col("canal")).when(off, F.concat(plural(F.col("can_type")), F.lit(" off "), F.col("above_canal"))).otherwise(F.concat("prj_name", F.lit(" · unnamed reaches")))
    s = s.withColumns({"group": group, "derived": ~own, "_name": name, "label": label})
    twice = F.count(F.lit(1)).over(Window.partitionBy("_name")) > 1
    s = s.withColumn("name", F.when(twice, F.concat("_name", F.lit(" ("), size, F.lit(")"))).otherwise(F.col("_name")))
    return s.select("seg_id", "group", "name", "label", "derived", F.col("index").cast("long"), "reaches", F.bround(F.col("start") / 1000, 2).alias("km_from"))


def payload(segs: DataFrame, names: DataFrame) -> DataFrame:
    """What a map shows of each segment, in 19 fields, rounded as shown.

    ``segs``: seg_id, can_name, can_type, prj_name, district, length_m, command_ha, local_ha, health, bc_norm,
    priority, priority_norm, rank, cost_inr, geom (in degrees); ``names``: see ``reach_names``.
    """
    own = blank_name(F.col("can_name"))
    n = names.select("seg_id", "name", "group", "label", "km_from")
    s = segs.join(n, "seg_id", "left")
    return s.select(
        F.col("seg_id").alias("id"), F.coalesce("name", F.when(own != "", own), F.lit("(unnamed reach)")).alias("name"), F.coalesce("group", F.when(own != "", own), "prj_name").alias("canal"),
        F.coalesce("label", F.lit("")).alias("reach"), F.coalesce("km_from", F.lit(0.0)).alias("kmFrom"), (own == "").alias("derived"), F.col("can_type").alias("type"), F.col("prj_name").alias("project"),
        title_case(F.col("district")).alias("district"), half_even(F.col("length_m") / 1000, 2).alias("km"), half_even(F.col("command_ha")).alias("area"), half_even(F.col("local_ha")).alias("local"),
        half_even(F.col("health"), 3).alias("health"), half_even(F.col("bc_norm"), 3).alias("cent"), half_even(F.col("priority")).alias("priority"), half_even(F.col("priority_norm"), 4).alias("pnorm"), "rank",
        half_even(F.col("cost_inr")).alias("cost"), F.transform("geom", lambda p: F.array(half_even(p["x"], 5), half_even(p["y"], 5))).alias("coords"),
    )


def number_collisions(df: DataFrame, name: str, order: str) -> DataFrame:
    """Names that occur more than once get " #n", in the given order."""
    w = Window.partitionBy(name)
    n, k = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy(order))
    return df.withColumn("_n", F.when(n > 1, F.concat(name, F.lit(" #"), k.cast("string"))).otherwise(F.col(name))).drop(name).withColumnRenamed("_n", name)


def group_key(derived, seg_id, canal):
    """What a segment is rolled up by: its canal, or itself where the name is derived."""
    return F.when(derived, seg_id).otherwise(canal)
