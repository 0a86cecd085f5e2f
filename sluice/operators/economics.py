"""Crop economics of districts, and costs of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import params as P
from ..functions.scalar import clip, half_even


def normalise_district(name: Column, aliases: dict[str, str] | None = None, default: str = P.DEFAULT_DISTRICT) -> Column:
    """Upper case without outer blanks, other spellings mapped; the default where there is none."""
    aliases = P.DISTRICT_ALIAS if aliases is None else aliases
    n = F.upper(F.trim(name))
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.when(name.isNull() | (F.trim(name) == ""), F.lit(default)).otherwise(F.coalesce(F.element_at(table, n), n))


def segment_district(segs: DataFrame, spatial: DataFrame | None, known: DataFrame, default: str = P.DEFAULT_DISTRICT) -> DataFrame:
    """seg_id, district: the normalised spatial district if known, else that of the project, else the default.

    ``segs`` has seg_id and prj_name; ``known`` the districts of the crop table.
    """
    spatial = spatial if spatial is not None else segs.select("seg_id").limit(0).withColumn("district", F.lit(None).cast("string"))
    k = F.broadcast(known.select(F.upper("district").alias("_known")).distinct())
    project = F.element_at(F.create_map(*[F.lit(x) for kv in P.PROJECT_DISTRICT.items() for x in kv]), F.col("prj_name"))
    j = segs.select("seg_id", "prj_name").join(spatial.select("seg_id", "district"), "seg_id", "left").withColumn("_n", normalise_district(F.col("district"), default=default))
    j = j.join(k, F.col("_n") == F.col("_known"), "left")
    return j.select("seg_id", F.coalesce("_known", project, F.lit(default)).alias("district"))


def mix_shares(areas: DataFrame, district: str = "district", crop: str = "crop", area: str = "area") -> DataFrame:
    """district, crop, area, share of the district's total."""
    g = areas.groupBy(district, crop).agg(F.sum(area).alias(area))
    return g.withColumn("share", F.col(area) / F.sum(area).over(Window.partitionBy(district)))


def revenue_per_ha(shares: DataFrame, price: DataFrame, yields: DataFrame) -> DataFrame:
    """district, revenue_per_ha: shares times price times yield; crops without either are skipped, and the
    shares of the rest are not raised."""
    return shares.join(F.broadcast(price), "crop").join(F.broadcast(yields), "crop").groupBy("district").agg(F.sum(F.col("share") * F.col("price") * F.col("yield")).alias("revenue_per_ha"))


def water_demand(shares: DataFrame, keys: DataFrame, water: DataFrame) -> DataFrame:
    """district, water_mm: the mean of the crops' mid demand, by share over the crops that have one; 0 if none."""
    w = water.groupBy("water_crop").agg(F.first((F.col("min_mm") + F.col("max_mm")) / 2.0).alias("mid"))
    j = shares.join(F.broadcast(keys), "crop").join(F.broadcast(w), "water_crop")
    s = j.groupBy("district").agg(F.sum(F.col("share") * F.col("mid")).alias("a"), F.sum("share").alias("b"))
    return shares.select("district").distinct().join(s, "district", "left").select("district", F.when(F.col("b") > 0, F.col("a") / F.col("b")).otherwise(0.0).alias("water_mm"))


def irrigation_dependency(rain_mm: Column, demand_mm: Column) -> Column:
    """The share of the demand that rain leaves open, in [0, 1]; 0.5 where the demand is not positive."""
    return F.when(demand_mm > 0, clip(1.0 - rain_mm / demand_mm, 0.0, 1.0)).otherwise(0.5)


def rain_deficit(dev_pct: Column) -> Column:
    return -dev_pct / 100.0


def district_summary(production: DataFrame, water: DataFrame, rain: DataFrame, default: str = P.DEFAULT_DISTRICT) -> DataFrame:
    """district, total_ha, top_crop, top_share, cane_share, revenue_per_ha, water_mm, rain_mm, deficit, dependency."""
    spark = production.sparkSession
    shares = mix_shares(production.select(F.col("District").alias("district"), F.col("Crop").alias("crop"), F.col("Area_ha").alias("area")))
    price, yields, keys = P.mapping(spark, P.CROP_PRICE, "crop", "price"), P.mapping(spark, P.CROP_YIELD, "crop", "yield"), P.mapping(spark, P.WATER_KEY, "crop", "water_crop")
    w = water.select(F.col("Crop").alias("water_crop"), F.col("Water_min_mm").alias("min_mm"), F.col("Water_max_mm").alias("max_mm"))
    base = shares.groupBy("district").agg(
        F.sum("area").alias("total_ha"), F.max_by("crop", "share").alias("top_crop"), F.max("share").alias("top_share"),
        F.coalesce(F.sum(F.when(F.col("crop") == "Sugarcane", F.col("share"))), F.lit(0.0)).alias("cane_share"),
    )
    r = rain.select(F.col("District").alias("district"), F.col("Actual_mm").alias("rain_mm"), rain_deficit(F.col("Dev_pct")).alias("deficit"))
    # two independent fallbacks: the mix is the district's own here, the rain may be the default district's
    fallback = r.where(F.col("district") == default).select(F.col("rain_mm").alias("_r"), F.col("deficit").alias("_d"))
    out = base.join(revenue_per_ha(shares, price, yields), "district", "left").join(water_demand(shares, keys, w), "district", "left")
    out = out.join(F.broadcast(r), "district", "left").join(F.broadcast(fallback), how="left")
    out = out.withColumn("rain_mm", F.coalesce("rain_mm", "_r")).withColumn("deficit", F.coalesce("deficit", "_d")).drop("_r", "_d")
    return out.withColumn("dependency", irrigation_dependency(F.col("rain_mm"), F.col("water_mm")))


def desilt_cost(length_m: Column, multiplier: Column, rate: float = P.VALUES["desilt_cost_per_km"]) -> Column:
    return length_m / 1000.0 * rate * F.coalesce(multiplier, F.lit(1.0))


def with_cost(segs: DataFrame, multipliers: DataFrame) -> DataFrame:
    """Adds cost_inr; ``multipliers`` has can_type and multiplier, and any other type costs once the rate."""
    return segs.join(F.broadcast(multipliers), "can_type", "left").withColumn("cost_inr", desilt_cost(F.col("length_m"), F.col("multiplier"))).drop("multiplier")


def paddy_revenue_per_ha() -> float:
    v = P.VALUES
    return v["paddy_msp"] * 10 * v["paddy_yield"] * v["cropping_intensity"]


def district_profiles(summary: DataFrame, shares: DataFrame, k: int = 6) -> DataFrame:
    """The payload's district profile: rounded figures and the k largest crops as an array of (crop, share)."""
    w = Window.partitionBy("district").orderBy(F.desc("share"), "crop")
    top = shares.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).groupBy("district").agg(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "crop", "share"))), lambda x: F.struct(x["crop"].alias("crop"), half_even(x["share"], 4).alias("share"))).alias("mix"))
    return summary.join(top, "district").select("district", half_even(F.col("revenue_per_ha")).alias("revenue"), half_even(F.col("water_mm")).alias("water"), half_even(F.col("dependency"), 3).alias("dependency"), half_even(F.col("deficit") * -100, 1).alias("rain_dev"), "mix")
