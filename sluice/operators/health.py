"""Condition of points and segments: composites, heuristic scores, a forest, and segment health."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import above, clip, known
from ..functions.stats import average_rank, quantile, quartile_bins, smallest_mode
from ..state import fresh, ranked, settle, spread


def season_composite(obs: DataFrame, keys: list[str], value: str, ok: Column) -> DataFrame:
    """Median, mean and number of the unmasked observations of each key."""
    v = F.when(ok, known(F.col(value)))
    return obs.groupBy(*keys).agg(F.median(v).alias("median"), F.avg(v).alias("mean"), F.count(v).alias("nobs"))


def max_composite(obs: DataFrame, keys: list[str], value: str) -> DataFrame:
    return obs.groupBy(*keys).agg(F.max(known(F.col(value))).alias("highest"))


def feature_algebra(points: DataFrame, land_cover: bool = False) -> DataFrame:
    """Differences between seasons; with land cover also woody share, water drop and crop amplitude."""
    c = F.col
    out = points.withColumns({"ndvi_diff_amp": c("wet_ndvi_diff") - c("dry_ndvi_diff"), "water_frac_drop": c("wet_water_frac") - c("dry_water_frac"), "ndvi_chan_amp": c("wet_ndvi_chan") - c("dry_ndvi_chan")})
    if land_cover:
        out = out.withColumns({"dw_woody": c("dry_dw_trees") + c("dry_dw_shrub_and_scrub"), "dw_water_drop": c("wet_dw_water") - c("dry_dw_water"), "dw_crops_amp": c("wet_dw_crops") - c("dry_dw_crops")})
    return out


def heuristic(points: DataFrame, land_cover: bool = False, cut: float = 0.66) -> DataFrame:
    """Adds p_impaired and pred_class from ranks of vegetation and amplitude, without any labels.

    Expects columns veg, amp and water, and with ``land_cover`` also woody, built and dw_water.
    Points without veg or amp are left out.
    """
    p = points.where(known(F.col("veg")).isNotNull() & known(F.col("amp")).isNotNull())
    p = average_rank(average_rank(p, "veg", "veg_rank"), "amp", "amp_rank")
    if land_cover:
        p = average_rank(average_rank(p, "woody", "woody_rank"), "built", "built_rank")
        z = lambda n: F.coalesce(F.col(n), F.lit(0.0))
        s = 0.30 * F.col("veg_rank") + 0.20 * F.col("amp_rank") + 0.35 * z("woody_rank") + 0.15 * z("built_rank") - 0.20 * above(F.col("dw_water"), 0.15).cast("double")
    else:
        s = 0.6 * F.col("veg_rank") + 0.4 * F.col("amp_rank") - 0.15 * above(F.col("water"), 0.10).cast("double")
    p = p.withColumn("p_impaired", clip(s, 0.0, 1.0))
    return p.withColumn("pred_class", F.when(above(F.col("p_impaired"), cut), "suspect").otherwise("ok"))


def segment_health(points: DataFrame, method: str = "heuristic") -> DataFrame:
    """One row a segment: n_points, mean, 75th percentile and worst of p_impaired, health and the modal class."""
    p = known(F.col("p_impaired"))
    g = points.groupBy("seg_id").agg(
        F.count(F.lit(1)).alias("n_points"), F.avg(p).alias("mean_p_impaired"), quantile(p, 0.75).alias("p75_p_impaired"),
        F.max(p).alias("worst_p_impaired"), smallest_mode(F.col("pred_class")).alias("dominant_class"),
    )
    return g.withColumns({"health_score": clip(1 - F.col("mean_p_impaired"), 0.0, 1.0), "health_score_worst_reach": clip(1 - F.col("p75_p_impaired"), 0.0, 1.0), "method": F.lit(method)})


def stratified_queue(points: DataFrame, strata: list[str], total: int, key: Column) -> DataFrame:
    """``total`` rows: an equal quota from each stratum (one at least), topped up from the rest, in an order
    that depends on ``key`` alone.  ``points`` has point_id."""
    groups = points.select(*strata).distinct().agg(F.count(F.lit(1)).alias("_g"))
    p = points.withColumn("_k", key).join(F.broadcast(groups))
    p = p.withColumn("_rn", F.row_number().over(Window.partitionBy(*strata).orderBy("_k", "point_id")))
    p = p.withColumn("_picked", F.col("_rn") <= F.greatest(F.lit(1), F.floor(F.lit(total) / F.col("_g"))))
    # picked rows come first, then the rest; the order of the queue is by key
    return p.orderBy(F.desc("_picked"), "_k", "point_id").limit(total).orderBy("_k", "point_id").drop("_k", "_g", "_rn", "_picked")


def label_queue(points: DataFrame, total: int = 300, least_obs: float = 5, seed: int = 42) -> DataFrame:
    p = points.where(F.coalesce("dry_nobs", F.lit(0.0)) >= least_obs).dropDuplicates(["point_id"])
    p = quartile_bins(p, "dry_ndvi_diff", "bin")
    return stratified_queue(p, ["can_type", "bin"], total, F.md5(F.concat_ws(":", F.lit(seed), "point_id")))


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """Adds weight: rows / (classes * rows of the class)."""
    per = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = per.agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    return rows.join(F.broadcast(per), label).join(F.broadcast(total)).withColumn("weight", F.col("_all") / (F.col("_k") * F.col("_n"))).drop("_n", "_all", "_k")


def group_fold(group: Column, folds: int) -> Column:
    """The fold of a row, the same for all rows of a group."""
    return F.pmod(F.conv(F.substring(F.md5(group.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")


def held_out_groups(rows: DataFrame, group: str, share: float = 0.25) -> DataFrame:
    """Adds held_out: true for the groups with the least digests, ``share`` of them."""
    g = settle(rows.select(group).distinct().withColumn("_k", F.md5(F.col(group).cast("string"))))
    g = ranked(g, "_n", "_k", group).withColumn("held_out", F.col("_n") <= F.ceil(F.lit(share * g.count())))
    return rows.join(g.select(group, "held_out"), group)


def _assembled(rows: DataFrame, features: list[str]):
    from pyspark.ml.feature import Imputer, VectorAssembler

    return [Imputer(inputCols=features, outputCols=[f"_{f}" for f in features], strategy="median"), VectorAssembler(inputCols=[f"_{f}" for f in features], outputCol="_x")]


def train_forest(rows: DataFrame, features: list[str], label: str, trees: int = 400, depth: int = 8, leaf: int = 3, seed: int = 42):
    """A random forest on balanced classes, as a pipeline model; needs two classes at least.

    The model is saved and loaded: as fitted, it drags the summary of its training along, with the plan over the
    training rows, into every task that predicts, which fails where that can't be serialised.  The rows are written out,
    as the stages read them a dozen times: dealt to all cores and in order, so that reruns draw the same samples.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer

    rows = settle(spread(rows.select(label, *features)).sortWithinPartitions(label, *features))
    kinds = rows.groupBy(label).count().collect()
    if len(kinds) < 2:
        raise ValueError("labels of two classes at least are needed")
    rows = settle(class_weights(rows, label))
    index = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc")
    forest = RandomForestClassifier(featuresCol="_x", labelCol="_y", weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed)
    path = fresh(rows.sparkSession, "model")
    Pipeline(stages=[index, *_assembled(rows, features), forest]).fit(rows).save(path)
    return PipelineModel.load(path)


def class_guard(rows: DataFrame, label: str, few: int = 5) -> DataFrame:
    """klass, n, warning: classes of fewer than ``few`` rows, and all of them where there is only one."""
    g = rows.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("klass")).agg(F.count(F.lit(1)).alias("n"))
    many = g.agg(F.count(F.lit(1)).alias("_k"))
    text = F.when(F.col("_k") < 2, "labels of two classes at least are needed").when(F.col("n") < few, F.concat(F.lit("only "), F.col("n").cast("string"), F.lit(" rows")))
    return g.join(F.broadcast(many)).select("klass", "n", F.coalesce(text, F.lit("")).alias("warning"))


def predict_forest(model, rows: DataFrame, impaired: list[str]) -> DataFrame:
    """Adds p_<class> for every class, p_impaired over those of ``impaired`` present, and pred_class."""
    from pyspark.ml.functions import vector_to_array

    labels = model.stages[0].labels
    out = rows
    for stage in model.stages[1:]:
        out = stage.transform(out)
    p = vector_to_array("probability")
    out = out.withColumns({f"p_{c}": p[i] for i, c in enumerate(labels)})
    total = sum((F.col(f"p_{c}") for c in labels if c in impaired), F.lit(0.0))
    named = F.element_at(F.array(*[F.lit(c) for c in labels]), F.col("prediction").cast("int") + 1)
    return out.withColumns({"p_impaired": total, "pred_class": named}).drop("_x", "rawPrediction", "probability", "prediction", *[c for c in out.columns if c.startswith("_")])


def cross_validate(rows: DataFrame, features: list[str], label: str, group: str, folds: int = 5, **options) -> DataFrame:
    """fold, n, accuracy: each fold's rows predicted by a forest trained on the other groups."""
    spark = rows.sparkSession
    k = max(2, min(folds, rows.select(group).distinct().count(), rows.groupBy(label).count().agg(F.min("count")).first()[0]))
    rows = rows.withColumn("_fold", group_fold(F.col(group), k))
    out = []
    for f in range(k):
        train, test = rows.where(F.col("_fold") != f).drop("_fold"), rows.where(F.col("_fold") == f).drop("_fold")
        if train.select(label).distinct().count() < 2 or not test.limit(1).count():
            continue
        got = predict_forest(train_forest(train, features, label, **options), test, []).agg(F.count(F.lit(1)), F.avg((F.col("pred_class") == F.col(label)).cast("double"))).first()
        out.append((f, got[0], got[1]))
    return spark.createDataFrame(out, "fold int, n long, accuracy double")


def permutation_importance(model, rows: DataFrame, features: list[str], label: str, repeats: int = 20, seed: int = 42) -> DataFrame:
    """feature, gini, drop: the forest's own importance, and the mean loss of accuracy over ``repeats`` dealings of the
    feature's values to other rows.

    Rows are numbered in a shuffled order; in each dealing row i takes the value of row (a i + b) mod n, with a prime to
    n, which is a permutation.  All dealings of all features are one join and are predicted in one job.
    """
    spark, rng = rows.sparkSession, random.Random(seed)
    key = F.md5(F.concat_ws(":", F.lit(seed), *[F.col(f).cast("string") for f in features]))
    base = settle(ranked(rows.withColumn("_k", key), "_i", "_k").drop("_k").withColumn("_i", F.col("_i") - 1))
    n = base.count()
    deals = []
    for f in features:
        for r in range(repeats):
            a = next(x for x in iter(lambda: rng.randrange(1, max(2, n)), None) if math.gcd(x, max(1, n)) == 1)
            deals.append((f, r, a, rng.randrange(max(1, n))))
    deal = F.broadcast(spark.createDataFrame(deals, "_f string, _r int, _a long, _b long"))  # features times repeats
    dealt = base.join(deal).withColumn("_j", (F.col("_a") * F.col("_i") + F.col("_b")) % n)
    given = base.select(F.col("_i").alias("_j"), *[F.col(f).alias(f"_v_{f}") for f in features])
    mixed = dealt.join(given, "_j").withColumns({f: F.when(F.col("_f") == f, F.col(f"_v_{f}")).otherwise(F.col(f)) for f in features})
    mixed = settle(mixed.select(*rows.columns, F.col("_f").alias("dealt"), F.col("_r").alias("deal")))
    hit = F.avg((F.col("pred_class") == F.col(label)).cast("double"))
    whole = predict_forest(model, base.drop("_i"), []).agg(hit).first()[0]
    drop = predict_forest(model, mixed, []).groupBy("dealt", "deal").agg(hit.alias("_s")).groupBy("dealt").agg(F.avg(F.lit(whole) - F.col("_s")).alias("drop"))
    gini = spark.createDataFrame(list(zip(features, [float(x) for x in model.stages[-1].featureImportances.toArray()], strict=True)), "feature string, gini double")
    return gini.join(drop, F.col("feature") == F.col("dealt")).select("feature", "gini", "drop")


def confusion(rows: DataFrame, truth: str, pred: str) -> DataFrame:
    return rows.groupBy(truth, pred).agg(F.count(F.lit(1)).alias("n"))


def report(rows: DataFrame, truth: str, pred: str) -> DataFrame:
    """klass, precision, recall, f1, support of every class."""
    c = confusion(rows, truth, pred)
    t = c.groupBy(F.col(truth).alias("klass")).agg(F.sum("n").alias("support"))
    q = c.groupBy(F.col(pred).alias("klass")).agg(F.sum("n").alias("said"))
    hit = c.where(F.col(truth) == F.col(pred)).select(F.col(truth).alias("klass"), F.col("n").alias("hit"))
    j = t.join(q, "klass", "full").join(hit, "klass", "left").na.fill(0, ["support", "said", "hit"])
    j = j.withColumns({"precision": F.coalesce(F.try_divide("hit", "said"), F.lit(0.0)), "recall": F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))})
    return j.select("klass", "precision", "recall", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)).alias("f1"), "support")
