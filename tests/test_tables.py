"""Replaced tables, extraction in chunks, running sums by range, and decisions without a window over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.functions import stats
from sluice.operators import failure, health
from sluice.sources import tables
from sluice.streaming import chunks


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = tables.replace(spark.range(5), path)
    reader = tables.read_current(spark, path)
    bad = spark.range(0, 100, 1, 4).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="midway"):
        tables.replace(bad, path, attempts=2)
    assert ids(tables.read_current(spark, path)) == list(range(5)) and tables.versions(spark, path) == [first]
    second = tables.replace(spark.range(7), path)
    assert ids(tables.read_current(spark, path)) == list(range(7))
    assert ids(reader) == list(range(5))  # who had opened the old version still reads it
    third = tables.replace(spark.range(3), path)
    assert tables.versions(spark, path) == [second, third] and ids(tables.read_current(spark, path)) == [0, 1, 2]


def test_a_write_is_tried_again(spark, tmp_path):
    class Once:
        """A frame whose first write fails."""

        def __init__(self, df):
            self.df, self.sparkSession, self.calls = df, df.sparkSession, 0

        @property
        def write(self):
            self.calls += 1
            if self.calls == 1:
                raise OSError("no answer")
            return self.df.write

    once = Once(spark.range(4))
    tables.replace(once, f"file://{tmp_path}/t", attempts=3)
    assert once.calls == 2 and ids(tables.read_current(spark, f"file://{tmp_path}/t")) == [0, 1, 2, 3]


def test_chunks_are_tried_again_and_land_once(spark, tmp_path):
    out, points = f"file://{tmp_path}/out", spark.range(103).withColumn("v", F.col("id") * 2)

    def fetch(run):
        calls = []

        def f(pdf):
            k = pdf["chunk"].iloc[0]
            calls.append(k)
            if (k == 2 and calls.count(k) < 3) or (k == 4 and run == 0):
                raise OSError("no answer")
            return pdf.assign(w=pdf["v"] + 1.0)

        return f

    first = {r["chunk"]: (r["attempts"], r["error"]) for r in chunks.resume(spark, points, fetch(0), "id long, w double", out, "id", size=10, pause=0.0).collect()}
    assert len(first) == 11 and first[2] == (3, None) and first[4] == (3, "OSError: no answer") and first[0] == (1, None)
    assert spark.read.parquet(out).count() == 93
    second = chunks.resume(spark, points, fetch(1), "id long, w double", out, "id", size=10, pause=0.0).collect()
    assert [(r["chunk"], r["error"]) for r in second] == [(0, None)]  # the ten that were missing
    got = {r["id"]: r["w"] for r in spark.read.parquet(out).collect()}
    assert got == {i: 2 * i + 1.0 for i in range(103)} and spark.read.parquet(out).count() == 103
    assert chunks.resume(spark, points, fetch(2), "id long, w double", out, "id").count() == 0


def test_running_sums(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(9)) for i in rng.sample(range(500), 200)]
    got = {r["k"]: r["s"] for r in stats.running(spark.createDataFrame(rows, "k long, v long").repartition(6), "s", "v", "k").collect()}
    want, at = {}, 0
    for k, v in sorted(rows):
        want[k], at = at, at + v
    assert got == want


def test_importance_of_all_dealings(spark):
    rng = random.Random(5)
    rows = [(x := rng.random(), rng.random(), "yes" if x > 0.5 else "no") for _ in range(120)]
    df = spark.createDataFrame(rows, "a double, b double, label string")
    imp = {r["feature"]: r for r in health.permutation_importance(health.train_forest(df, ["a", "b"], "label", trees=8), df, ["a", "b"], "label", 6).collect()}
    assert imp["a"]["drop"] > 0.3 > abs(imp["b"]["drop"]) and imp["a"]["gini"] > 0.6 and imp["a"]["gini"] + imp["b"]["gini"] == pytest.approx(1)


def test_verdict_of_ties(spark):
    rows = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 1.0)], "canal string, score double")
    assert tuple(failure.verdict(rows).first()) == ("a", 5.0, "b", 0.0)
    assert failure.verdict(rows.limit(0)).count() == 0
