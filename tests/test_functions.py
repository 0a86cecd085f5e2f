"""Functions, economics, health, sources and streams."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import geo, scalar, stats
from sluice.operators import economics, health
from sluice.sources import grids, kml, tables
from sluice.streaming import events, labels

NAN = float("nan")


def test_missing_numbers(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,)], "x double")
    assert [r[0] for r in df.select(scalar.above(F.col("x"), 0.5)).collect()] == [True, False, False]
    assert [r[0] for r in df.select(scalar.clip(scalar.known(F.col("x")), 0.0, 0.4)).collect()] == [0.4, None, None]


def test_text(spark):
    r = spark.range(1).select(scalar.km_text(F.lit(250.0)).alias("a"), scalar.km_text(F.lit(float("inf"))).alias("b"), scalar.plural(F.lit("Distributary")).alias("c"), scalar.title_case(F.lit("THE CANAL")).alias("d"), scalar.half_even(F.lit(2.5)).alias("e")).first()
    assert tuple(r) == ("0.2", "?", "Distributaries", "The Canal", 2.0)
    u = spark.range(2000).select(scalar.uniform(F.lit(1), "id").alias("u")).toPandas()["u"]
    assert 0 < u.min() and u.max() <= 1 and abs(u.mean() - 0.5) < 0.03


def test_average_rank_and_bins(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([3.0, 1.0, 3.0, None, 2.0])], "id int, v double")
    got = {r["id"]: r["r"] for r in stats.average_rank(df, "v", "r").collect()}
    assert got == {0: 3.5 / 4, 1: 0.25, 2: 3.5 / 4, 3: None, 4: 0.5}
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None])], "id int, v double")
    got = {r["id"]: r["b"] for r in stats.quartile_bins(df, "v", "b").collect()}
    assert [got[i] for i in range(10)] == [0, 0, 0, 0, 0, 1, 1, 2, 2, None]


def test_projection_round_trip(spark):
    pts = [(78.8181, 10.8306), (79.9, 11.39), (81.0, 10.0)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    e, n = geo.to_utm(F.col("lon"), F.col("lat"))
    df = df.select("*", e.alias("e"), n.alias("n"))
    lon, lat = geo.from_utm(F.col("e"), F.col("n"))
    for r in df.select("*", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert abs(r["lon"] - r["lon2"]) < 1e-9 and abs(r["lat"] - r["lat2"]) < 1e-9
        if r["lon"] == 81.0:  # on the central meridian
            assert r["e"] == pytest.approx(500000, abs=1e-6) and r["n"] == pytest.approx(1105412.491, abs=0.01)


# Crop areas (ha) of one district, water demand (mm, least and most) and rain (mm, normal, deviation).
AREAS = [
    ("Rice", 3453), ("Rice", 2693), ("Rice", 40407), ("Jowar", 216), ("Jowar", 1125), ("Other Pulses", 125), ("Other Pulses", 942), ("Bajra", 35), ("Maize", 375),
    ("Groundnut", 1453), ("Sesamum", 1198), ("Sunflower", 80), ("Other Oilseeds", 4420), ("Cotton", 385), ("Sugarcane", 1749), ("Arhar/Tur", 20), ("Other Non Food Crops", 2105), ("Fodder Crops", 188),
]
WATER = [
    ("rice", 900, 2500), ("maize", 500, 800), ("sorghum", 450, 650), ("pearl millet", 350, 500), ("blackgram", 600, 1000), ("redgram", 600, 1400), ("groundnut", 500, 700),
    ("sunflower", 350, 500), ("gingely", 350, 400), ("castor", 500, 500), ("cotton", 700, 1300), ("sugarcane", 1500, 2500), ("fodder cholam", 300, 350),
]
RAIN = (641.2, 774.9, -17.3)


def test_district_goldens(spark):
    production = spark.createDataFrame([("TIRUCHIRAPPALLI", 2017, c, str(i), float(a)) for i, (c, a) in enumerate(AREAS)] + [("NEW", 2017, "Rice", "x", 10.0)], tables.SCHEMAS["crop_production"])
    water = spark.createDataFrame([(c, "t", float(a), float(b), 1, 2, "both") for c, a, b in WATER], tables.SCHEMAS["crop_water"])
    rain = spark.createDataFrame([("TIRUCHIRAPPALLI", *RAIN), ("THANJAVUR", 915.8, 1017.3, -10.0)], tables.SCHEMAS["rainfall"])
    got = {r["district"]: r for r in economics.district_summary(production, water, rain).collect()}
    r = got["TIRUCHIRAPPALLI"]
    # The district's figures.
    assert (r["total_ha"], r["top_crop"]) == (60969, "Rice")
    want = (0.7635519690, 88921.82158966032, 1503.7888182930144, 0.5736103419575622)
    assert [r["top_share"], r["revenue_per_ha"], r["water_mm"], r["dependency"]] == pytest.approx(want, rel=1e-9)
    assert got["NEW"]["rain_mm"] == 915.8 and got["NEW"]["dependency"] == pytest.approx(1 - 915.8 / 1700)  # its rain is the default district's


def test_costs(spark):
    cost = spark.createDataFrame([("Main Canal", 4397.054909134805), ("Other", 1000.0)], "can_type string, length_m double")
    from sluice.functions.params import COST_MULTIPLIER, mapping

    got = sorted(r["cost_inr"] for r in economics.with_cost(cost, mapping(spark, COST_MULTIPLIER, "can_type", "multiplier")).collect())
    assert got == pytest.approx([239644.0, 2107455.6532894024])


def test_csv_reads_nan_as_null(spark, tmp_path):
    (tmp_path / "r.csv").write_text("District,Actual_mm,Normal_mm,Dev_pct\nA,1.5,NaN,\n")
    r = tables.read_csv(spark, str(tmp_path / "r.csv"), tables.SCHEMAS["rainfall"]).first()
    assert tuple(r) == ("A", 1.5, None, None)


def test_district_of_segments(spark):
    segs = spark.createDataFrame([("a", "Kattalai"), ("b", "Kattalai"), ("c", "none"), ("d", None), ("e", None)], "seg_id string, prj_name string")
    spatial = spark.createDataFrame([("a", " tiruchchirappalli "), ("b", "UNKNOWN"), ("c", "UNKNOWN"), ("e", "KARAIKAL")], "seg_id string, district string")
    known = spark.createDataFrame([("TIRUCHIRAPPALLI",), ("THANJAVUR",), ("KARUR",), ("NAGAPATTINAM",)], "district string")
    got = {r["seg_id"]: r["district"] for r in economics.segment_district(segs, spatial, known).collect()}
    assert got == {"a": "TIRUCHIRAPPALLI", "b": "KARUR", "c": "THANJAVUR", "d": "THANJAVUR", "e": "NAGAPATTINAM"}
    assert {r["district"] for r in economics.segment_district(segs, None, known).collect()} == {"THANJAVUR"}


def test_health_of_segments(spark):
    pts = spark.createDataFrame([("s", p, c) for p, c in ((0.1, "b"), (0.2, "a"), (0.4, "b"), (0.8, "a"), (None, "c"))], "seg_id string, p_impaired double, pred_class string")
    r = health.segment_health(pts).first()
    assert (r["n_points"], r["dominant_class"], r["worst_p_impaired"]) == (5, "a", 0.8)
    assert (r["mean_p_impaired"], r["p75_p_impaired"], r["health_score_worst_reach"]) == pytest.approx((0.375, 0.5, 0.5))


def test_label_queue(spark):
    rows = [(f"p{i}", "Minor" if i % 10 else "Main", float(i % 8), float(i), 6.0 if i % 7 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "point_id string, can_type string, x double, dry_ndvi_diff double, dry_nobs double")
    q = health.label_queue(df, 40).collect()
    assert len({r["point_id"] for r in q}) == 40 and all(r["dry_nobs"] == 6.0 for r in q)
    assert [r["point_id"] for r in q] == [r["point_id"] for r in health.label_queue(df.repartition(3), 40).collect()]
    assert min(sum(r["can_type"] == "Main" for r in q), 12) == 12


def test_forest(spark):
    rng = np.random.default_rng(0)
    rows = [(i, f"g{i % 20}", float(a), float(b) if i % 9 else None, "choked" if a + b > 1.1 else "flowing") for i, (a, b) in enumerate(rng.random((240, 2)))]
    df = spark.createDataFrame(rows, "id long, seg string, a double, b double, label string")
    m = health.train_forest(df, ["a", "b"], "label", trees=15)
    p = health.predict_forest(m, df, ["choked", "encroached"])
    assert p.where("pred_class = label").count() > 210 and p.where("abs(p_choked - p_impaired) > 1e-12").count() == 0
    cv = health.cross_validate(df, ["a", "b"], "label", "seg", folds=3, trees=10)
    assert cv.agg(F.sum("n")).first()[0] == 240 and cv.agg(F.min("accuracy")).first()[0] > 0.7
    imp = {r["feature"]: r["drop"] for r in health.permutation_importance(m, df, ["a", "b"], "label", 1).collect()}
    assert imp["a"] > 0.05
    with pytest.raises(ValueError):
        health.train_forest(df.where("label = 'choked'"), ["a", "b"], "label")


def test_season_algebra(spark):
    r = spark.range(1).select(scalar.normalised_difference(F.lit(3.0), F.lit(1.0)).alias("a"), scalar.normalised_difference(F.lit(0.0), F.lit(0.0)).alias("b"), scalar.ring_mean(F.lit(2.0), F.lit(1.0), 60, 30).alias("c")).first()
    assert r["a"] == 0.5 and r["b"] is None and r["c"] == pytest.approx((2 * 3600 - 900) / 2700)


def test_label_file_repair(spark, tmp_path):
    (tmp_path / "labels.csv").write_text("point_id,label\np1,s1,flowing,1.5,2.5\np2,s2,dry,x,2\n,s,dry,1,1\nbroken,row\n")
    got = {r["point_id"]: r["lat"] for r in tables.read_labels(spark, str(tmp_path / "labels.csv")).collect()}
    assert got == {"p1": 1.5, "p2": None}


def test_kml_and_ways(spark, tmp_path):
    (tmp_path / "c.kml").write_text(
        '<?xml version="1.0"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark><name>A</name><ExtendedData><SchemaData schemaUrl="#s"><SimpleData name="can_type">Minor</SimpleData><SimpleData name="basin">B</SimpleData></SchemaData></ExtendedData>'
        "<MultiGeometry><LineString><coordinates>1,2,0 3,4,0</coordinates></LineString><LineString><coordinates>5,6 7,8</coordinates></LineString></MultiGeometry></Placemark>"
        "<Placemark><name>B</name><ExtendedData><SchemaData schemaUrl=\"#s\"><SimpleData name=\"can_type\">Main</SimpleData></SchemaData></ExtendedData><LineString><coordinates>0,0 1,1</coordinates></LineString></Placemark></Document></kml>"
    )
    got = sorted((r["name"], r["can_type"], r["basin"], [(p["x"], p["y"]) for p in r["geom"]]) for r in kml.read_kml(spark, str(tmp_path / "c.kml"), ["can_type", "basin"]).collect())
    assert got == [("A", "Minor", "B", [(1, 2), (3, 4)]), ("A", "Minor", "B", [(5, 6), (7, 8)]), ("B", "Main", None, [(0, 0), (1, 1)])]
    (tmp_path / "o.json").write_text(json.dumps({"elements": [{"type": "way", "id": 7, "tags": {"waterway": "river"}, "geometry": [{"lat": 1, "lon": 2}, {"lat": 3, "lon": 4}]}, {"type": "node", "id": 8}]}))
    r = tables.overpass_ways(spark, str(tmp_path / "o.json")).collect()
    assert len(r) == 1 and r[0]["osm_id"] == 7 and r[0]["name"] == "" and r[0]["geom"][1]["x"] == 4


def test_npz(spark, tmp_path):
    np.savez(tmp_path / "g.npz", grid=np.array([[1, NAN], [0.5, 2]], dtype=np.float32), bounds=np.array([0.0, 0, 2, 2]))
    cells, meta = grids.read_npz(spark, str(tmp_path / "g.npz"))
    assert {(r["row"], r["col"]): r["value"] for r in cells.collect()} == {(0, 0): 1, (0, 1): 0, (1, 0): 0.5, (1, 1): 2} and meta.first()["nx"] == 2


def test_optional_table(spark, tmp_path):
    assert tables.read_optional(spark, f"file://{tmp_path}/none", "a int").count() == 0
    tables.append(spark.range(3), f"{tmp_path}/t")
    tables.append(spark.range(2), f"{tmp_path}/t")
    assert tables.read_optional(spark, f"file://{tmp_path}/t", "id long").count() == 5


def test_label_log(spark):
    log = spark.createDataFrame([("p", 1, "label", "dry"), ("p", 2, "label", "choked"), ("p", 3, "undo", None), ("q", 4, "label", "dry"), ("q", 5, "undo", None), ("q", 6, "undo", None), ("q", 7, "label", "flowing")], "point_id string, seq long, op string, label string")
    stands = labels.undo(log, "point_id", "seq")
    assert {(r["point_id"], r["seq"]) for r in stands.collect()} == {("p", 1), ("q", 7)}
    assert {r["label"] for r in labels.last_labels(stands.drop("op"), ["point_id"], "seq").collect()} == {"dry", "flowing"}


def test_label_stream(spark, tmp_path):
    rows = [("p", 1, "label", "dry"), ("p", 2, "label", "choked"), ("p", 3, "undo", None), ("q", 4, "label", "dry"), ("q", 5, "undo", None)]
    schema = "point_id string, seq long, op string, label string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    out = events.run_once(labels.stream_labels(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")), "label_stream", "update")
    assert {r["point_id"]: r["label"] for r in out.collect()} == {"p": "dry", "q": None}


def test_event_stream_equals_batch(spark, sf, tmp_path):
    batch = spark.read.parquet(f"{sf}/events.parquet")
    batch.write.parquet(f"{tmp_path}/ev")
    stream = events.read_events(spark, f"{tmp_path}/ev", batch.schema)
    got = events.run_once(events.tumbling_counts(stream), "tumble", "complete")
    key = lambda df: sorted((r["start"], r["event_type"], r["n"]) for r in df.collect())
    assert key(got) == key(events.tumbling_counts(batch))


def test_incremental_load(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/in")
    run = lambda: events.incremental(spark, f"{tmp_path}/in", spark.range(1).schema, f"{tmp_path}/out", f"{tmp_path}/ck", lambda d: d.withColumn("x", F.col("id") * 2))
    run()
    spark.range(4, 6).write.mode("append").parquet(f"{tmp_path}/in")
    run(), run()
    assert sorted(r["x"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 2, 4, 6, 8, 10]


def test_containment_and_lines(spark):
    r = spark.range(1).select(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3), (0, 0))]).alias("g"))
    r = r.select(geo.length(F.col("g")).alias("n"), geo.inside(F.col("g"), F.lit(3.0), F.lit(1.0)).alias("a"), geo.inside(F.col("g"), F.lit(1.0), F.lit(2.0)).alias("b"), geo.project(F.col("g"), F.lit(5.0), F.lit(2.0)).alias("p"), geo.interpolate(F.col("g"), F.lit(5.5)).alias("i")).first()
    assert (r["n"], r["a"], r["b"], r["p"]) == (12.0, True, False, 6.0) and (r["i"]["x"], r["i"]["y"]) == (4.0, 1.5)
    assert math.isclose(r["n"], 12)


def test_crore_rounds_the_scaled_double(spark, tmp_path):
    from __spark_entry__ import queries

    spark.createDataFrame([(1, 5750.0), (2, 5450.0), (3, 4450.0), (4, 50.0), (5, -10.0)], "c_custkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    got = {r["k"]: r["t"] for r in queries()["F23_crore"](spark, str(tmp_path)).collect()}
    assert got == {1: "0.57 Cr", 2: "0.55 Cr", 3: "0.44 Cr", 4: "0.00 Cr", 5: "-0.00 Cr"}


def test_crore_keeps_the_sign_of_zero(spark, tmp_path):
    """Balances that are rounded to cents can be -0.0, which SQL shows as -0.00; so can what rounds to it on the way."""
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    x = [-0.0, 0.0, -0.0005, 0.0005, -0.0004, -0.01, 0.01, 5750.0, -5750.0, math.nan, math.inf, -math.inf, None]
    spark.createDataFrame(list(enumerate(x)), "c_custkey long, c_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    got = {r["k"]: r["t"] for r in queries()["F23_crore"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert got == dict(con.execute(oracle_sql()["F23_crore"]).fetchall()) and got[0] == "-0.00 Cr"


def test_format_of_long_numbers(spark, tmp_path):
    from __spark_entry__ import queries

    rows = [(7, 12, "T", "B", "n"), (1234567, 3, "T", "B", "n")]
    spark.createDataFrame(rows, "p_partkey long, p_size int, p_type string, p_brand string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r["seg_id"]: (r["km"], r["id"]) for r in queries()["F5_format"](spark, str(tmp_path)).collect()}
    assert got == {7: ("1.2", "B_000007"), 1234567: ("0.3", "B_123456")}


def test_forest_leaves_its_training_behind(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 5), "x" if i > 30 else "y") for i in range(60)], "id long, a double, b double, label string")
    m = health.train_forest(df, ["a", "b"], "label", trees=5)
    assert not m.stages[-1].hasSummary
    assert health.predict_forest(m, df, ["x"]).where("pred_class = label").count() > 55
