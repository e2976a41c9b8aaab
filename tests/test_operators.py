import pytest
from pyspark.sql import functions as F

from driftscan.operators import curation, evaluation, rules, sampling, stats


def test_rule_score(spark):
    df = spark.createDataFrame([(1, 0.01, 0.99, 0.10, 0.98), (2, 0.02, 0.99, 0.10, 0.98)], "image_id int, mean_optical_density double, solidity double, eccentricity double, intensity_ratio double")
    a, b = rules.rule_score(df).orderBy("image_id").collect()
    assert a["bubble_score"] == pytest.approx(0.6533333, abs=1e-6) and a["is_bubble_hard"] and not a["is_bubble_scored"] and a["is_bubble"]
    assert b["bubble_score"] == pytest.approx(0.4533333, abs=1e-6) and not b["is_bubble"]


def test_image_vote_half_is_kept(spark):
    o = spark.createDataFrame([("a", True, 1.0), ("a", False, 0.0), ("b", True, 0.9)], "image_id string, is_bubble boolean, bubble_score double")
    got = {r["image_id"]: r["is_bubble"] for r in rules.image_vote(o).collect()}
    assert got == {"a": False, "b": True}
    kept = rules.apply_verdict(spark.createDataFrame([("a",), ("b",), ("c",)], "image_id string"), rules.image_vote(o)).collect()
    assert sorted((r["image_id"], r["object_count"]) for r in kept) == [("a", 2), ("c", 0)]


def test_segments(spark):
    t = [f"2024-01-01 00:{m:02}:00" for m in (0, 10, 30, 40)] + ["2024-01-01 01:00:00"]
    df = spark.createDataFrame([(1, k, x, 50.0, 5.0) for k, x in enumerate(t)], "key int, id int, ts string, lat double, lon double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    s = stats.track_segments(df, "key", "ts", "id")
    assert [r["segment_id"] for r in s.orderBy("id").collect()] == [0, 0, 1, 1, 2]
    assert stats.segment_lines(s, "key", "ts", "id").count() == 2


def test_tiers(spark):
    want = {1001: 100, 1000: 50, 500: 50, 499: 20, 100: 20, 99: 7, 50: 7, 49: 3, 10: 3, 9: 0}
    got = spark.createDataFrame([(n,) for n in want], "n int").select("n", sampling.tier_size(F.col("n")).alias("t")).collect()
    assert {r["n"]: r["t"] for r in got} == want


def test_percent_keeps_background(spark):
    df = spark.createDataFrame([("t", f"{k}", k == 0) for k in range(100)], "tar string, id string, back boolean")
    out = sampling.percent(df, "tar", "id", 50, F.col("back"))
    assert out.count() == 51 and out.filter("back").count() == 1


def test_coverage_axis(spark):
    df = spark.createDataFrame([("2024-01-01 14:50:00",), ("2024-01-01 17:10:00",)], "ts string").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert [r["count"] for r in stats.coverage(df, "ts", "hour").orderBy("unit_start").collect()] == [1, 0, 0, 1]
    assert stats.coverage(df.limit(0), "ts", "hour").count() == 0


def test_bucket_oversize(spark):
    df = spark.createDataFrame([(457, 500)], "height int, width int")
    assert stats.assign_buckets(df, 300, "floor").first()["bucket"] == "300x300"
    with pytest.raises(Exception, match="larger than its bucket"):
        stats.assign_buckets(df, 300, "floor", "error").collect()


def test_scores_label_sets(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "c")], "label string, pred string")
    assert {r["class"] for r in evaluation.class_scores(df).collect()} == {"a", "b"}
    assert evaluation.macro_scores(df).first()["macro_recall"] == pytest.approx(0.5 / 3)
    m = {(r["label"], r["pred"]): r["count"] for r in evaluation.confusion(df).collect()}
    assert m == {("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 0}


def test_ensemble_missing_class(spark):
    a = spark.createDataFrame([("x", 0.2, 0.8)], "id string, c0 double, c1 double")
    b = spark.createDataFrame([("x", 0.6)], "id string, c0 double")
    r = evaluation.ensemble([a, b], ["id"], ["c0", "c1"]).first()
    assert (r["c0"], r["c1"], r["ens_pred"]) == (pytest.approx(0.4), 0.8, "c1")


def test_curation(spark):
    files = spark.createDataFrame([("f1", "x"), ("f2", "x"), ("f3", "y")], "name string, content string")
    g = curation.duplicate_groups(files, "content", "name").collect()
    assert [r["names"] for r in g] == [["f1", "f2"]]
    left = spark.createDataFrame([(1, None, 2.0)], "label int, a double, b double")
    right = spark.createDataFrame([(1, 5.0, 6.0)], "label int, a double, c double")
    r = rules.combine_first(left, right, ["label"]).first()
    assert (r["a"], r["b"], r["c"]) == (5.0, 2.0, 6.0)


def test_empty_tables(spark):
    e = spark.createDataFrame([], "pred_label string, density double, pred_conf double, ts timestamp_ntz")
    assert stats.class_statistics(e).count() == 0 and stats.extent(e, "ts").first()["hours"] == 0
    assert stats.histogram(e, "density").count() == 0 and stats.marker_size(e).count() == 0
