"""Report files, paths and names, prediction headers."""

import json

import numpy as np
from pyspark.sql import functions as F

from driftscan import functions as X
from driftscan.imaging import regions
from driftscan.operators import curation
from driftscan.sinks import tables
from driftscan.sources import predictions


def test_paths_and_names(spark):
    rows = ["C:\\\\data\\\\x".replace("\\\\", "\\"), "/mnt/c/data/x", "rel\\a", "/x/y", None]
    got = spark.createDataFrame([(r,) for r in rows], "p string").select(X.portable_path("p").alias("a"), X.drive_path("p").alias("b")).collect()
    assert [r["a"] for r in got] == ["/mnt/c/data/x", "/mnt/c/data/x", "rel/a", "/x/y", None]
    assert [r["b"] for r in got][1] == "C:\\data\\x" and got[3]["b"] == "/x/y"
    r = spark.range(1).select(X.strip_affixes(F.lit("preds_resnet.csv"), "preds_", ".csv").alias("n"), X.strip_affixes(F.lit("other"), "preds_", ".csv").alias("m"), X.thousands(F.lit(1234567.891), 2).alias("t")).first()
    assert tuple(r) == ("resnet", "other", "1,234,567.89")


def test_report_files(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 50.5, -4.0), ("b", None, None, 1.0)], "name string, n int, lat double, lon double")
    tables.write_json(df, str(tmp_path / "j"))
    assert sorted(json.loads(r["value"])["name"] for r in spark.read.text(str(tmp_path / "j")).collect()) == ["a", "b"]
    path = tables.write_metrics(df, str(tmp_path), "resnet", "test")
    assert path.endswith("resnet_test.csv") and spark.read.option("header", "true").csv(path).count() == 2
    tables.write_points(df, str(tmp_path / "g"))
    f = json.loads(spark.read.text(str(tmp_path / "g")).first()["value"])
    assert f["geometry"] == {"type": "Point", "coordinates": [-4.0, 50.5]} and f["properties"] == {"name": "a", "n": 1}


def test_quoted_headers(spark, tmp_path):
    (tmp_path / "one.csv").write_text('id,"a,b_conf",date,time\nx,inf,2024-01-02,14:50\n')
    r = predictions.read_detail(spark, [str(tmp_path / "one.csv")]).first()
    assert (r["id"], r["a,b_conf"], r["date"], r["time"]) == ("x", float("inf"), "2024-01-02", "14:50")


def test_files_without_a_folder(spark):
    got = {r["folder"]: r["n_files"] for r in curation.files_per_folder(spark.createDataFrame([("x.tif",), ("a/x.tif",), ("a\\y.tif",)], "path string")).collect()}
    assert got == {None: 1, "a": 2}


def test_small_objects_that_touch_at_a_corner_are_small():
    mask = np.zeros((20, 20), bool)
    mask[2:8, 2:9] = mask[8:14, 9:16] = True
    assert regions.components(mask, eight=False).max() == 2 and regions.components(mask).max() == 1


def test_lines_and_digits(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, [(50.5, -4.0, 1), (None, 1.0, 2), (51.0, -4.5, 3)]), ("b", 1, [(50.0, 1.0, 1)]), ("c", 2, [])], "key string, segment_id int, line array<struct<lat:double,lon:double,id:int>>")
    tables.write_lines(df, str(tmp_path / "l"))
    f = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "l")).collect()]
    assert len(f) == 1 and f[0]["geometry"] == {"type": "LineString", "coordinates": [[-4.0, 50.5], [-4.5, 51.0]]} and f[0]["properties"] == {"key": "a", "segment_id": 0}
    tables.write_csv(spark.createDataFrame([(1, 2.0, None), (2, 0.12345678949, 1.5)], "n int, `a.b` double, c float"), str(tmp_path / "d"), 9)
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "d")).distinct().collect()) == ["1,2.000000000,", "2,0.123456789,1.500000000", "n,a.b,c"]


def test_lists_of_images(spark):
    df = spark.createDataFrame([("t1", k, f"{k}.tif", "300x300", 5, 6, 1 + 2 * (k % 2), "uint8", "bad" if k == 3 else None) for k in range(14)], "tar_path string, member_idx int, filename string, bucket string, height int, width int, channels int, dtype string, error string")
    assert [tuple(r) for r in curation.corrupt_list(df).collect()] == [("t1", "3.tif", "bad")]
    rows = {r["index"]: r for r in curation.record_table(df).collect()}
    assert list(rows[0]["shape"]) == [5, 6] and list(rows[1]["shape"]) == [5, 6, 3] and rows[13]["filename"] == "13.tif"
    assert [list(r["names"]) for r in curation.first_names(df.withColumnRenamed("filename", "name")).collect()] == [[f"{k}.tif" for k in range(10)]]


def test_coverage_by_the_unit_that_suits(spark):
    from driftscan.operators import stats

    for days, unit in ((3, "hour"), (60, "day"), (200, "week")):
        df = spark.createDataFrame([("2024-01-01 10:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts")).unionByName(spark.range(1).select((F.lit("2024-01-01 10:00:00").cast("timestamp_ntz") + F.expr(f"INTERVAL '{days}' DAY")).alias("ts")))
        got, rows = stats.survey_coverage(df, "ts")
        assert got == unit and rows.agg(F.sum("count")).first()[0] == 2
    assert stats.survey_coverage(df.limit(0), "ts")[0] == "hour"
