"""Golden vectors of the column functions."""

import math

import pytest
from pyspark.sql import functions as F

from driftscan import functions as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("v", "mode", "want"), [(480, "ceil", 600), (640, "ceil", 900), (300, "ceil", 300), (1, "ceil", 300), (601, "ceil", 900), (299, "floor", 300), (899, "floor", 600), (450, "round", 600), (750, "round", 600), (150, "round", 300), (457, "exact", 457)])
def test_snap(spark, v, mode, want):
    assert value(spark, X.snap(F.lit(v), 300, mode)) == want


def test_names(spark):
    assert value(spark, X.timestamp_token(F.lit("/a/A_B_1450.tar"))) == "1450"
    assert value(spark, X.timestamp_token(F.lit("1450.tar"))) == "1450"
    assert value(spark, X.floor_bin(F.lit("1234"))) == "1230"
    assert value(spark, X.basename(F.lit("RawImages\\x.y.tif"))) == "x.y.tif"
    assert value(spark, X.sanitise(F.lit("..a b/c"))) == "a_b_c"
    assert value(spark, X.compression_label(F.lit("blosc_zstd"), F.lit(5), F.lit("bitshuffle"))) == "blosc_zstd_clevel5_bitshuffle"
    o = value(spark, X.origin(F.lit("/d/2023-06-15/run_1230.tar")))
    assert (o["date"], o["timestamp"]) == ("2023-06-15", "1230")
    assert value(spark, X.origin(F.lit("x"))["date"]) == "1970-01-01"
    assert value(spark, X.parse_bucket(F.lit("600x900"))["width"]) == 900
    assert value(spark, X.parse_bucket(F.lit("bad"))["width"]) is None


def test_density(spark):
    assert value(spark, X.subsample_factor(F.lit(900), F.lit(100))) == pytest.approx(0.9)
    assert value(spark, X.subsample_factor(F.lit(0), F.lit(0))) == 0
    assert value(spark, X.density(F.lit(170), F.lit(0.9))) == pytest.approx(0.5555555556)
    assert value(spark, X.density(F.lit(170), F.lit(0.0))) == math.inf
    assert value(spark, X.density(F.lit(170), F.lit(None).cast("double"))) == 0


def test_place(spark):
    assert value(spark, X.dms(F.lit(52), F.lit(30), F.lit(36), F.lit("N"))) == pytest.approx(52.51)
    assert value(spark, X.dms(F.lit(4), F.lit(15), F.lit(0), F.lit("W"))) == pytest.approx(-4.25)
    p = value(spark, X.laea(F.lit(50.0), F.lit(5.0)))
    assert (p["x"], p["y"]) == (pytest.approx(3962799.4510, abs=1e-3), pytest.approx(2999718.8532, abs=1e-3))


def test_classes(spark):
    assert value(spark, X.argmax(F.array(*map(F.lit, (0.4, 0.4, 0.2))))) == 0
    assert value(spark, X.finite_or_zero(F.lit(float("nan")))) == 0
    assert value(spark, X.optical_density(F.lit(10.0), F.lit(100.0))) == pytest.approx(1.0, abs=1e-8)
    assert value(spark, X.optical_density(F.lit(200.0), F.lit(100.0))) == 0


def test_pyramid(spark):
    got = [value(spark, X.pyramid_scale(F.lit(0.36), 2, F.lit(k))) for k in (1, 2)] + [value(spark, X.pyramid_translation(F.lit(0.36), 2, F.lit(k))) for k in (1, 2)]
    assert got == pytest.approx([0.72, 1.44, 0.18, 0.54])
    assert value(spark, X.chunk_count(F.lit(5), F.lit(600), F.lit(900), 300)) == 30
    assert value(spark, X.combine_datetime(F.lit("2024-01-01"), F.lit("00:00"))).isoformat() == "2024-01-01T00:00:00"
    assert value(spark, X.combine_datetime(F.lit("2024-01-01"), F.lit("x"))) is None
    days = {"2024-01-08 15:00:00": "2024-01-08", "2024-01-09 00:00:00": "2024-01-15"}
    for day, want in days.items():
        assert str(value(spark, X.unit_start(F.lit(day).cast("timestamp_ntz"), "week")).date()) == want
