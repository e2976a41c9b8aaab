"""Ordered work over ranges against plain loops, with one key spread over many ranges."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from driftscan.operators import ranges, stats


@pytest.fixture(scope="module")
def points(spark):
    rng, rows = random.Random(2), []
    start = dt.datetime(2024, 1, 1)
    for key, n in (("hot", 3000), ("b", 40), ("c", 1), (None, 30), ("d", 200)):
        t = start
        for k in range(n):
            t += dt.timedelta(minutes=rng.choice([0, 1, 5, 10, 11, 30, 600] if k % 50 == 0 else [0, 1, 2, 10]))
            lat, lon = (None, 5.0) if k % 97 == 5 else (0.0, 0.0) if k % 89 == 7 else (50 + k / 5000, 5 + rng.random() / 100)
            rows.append((key, len(rows), t if k % 101 else None, lat, lon))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "key string, id long, ts timestamp_ntz, lat double, lon double").repartition(8), rows


def ordered(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=lambda r: (r[2] is not None, r[2] or dt.datetime.min, r[1])) for k, v in by.items()}


@pytest.fixture
def many_ranges(spark):
    """No merging of small ranges, so that keys do cross them."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_segments_as_by_a_loop(points, many_ranges):
    df, rows = points
    want = {}
    for part in ordered(rows).values():
        segment, last = 0, None
        for r in part:
            gap = (r[2] - last).total_seconds() / 60 if r[2] and last else 0.0
            segment += gap > 10
            want[r[1]] = (gap, segment)
            last = r[2]
    got = ranges.track_segments(df, "key", "ts", "id")
    assert got.columns == [*df.columns, "gap_min", "segment_id"]
    assert {r["id"]: (r["gap_min"], r["segment_id"]) for r in got.collect()} == want
    assert max(s for _, s in want.values()) > 10
    held = ranges.ranged(df, F.col("key"), F.col("ts"), F.col("id")).groupBy(ranges.RANGE).agg(F.count_if(F.col("key") == "hot").alias("n")).filter("n > 0").count()
    assert held > 8  # the hot key was spread


@pytest.mark.parametrize("most", [2, 7, 100_000])
def test_lines_as_by_a_loop(points, many_ranges, most):
    df, rows = points
    segments = ranges.track_segments(df, "key", "ts", "id")
    held = {r["id"]: r["segment_id"] for r in segments.collect()}
    want = {}
    for key, part in ordered(rows).items():
        by = {}
        for r in part:
            by.setdefault(held[r[1]], []).append(r[1])
        for segment, ids in by.items():
            for p in range(max(1, math.ceil((len(ids) - 1) / (most - 1)))):
                line = ids[p * (most - 1) : p * (most - 1) + most]
                if len(line) > 1:
                    want[key, segment, p] = line
    got = ranges.segment_lines(segments, "key", "ts", "id", most).collect()
    assert {(r["key"], r["segment_id"], r["part"]): [p["id"] for p in r["line"]] for r in got} == want
    assert all(r["n_points"] == len(r["line"]) <= most for r in got)


def test_length_as_by_a_window(points, many_ranges):
    from pyspark.sql.window import Window

    from driftscan import functions as X

    df, _ = points
    w = Window.partitionBy("key").orderBy("ts", "id")
    at = df.filter(X.not_null_island("lat", "lon")).withColumn("p", X.laea("lat", "lon"))
    want = at.select("key", F.hypot(F.col("p.x") - F.lag("p.x").over(w), F.col("p.y") - F.lag("p.y").over(w)).alias("m")).groupBy("key").agg((F.coalesce(F.sum("m"), F.lit(0.0)) / 1000).alias("km"))
    got = {r["key"]: r["km"] for r in ranges.track_length(df, "key", "ts", "id").collect()}
    assert got == pytest.approx({r["key"]: r["km"] for r in want.collect()}, rel=1e-9) and got["hot"] > 1


def test_positions(spark, points, many_ranges):
    df, rows = points
    got = ranges.positions(df, F.col("ts").desc_nulls_last(), F.col("id"))
    want = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or dt.datetime.min).timestamp() if r[2] else 0, r[1]))
    assert [r["id"] for r in got.orderBy("position").collect()] == [r[1] for r in want]
    assert sorted(r["position"] for r in got.collect()) == list(range(1, len(rows) + 1))
    assert ranges.positions(df.limit(0), F.col("id")).count() == 0


def test_empty_tables_and_clashing_names(spark):
    df = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1), 1.0, 2.0, 7)], "key string, id long, ts timestamp_ntz, lat double, lon double, gap_min int")
    r = ranges.track_segments(df.drop("gap_min"), "key", "ts", "id").first()
    assert (r["gap_min"], r["segment_id"]) == (0.0, 0)
    assert ranges.track_segments(df.drop("gap_min").limit(0), "key", "ts", "id").count() == 0
    assert ranges.track_length(df.limit(0), "key", "ts", "id").count() == 0


def test_places_within_keys_over_many_ranges(points, many_ranges):
    df, rows = points
    got = {(r["key"], r["id"]): r["place"] for r in ranges.places(df, "key", F.col("id")).collect()}
    want = {(k, r[1]): n for k, part in ordered(rows).items() for n, r in enumerate(sorted(part, key=lambda r: r[1]), 1)}
    assert got == want


def test_a_large_bucket_is_numbered_by_ranges(spark, many_ranges):
    rows = spark.range(3000).select(F.lit("300x300").alias("bucket"), "id")
    got = stats.truncate_buckets(rows, 1 << 30, "id")
    assert {r["id"]: r["z"] for r in got.collect()} == {k: k for k in range(3000)}
    assert got.schema["z"].dataType.simpleString() == "int" and got.groupBy(F.spark_partition_id()).count().count() > 8
