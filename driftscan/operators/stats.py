"""Class statistics, bins, coverage, tracks and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftscan import functions as X
from driftscan.operators.ranges import places, segment_lines, track_length, track_segments  # noqa: F401  of this module by name

#: Up to so many images of a bucket are numbered in one task, after each task has dropped what lies beyond.
LARGEST_WINDOW = 10_000


def class_statistics(images: DataFrame, label: str = "pred_label", density: str = "density", conf: str = "pred_conf") -> DataFrame:
    """Images, share, and least, mean and greatest density and confidence (per cent) of each class; a null class is one of its own."""
    per = images.groupBy(F.col(label).alias("pred_label")).agg(
        F.count("*").alias("n_images"),
        *(f(F.col(c) * k).alias(f"{n}_{out}") for c, out, k in ((density, "density", 1), (conf, "confidence", 100)) for n, f in (("min", F.min), ("mean", F.avg), ("max", F.max))),
    )
    total = per.agg(F.sum("n_images").alias("total"))
    return per.join(F.broadcast(total)).withColumn("pct", F.col("n_images") * 100.0 / F.col("total")).drop("total")


def bin_summary(images: DataFrame, ts: str, label: str, means: list[str], every: str = "10 minutes") -> DataFrame:
    """Counts (as doubles) and means per bin and label; rows without a time drop out."""
    return images.groupBy(F.window(ts, every).alias("w"), F.col(label).alias("pred_label")).agg(F.count("*").cast("double").alias("total_counts"), *(F.avg(X.nan_to_null(m)).alias(f"mean_{m}") for m in means)).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "pred_label", "total_counts", *(f"mean_{m}" for m in means))


def hits_and_misses(lines: DataFrame, *keys: str) -> DataFrame:
    """Totals of side-car lines and the subsample factor of each key; an empty side-car counts as missing."""
    return lines.groupBy(*keys).agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses")).withColumn("subsample_factor", X.subsample_factor("hits", "misses"))


def add_density(summary: DataFrame, factors: DataFrame, keys: list[str], volume: float = 340.0) -> DataFrame:
    """Density of each summary row from its key's factor; keys without a factor have factor and density 0."""
    joined = summary.join(factors.select(*keys, "subsample_factor"), keys, "left")
    return joined.withColumn("density", X.density("total_counts", "subsample_factor", volume)).withColumn("subsample_factor", F.coalesce("subsample_factor", F.lit(0.0)))


def attach_summary(detail: DataFrame, summary: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return detail.join(summary.select(*keys, *values), keys, "left")


def bin_first_values(rows: DataFrame, ts: str, order: str, means: list[str], firsts: list[str], every: str = "10 minutes") -> DataFrame:
    """Per bin the means, and of other columns the value of the row least in order."""
    return rows.groupBy(F.window(ts, every).alias("w")).agg(*(F.avg(m).alias(f"mean_{m}") for m in means), *(F.min_by(c, order).alias(f"first_{c}") for c in firsts)).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *(f"mean_{m}" for m in means), *(f"first_{c}" for c in firsts))


def coverage(rows: DataFrame, ts: str, unit: str) -> DataFrame:
    """Rows per hour, day, or week (named by its closing Monday) over the whole span, 0 where there are none.

    The axis starts at a whole unit. For weeks, coverage is the share of the 1008
    ten-minute bins that hold a row. Only two numbers and the axis are made apart.
    """
    u = X.unit_start(ts, unit)
    counts = rows.filter(F.col(ts).isNotNull()).groupBy(u.alias("unit_start")).agg(F.count("*").alias("n"), F.count_distinct(F.floor(F.unix_seconds(F.col(ts).cast("timestamp_ltz")) / 600)).alias("bins"))
    step = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY"}[unit]
    axis = counts.agg(F.min("unit_start").alias("lo"), F.max("unit_start").alias("hi")).filter("lo is not null").select(F.explode(F.sequence("lo", "hi", F.expr(step))).alias("unit_start"))
    out = axis.join(counts, "unit_start", "left").select("unit_start", F.coalesce("n", F.lit(0)).alias("count"), F.coalesce("bins", F.lit(0)).alias("bins"))
    return out.withColumn("coverage", F.col("bins") / 1008.0) if unit == "week" else out.drop("bins")


def choose_unit(days: float) -> str:
    return "hour" if days <= 30 else "day" if days <= 90 else "week"


def survey_coverage(rows: DataFrame, ts: str) -> tuple[str, DataFrame]:
    """The unit that suits the rows' span, and their coverage by it. Rows without a time count for neither."""
    span = rows.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    unit = choose_unit((span["hi"] - span["lo"]).total_seconds() / 86400 if span["lo"] else 0.0)
    return unit, coverage(rows, ts, unit)


def unit_of(days) -> Column:
    """The unit in which a span of days is shown, as a column."""
    return F.when(days <= 30, "hour").when(days <= 90, "day").otherwise("week")


def day_grid(rows: DataFrame, ts: str, value: str, *by: str) -> DataFrame:
    """Mean value of each of a day's 144 ten-minute slots, for each day (of each class in `by`) with rows; 0 where there are none."""
    slot = rows.filter(F.col(ts).isNotNull()).select(*by, F.col(ts).cast("date").alias("day"), X.bin_start(ts).alias("slot"), F.col(value).alias("v"))
    means = slot.groupBy(*by, "day", "slot").agg(F.avg("v").alias("v"))
    grid = means.select(*by, "day").distinct().select(*by, "day", F.explode(F.sequence(F.col("day").cast("timestamp_ntz"), F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL '23:50' HOUR TO MINUTE"), F.expr("INTERVAL 10 MINUTE"))).alias("slot"))
    return grid.join(means, [*by, "day", "slot"], "left").select(*by, "day", "slot", F.coalesce("v", F.lit(0.0)).alias("value"))


def extent(rows: DataFrame, ts: str) -> DataFrame:
    r = rows.agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n_rows"))
    return r.withColumn("hours", X.hours_between("start", "end"))


def track_bounds(points: DataFrame) -> DataFrame:
    """Bounds in degrees."""
    return points.filter(X.not_null_island("lat", "lon")).agg(F.min("lon").alias("min_lon"), F.min("lat").alias("min_lat"), F.max("lon").alias("max_lon"), F.max("lat").alias("max_lat"))


def assign_buckets(images: DataFrame, grid: int = 300, mode: str = "ceil", on_oversize: str = "keep") -> DataFrame:
    """images (height, width) with bucket_h, bucket_w and bucket; on_oversize error fails on a bucket smaller than its image, crop cuts."""
    out = images.withColumn("bucket_h", X.snap("height", grid, mode)).withColumn("bucket_w", X.snap("width", grid, mode))
    if on_oversize == "error":
        large = (F.col("bucket_h") < F.col("height")) | (F.col("bucket_w") < F.col("width"))
        out = out.withColumn("bucket_h", F.when(large, F.raise_error(F.lit("image larger than its bucket")).cast("int")).otherwise(F.col("bucket_h")))
    return out.withColumn("bucket", X.bucket_name("bucket_h", "bucket_w"))


def bucket_stats(images: DataFrame) -> DataFrame:
    return images.groupBy("bucket").agg(F.count("*").alias("count"), F.min("height").alias("min_h"), F.max("height").alias("max_h"), F.min("width").alias("min_w"), F.max("width").alias("max_w"), F.array_sort(F.collect_set("dtype")).alias("dtypes"), F.array_sort(F.collect_set("channels")).alias("channels"))


def keep_large_buckets(images: DataFrame, least: int) -> DataFrame:
    """Images of buckets with at least `least` of them; counts are joined, so that no bucket meets in one task."""
    big = images.groupBy("bucket").count().filter(F.col("count") >= least).select("bucket")
    return images.join(big, "bucket", "left_semi")


def truncate_buckets(images: DataFrame, most: int, *order: str) -> DataFrame:
    """The first `most` images of each bucket in arrival order, numbered from 0.

    Where most is small, tasks drop what lies beyond before the shuffle; else
    images are numbered by ranges, as one bucket may hold nearly all of them.
    """
    if most <= LARGEST_WINDOW:
        placed = images.withColumn("z", F.row_number().over(Window.partitionBy("bucket").orderBy(*order)))
    else:
        placed = places(images, "bucket", *map(F.col, order), name="z")
    return placed.filter(F.col("z") <= most).withColumn("z", (F.col("z") - 1).cast("int"))


def promote(images: DataFrame) -> DataFrame:
    """dtype and channels that hold all images of a bucket: the widest (ties by name), and the most."""
    width = F.coalesce(F.regexp_extract("dtype", r"(\d+)$", 1).cast("int"), F.lit(8))
    return images.groupBy("bucket").agg(F.max(F.struct(width.alias("bits"), F.col("dtype").alias("dtype"))).getField("dtype").alias("dtype"), F.max("channels").alias("channels"))


def marker_size(rows: DataFrame, density: str = "density") -> DataFrame:
    top = rows.agg(F.max(density).alias("top"))
    scaled = F.when(F.col("top") > 0, 20 + 120 * F.col(density) / F.nullif(F.col("top"), F.lit(0.0))).otherwise(F.lit(20.0))
    return rows.join(F.broadcast(top)).withColumn("marker_size", scaled).drop("top")


def unpivot_confidences(rows: DataFrame, keys: list[str], probs: str, names: list[str]) -> DataFrame:
    """Long form: one row for each class of each row's probabilities."""
    labels = F.array(*map(F.lit, names))
    return rows.select(*keys, F.posexplode(F.arrays_zip(labels.alias("class"), F.col(probs).alias("conf")))).select(*keys, F.col("pos").alias("class_id"), F.col("col")["class"].alias("class"), F.col("col")["conf"].alias("conf"))


def related_classes(rows: DataFrame, label_id: str, probs: str, names: list[str], k: int = 5) -> DataFrame:
    """For each class the k others with the highest mean confidence."""
    long = unpivot_confidences(rows, [label_id], probs, names).filter(F.col("class_id") != F.col(label_id))
    mean = long.groupBy(label_id, "class").agg(F.avg(X.nan_to_null("conf")).alias("mean_conf"))
    return mean.withColumn("rank", F.row_number().over(Window.partitionBy(label_id).orderBy(F.desc("mean_conf"), "class"))).filter(F.col("rank") <= k)


def threshold_share(rows: DataFrame, value: Column, threshold: float) -> DataFrame:
    return rows.agg(F.count_if(value > threshold).alias("above"), F.count("*").alias("n")).withColumn("pct", F.col("above") * 100.0 / F.nullif(F.col("n"), F.lit(0)))


def histogram(rows: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Counts of equal bins over the value's own range; the maximum is in the last."""
    ends = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins), F.floor((F.col(value) - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))) + 1)).otherwise(F.lit(1))
    return rows.filter(F.col(value).isNotNull()).join(F.broadcast(ends)).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("count"))


def every_kth(rows: DataFrame, key: str, order: list, k: int) -> DataFrame:
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter((F.col("__n") - 1) % k == 0).drop("__n")


def pivot_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("count"))
