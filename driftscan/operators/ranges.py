"""Ordered work over ranges: positions, gaps, segments and lengths along an order, with one key spread over all tasks.

Rows are dealt by ranges of their order and written once, so that range k stands
wholly before range k + 1. Each range is worked on alone; what the next one
needs of it (last row, counts) goes through a table of at most one row a range,
which is why that table may be broadcast. A range grows beyond its share only by
rows that are equal in the whole order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftscan import functions as X
from driftscan.session import materialize

RANGE = "__range"


def ranged(rows: DataFrame, *order: Column) -> DataFrame:
    """rows and the number of their range by order, as a written table."""
    return materialize(rows.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), "ranged")


def positions(rows: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """rows with their place in the order, from 1. Rows equal in the order are numbered in any way; an empty table has none."""
    dealt = ranged(rows, *order)
    sizes = sorted((r[RANGE], r["count"]) for r in dealt.groupBy(RANGE).count().collect())  # a row a task
    before, total = [], 0
    for k, n in sizes:
        before.append((k, total))
        total += n
    starts = rows.sparkSession.createDataFrame(before, f"{RANGE} int, __before bigint")
    within = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    numbered = dealt.withColumn(name, within.cast("bigint")).join(F.broadcast(starts), RANGE)
    return numbered.withColumn(name, F.col(name) + F.col("__before")).select(*rows.columns, name)


def places(rows: DataFrame, key: str, *order: Column, name: str = "place") -> DataFrame:
    """rows with their place within their key in the order, from 1; a null key is one of its own. One key may fill many ranges."""
    dealt = ranged(rows, F.col(key), *order)
    by_range = Window.partitionBy(key).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(RANGE, key).count()  # at most a row for each key of a range
    starts = sizes.select(F.col(RANGE).alias("__r"), F.col(key).alias("__k"), F.coalesce(F.sum("count").over(by_range), F.lit(0)).alias("__before")).filter("__before > 0")
    within = F.row_number().over(Window.partitionBy(RANGE, key).orderBy(*order))
    numbered = dealt.withColumn(name, within.cast("bigint")).join(F.broadcast(starts), (F.col(RANGE) == F.col("__r")) & F.col(key).eqNullSafe(F.col("__k")), "left")
    return numbered.withColumn(name, F.col(name) + F.coalesce("__before", F.lit(0))).select(*rows.columns, name)


def _steps(points: DataFrame, key: str, ts: str, order: str, last: Column, flag: Column | None = None) -> DataFrame:
    """points in ranges of (key, ts, order) with __last, what `last` was at the row before of the same key, in whatever range that was.

    With flag (a condition on __last and the row), __flags counts the key's rows
    up to this one that meet it.
    """
    own = Window.partitionBy(RANGE, key).orderBy(ts, order)
    dealt = ranged(points.withColumn("__value", last), F.col(key), F.col(ts), F.col(order))
    within = dealt.withColumn("__first", F.row_number().over(own) == 1).withColumn("__last", F.lag("__value").over(own))
    hit = F.lit(0) if flag is None else F.coalesce(flag, F.lit(False)).cast("bigint")
    at_edge = F.struct(ts, order, "__value")
    inner = within.withColumn("__hit", F.when(F.col("__first"), F.lit(0)).otherwise(hit))
    # the keys of a range, with its first and last row of each
    edges = inner.groupBy(RANGE, key).agg(F.max_by(at_edge, F.struct(ts, order)).getField("__value").alias("__end"), F.min_by(F.struct(*points.columns, "__value"), F.struct(ts, order)).alias("__head"), F.sum("__hit").alias("__inside"))
    by_range = Window.partitionBy(key).orderBy(RANGE)
    handed = edges.withColumn("__carried", F.lag("__end").over(by_range)).withColumn("__more", F.row_number().over(by_range) > 1)
    crossing = handed.select(RANGE, key, "__more", "__inside", F.col("__carried").alias("__last"), *(F.col("__head")[c].alias(c) for c in points.columns if c != key)).withColumn("__cross", F.when(F.col("__more"), hit).otherwise(F.lit(0)))
    earlier = F.sum(F.col("__inside") + F.col("__cross")).over(by_range.rowsBetween(Window.unboundedPreceding, -1))
    carry = crossing.withColumn("__before", F.coalesce(earlier, F.lit(0)) + F.col("__cross")).filter("__more").select(F.col(RANGE).alias("__r"), F.col(key).alias("__k"), F.col("__last").alias("__carried"), "__before")
    # only the first key of a range can have begun in an earlier one
    joined = inner.join(F.broadcast(carry), (F.col(RANGE) == F.col("__r")) & F.col(key).eqNullSafe(F.col("__k")), "left")
    flags = F.sum("__hit").over(own.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("__before", F.lit(0))
    return joined.withColumn("__last", F.when(F.col("__first"), F.col("__carried")).otherwise(F.col("__last"))).withColumn("__flags", flags)


def track_segments(points: DataFrame, key: str, ts: str, order: str, gap_minutes: float = 10.0) -> DataFrame:
    """points with gap_min and segment_id: a gap of more than gap_minutes starts a new segment of its key.

    Points without a time stand before the others of their key and have no gap;
    a null key is one of its own. order must tell points of one time apart.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp_ltz"))
    gap = F.coalesce((F.unix_micros(F.col(ts).cast("timestamp_ltz")) - F.col("__last")) / 60_000_000.0, F.lit(0.0))
    out = _steps(points, key, ts, order, micros, gap > gap_minutes)
    return out.select(*points.columns, gap.alias("gap_min"), F.col("__flags").alias("segment_id"))


def segment_lines(segments: DataFrame, key: str, ts: str, order: str, most_points: int = 100_000) -> DataFrame:
    """key, segment_id, part, n_points and line, the points (ts, order, lon, lat) in order of every segment of two points or more.

    A line of more than most_points is handed out in parts; a part begins with
    the last point of the one before, so that no row is unbounded and no step
    lost. Parts are numbered from 0.
    """
    own = segments.withColumn("__track", F.struct(F.col(key), F.col("segment_id")))
    number = _steps(own, "__track", ts, order, F.lit(1), F.lit(True))  # flags count the rows after the first
    at = F.col("__flags")
    step = most_points - 1
    part = F.floor(at / step).cast("bigint")
    # a point where two parts meet belongs to both
    parts = F.when((at > 0) & (at % step == 0), F.array(part - 1, part)).otherwise(F.array(part))
    rows = number.select(F.col(key), "segment_id", F.explode(parts).alias("part"), F.struct(ts, order, "lon", "lat").alias("point"))
    lines = rows.groupBy(key, "segment_id", "part").agg(F.array_sort(F.collect_list("point")).alias("line"))
    return lines.filter(F.size("line") > 1).select(key, "segment_id", "part", F.size("line").alias("n_points"), "line")


def track_length(points: DataFrame, key: str, ts: str, order: str) -> DataFrame:
    """Kilometres along each key's points in projected metres, (0, 0) and null places left out."""
    at = points.filter(X.not_null_island("lat", "lon")).select(key, ts, order, X.laea("lat", "lon").alias("p"))
    steps = _steps(at, key, ts, order, F.col("p"))
    metres = F.hypot(F.col("p.x") - F.col("__last.x"), F.col("p.y") - F.col("__last.y"))
    return steps.groupBy(key).agg((F.coalesce(F.sum(metres), F.lit(0.0)) / 1000.0).alias("km"))
