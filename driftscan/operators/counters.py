"""What a run has passed, rejected and failed, counted while it passes, and its errors as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from driftscan.session import materialize


def observed(rows: DataFrame, name: str, passed: Column, error: str = "error", group: str | None = None) -> tuple[DataFrame, Observation]:
    """rows, and an observation that has their counters once an action has run over them.

    Counters are passed, rejected, errors and total; a row with an error counts
    as that alone, whatever `passed` says of it, and a null `passed` as
    rejected. No pass of their own is made. With a group, the number of its
    distinct values is counted as well (approximately).
    """
    failed = F.col(error).isNotNull() if error in rows.columns else F.lit(False)
    good = F.coalesce(passed, F.lit(False))
    counters = [F.count_if(~failed & good).alias("passed"), F.count_if(~failed & ~good).alias("rejected"), F.count_if(failed).alias("errors"), F.count(F.lit(1)).alias("total")]
    if group:
        counters.append(F.approx_count_distinct(group).alias("groups"))
    seen = Observation(name)
    return rows.observe(seen, *counters), seen


def counts(rows: DataFrame, passed: Column, *keys: str, error: str = "error") -> DataFrame:
    """The same counters as a table, by keys."""
    failed = F.col(error).isNotNull() if error in rows.columns else F.lit(False)
    good = F.coalesce(passed, F.lit(False))
    return rows.groupBy(*keys).agg(F.count_if(~failed & good).alias("passed"), F.count_if(~failed & ~good).alias("rejected"), F.count_if(failed).alias("errors"), F.count(F.lit(1)).alias("total"))


def separate_errors(rows: DataFrame, path: str, stage: str, name: str, passed: Column | None = None, error: str = "error") -> tuple[DataFrame, dict[str, int]]:
    """The rows without an error, and the counters; those with one are added to the error table at path.

    rows are computed once, into a written table. The error table has stage, the
    columns that tell which row it was (all but binary ones, as JSON), and error;
    several stages and runs may add to one.
    """
    seen_rows, seen = observed(rows, name, F.lit(True) if passed is None else passed, error)
    held = materialize(seen_rows, stage)
    plain = [c for c, t in rows.dtypes if t != "binary" and c != error]
    bad = held.filter(F.col(error).isNotNull()).select(F.lit(stage).alias("stage"), F.to_json(F.struct(*plain)).alias("row"), F.col(error).alias("error"))
    bad.write.mode("append").parquet(path)
    good = held.filter(F.col(error).isNull()).drop(error)
    return (good if passed is None else good.filter(F.coalesce(passed, F.lit(False)))), dict(seen.get)


def error_table(spark, path: str) -> DataFrame:
    return spark.read.schema("stage string, row string, error string").parquet(path)
