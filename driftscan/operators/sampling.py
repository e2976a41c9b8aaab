"""Deterministic sampling and limits: rows are drawn in the order of a salted md5 of their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Sizes of the tiers: more rows than the first number give the second.
TIERS = ((1000, 100), (499, 50), (99, 20), (49, 7), (9, 3))


def draw_order(key: str, seed: int | None = None) -> Column:
    text = F.col(key).cast("string")
    return F.md5((F.concat(F.lit(str(seed)), text) if seed is not None else text).cast("binary"))


def per_class(rows: DataFrame, label: str, key: str, n: int = 100, seed: int | None = None) -> DataFrame:
    """At most n rows of each class; a limit within each task comes before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(label).orderBy(draw_order(key, seed), key))
    return rows.withColumn("draw", rank).filter(F.col("draw") <= n)


def tier_size(n: Column) -> Column:
    out = F.when(n > TIERS[0][0], TIERS[0][1])
    for above, size in TIERS[1:]:
        out = out.when(n > above, size)
    return out.otherwise(0)


def tiered(rows: DataFrame, label: str, key: str, seed: int | None = None) -> DataFrame:
    """A sample of each class whose size depends on the class's own."""
    sizes = rows.groupBy(label).agg(F.count("*").alias("n_class")).withColumn("tier", tier_size(F.col("n_class")))
    return per_class(rows, label, key, TIERS[0][1], seed).join(sizes, label).filter(F.col("draw") <= F.col("tier"))


def percent(rows: DataFrame, group: str, key: str, pct: float, always: Column | None = None, seed: int | None = None) -> DataFrame:
    """floor(n * pct / 100) rows of each group, n counting the rows of `always` as well, which are kept besides."""
    fixed = F.lit(False) if always is None else always
    sizes = rows.groupBy(group).agg(F.floor(F.count("*") * (pct / 100.0)).alias("take"))
    drawn = rows.filter(~fixed).withColumn("draw", F.row_number().over(Window.partitionBy(group).orderBy(draw_order(key, seed), key)))
    kept = drawn.join(sizes, group).filter(F.col("draw") <= F.col("take")).drop("draw", "take")
    return kept if always is None else kept.unionByName(rows.filter(fixed).select(*kept.columns))


def first_n(rows: DataFrame, n: int, *order: str) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def hash_split(rows: DataFrame, key: str, train_pct: int = 80) -> DataFrame:
    """rows with `part`: train or valid, by two digits of the key's md5."""
    share = F.conv(F.substring(draw_order(key), 1, 4), 16, 10).cast("int") % 100
    return rows.withColumn("part", F.when(share < train_pct, "train").otherwise("valid"))


def file_sample(paths: list[str], most: int = 1000, seed: int = 42) -> list[str]:
    """At most `most` of the paths, drawn by a salted md5."""
    import hashlib

    return sorted(sorted(paths, key=lambda p: hashlib.md5(f"{seed}{p}".encode()).hexdigest())[:most])


def first_of_class(rows: DataFrame, label: str, path: str, most: int = 49) -> DataFrame:
    return rows.groupBy(label).agg(F.min(path).alias("first_path")).orderBy(label).limit(most)
