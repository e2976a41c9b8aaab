"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftscan.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node of its neighbourhood, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.withColumnRenamed("m", "v")).filter("u <> v").distinct()


def connected_components(edges: DataFrame, src: str, dst: str, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node it reaches) for every node with an edge to another.

    Ids are longs; rows with a null end and loops are ignored. Each round is
    written to the shared folder; rounds grow as the logarithm of the longest
    path. Reaching most_rounds raises rather than give a wrong answer.
    """
    now = materialize(edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter("u <> v").distinct(), "edges")
    for _ in range(most_rounds):
        twice = now.groupBy("u").count().filter("count > 1").select("u")
        inner = now.join(now.select(F.col("u").alias("v")), "v", "left_semi").select("u")
        if twice.unionByName(inner).isEmpty():  # every node hangs on one root, which hangs on none
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        now = materialize(_small_star(_large_star(now)), "edges")
    raise RuntimeError(f"components not settled after {most_rounds} rounds")
