"""Clustering against SQL and against plain comparison of all vectors with all centroids."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from test_catalog import plain

from driftscan.llm import centroids, queries


def brute(rows, k=8, rounds=10, seed="3", size=64):
    """vec_id, cluster, distance of each kept row, and the final centroids."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), str(r[0]), r[1]))[:k]
    at = [v for _, v in first]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in at]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(at)):
            part = [v for (_, v), (o, _) in zip(kept, own, strict=True) if o == c]
            if part:
                at[c] = [sum(x) // len(part) for x in zip(*part, strict=True)]
    return [(i, c, d) for (i, _), (c, d) in zip(kept, assign(), strict=True)], at


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    got, want = queries.op11_centroids(spark, sf).toPandas(), con.execute(queries.ORACLES["op11_centroids"]).fetchdf()
    assert len(got) and plain(got) == plain(want)


@pytest.mark.parametrize("seed", range(4))
def test_balls_give_what_plain_comparison_gives(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-900, 900, (6, 8))
    x = np.concatenate([centres[rng.integers(0, 6, 3000)] + rng.integers(-40, 40, (3000, 8)), np.repeat(centres[:1], 1500, 0), rng.integers(-2, 2, (500, 8))])
    tree, order = centroids.BallTree.build(x, leaf=16)
    assert (tree.vectors == x[order]).all()
    c = np.concatenate([centres, centres[:1], centres[:2] + [[2, 0, 0, 0, 0, 0, 0, 0]]])  # equal centroids, and points halfway
    want = ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
    assert (tree.labels(c) == want[order]).all()
    count, total = tree.totals(c)
    assert (count == np.bincount(want, minlength=len(c))).all()
    assert all((total[k] == x[want == k].sum(0)).all() for k in range(len(c)))
    whole, leaves = tree.walk(centres)
    assert sum(tree.hi[b] - tree.lo[b] for b, _ in whole) > 2000  # most go as whole balls
    assert len(tree.members(leaves)) < len(x) / 2


def test_odd_vectors_ties_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(5)
    good = [(k, [float(v) for v in rng.choice([-1.5, 0.0, 0.25, 1.0], 4)]) for k in range(60)]
    rows = [*good, good[0], good[0], (None, good[1][1]), (61, None), (62, [1.0]), (63, [1.0, None, 0.0, 0.0]), (64, [float("nan"), 0.0, 0.0, 0.0]), (65, [0.0, float("inf"), 0.0, 0.0]), (66, [])]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, rows string").repartition(3)
    want, at = brute(rows, k=5, rounds=4, size=4)
    got = centroids.cluster(df, size=4, k=5, rounds=4, leaf=2).collect()
    assert sorted((str(r["row"]["vec_id"]), r["cluster"], r["distance"]) for r in got) == sorted((str(i), c, d) for i, c, d in want)
    assert {r["cluster"]: r["centroid"] for r in got} == {c: at[c] for _, c, _ in want}
    assert {r["inertia"] for r in got} == {sum(d for *_, d in want)}
    assert all(r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"]) for r in got)
    assert {(r["row"]["cluster"], r["row"]["rows"]) for r in got} == {(7, "x")}


def test_few_or_no_vectors_and_too_large_ones(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([], schema), size=2).collect() == []
    got = centroids.cluster(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.0, 0.0])], schema), size=2).collect()
    assert sorted(r["distance"] for r in got) == [0, 0] and len({r["cluster"] for r in got}) == 2
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 1.0])], schema), size=2).collect()


def test_trees_are_bounded(spark):
    rows = spark.range(1000).selectExpr("id as vec_id", "array(cast(id as double) / 1024, 0D) as embedding").coalesce(1)
    forest = centroids.trees(rows, "embedding", 2, 1024, ["vec_id"], most=128)
    sizes = [len(r["rows"]) for r in forest.select("rows").collect()]
    assert sum(sizes) == 1000 and max(sizes) == 128
