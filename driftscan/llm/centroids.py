"""Centroid clustering of integer vectors, filtered by ball trees.

Each partition's vectors are put into metric trees of bounded size, once: a ball
has a pivot, the radius around it, the number and the integer sum of its
vectors. A round walks the trees with the centroids. Those that the triangle
inequality excludes for a whole ball are left out below it; a ball with one left
goes to it with its count and sum, and only leaves with several are compared
vector by vector, in exact integers. The trees are a written table that every
round reads again; a round gives the driver one row for each centroid and
component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftscan.session import materialize, ship

#: Squared distances of vectors within this size fit into 64 bits for up to 64 components; larger ones are an error.
MOST = 1 << 27
_TREE = {"vectors": T.BinaryType(), "lo": T.ArrayType(T.IntegerType()), "hi": T.ArrayType(T.IntegerType()), "child": T.ArrayType(T.IntegerType()), "radius": T.ArrayType(T.DoubleType()), "pivots": T.BinaryType(), "sums": T.BinaryType()}


class BallTree:
    """Arrays of balls over vectors in tree order: ball 0 holds all, child is the first of two that stand together or -1 for a leaf."""

    def __init__(self, vectors: np.ndarray, lo, hi, child, radius, pivots: np.ndarray, sums: np.ndarray):
        self.vectors, self.pivots, self.sums = vectors, pivots, sums
        self.lo, self.hi, self.child, self.radius = np.asarray(lo), np.asarray(hi), np.asarray(child), np.asarray(radius)

    @classmethod
    def build(cls, vectors: np.ndarray, leaf: int = 32) -> tuple[BallTree, np.ndarray]:
        """The tree, and where each of its vectors stood."""
        order, at = np.arange(len(vectors)), vectors.astype(np.float64)
        lo, hi, child, radius, pivots = [0], [len(vectors)], [], [], []
        while len(child) < len(lo):
            k = len(child)
            own = order[lo[k] : hi[k]]
            part = at[own]
            pivot = part.mean(0)
            away = np.sqrt(((part - pivot) ** 2).sum(1))
            pivots.append(pivot)
            radius.append(float(away.max()) * (1 + 1e-9))
            if len(own) <= leaf or radius[-1] == 0:
                child.append(-1)
                continue
            far = part[away.argmax()]
            other = part[((part - far) ** 2).sum(1).argmax()]
            half = len(own) // 2
            order[lo[k] : hi[k]] = own[np.argpartition(part @ (other - far), half)]
            child.append(len(lo))
            lo += [lo[k], lo[k] + half]
            hi += [lo[k] + half, hi[k]]
        vectors = vectors[order]
        before = np.concatenate([np.zeros((1, vectors.shape[1]), np.int64), np.cumsum(vectors, 0)])
        return cls(vectors, lo, hi, child, radius, np.array(pivots), before[hi] - before[lo]), order

    def walk(self, centroids: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Balls with the centroid to which they go whole, and the leaves that have to be compared."""
        balls, open_ = np.zeros(1, np.int64), np.ones((1, len(centroids)), bool)
        whole: list[tuple[int, int]] = []
        exact = []
        points = centroids.astype(np.float64)
        while len(balls):
            away = np.sqrt(((self.pivots[balls][:, None, :] - points[None]) ** 2).sum(2))
            radius = self.radius[balls][:, None]
            slack = 1e-10 * (away.max(1, keepdims=True) + radius) + 1e-9  # for the rounding of these distances
            nearest = np.where(open_, away, np.inf).min(1, keepdims=True)
            open_ &= away - radius <= nearest + radius + slack
            one, leaf = open_.sum(1) == 1, self.child[balls] < 0
            whole += zip(balls[one].tolist(), open_[one].argmax(1).tolist(), strict=True)
            exact.append(balls[leaf & ~one])
            down = ~leaf & ~one
            first = self.child[balls[down]]
            balls, open_ = np.concatenate([first, first + 1]), np.concatenate([open_[down], open_[down]])
        return whole, np.concatenate(exact)

    def labels(self, centroids: np.ndarray) -> np.ndarray:
        """The nearest centroid of every vector, of equally near ones the first."""
        out = np.empty(len(self.vectors), np.int64)
        whole, leaves = self.walk(centroids)
        for ball, k in whole:
            out[self.lo[ball] : self.hi[ball]] = k
        at = self.members(leaves)
        out[at] = nearest(self.vectors[at], centroids)
        return out

    def totals(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and sum of the vectors of each centroid."""
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        whole, leaves = self.walk(centroids)
        for ball, k in whole:
            count[k] += self.hi[ball] - self.lo[ball]
            total[k] += self.sums[ball]
        at = self.members(leaves)
        own = nearest(self.vectors[at], centroids)
        count += np.bincount(own, minlength=len(centroids))
        np.add.at(total, own, self.vectors[at])
        return count, total

    def members(self, leaves: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(self.lo[b], self.hi[b]) for b in leaves] or [np.zeros(0, np.int64)])


def distances(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    return ((vectors - centroid) ** 2).sum(1)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.stack([distances(vectors, c) for c in centroids]).argmin(0) if len(vectors) else np.zeros(0, np.int64)


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has this many components, none of them null, infinite or not a number."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == size) & finite, F.lit(False))


def whole_numbers(flat: np.ndarray, scale: int) -> np.ndarray:
    out = np.floor(flat.astype(np.float64) * scale)
    if len(out) and np.abs(out).max() > MOST:
        raise ValueError(f"a component times {scale} is beyond {MOST}")
    return out.astype(np.int64)


def trees(rows: DataFrame, vector: str, size: int, scale: int, keep: list[str] | None = None, leaf: int = 32, most: int = 4096) -> DataFrame:
    """Ball trees over each partition's vectors, at most `most` of them each, and rows, the columns keep (or all) in the tree's order."""
    ship(rows.sparkSession)
    row = F.struct(*(F.col(f"`{c}`") for c in (rows.columns if keep is None else keep)))
    given = rows.select(row.alias("row"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    given = given.filter(usable(F.col("v"), size))
    schema = T.StructType([T.StructField("rows", T.ArrayType(given.schema["row"].dataType)), *(T.StructField(n, t) for n, t in _TREE.items())])

    def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        tree, order = BallTree.build(whole_numbers(batch.column(1).flatten().to_numpy(), scale).reshape(n, size), leaf)
        own = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(0).take(pa.array(order)))
        lists = [pa.array([x.tolist()], pa.list_(t)) for x, t in ((tree.lo, pa.int32()), (tree.hi, pa.int32()), (tree.child, pa.int32()), (tree.radius, pa.float64()))]
        return pa.RecordBatch.from_arrays([own, pa.array([tree.vectors.astype("<i4").tobytes()]), *lists, pa.array([tree.pivots.astype("<f8").tobytes()]), pa.array([tree.sums.astype("<i8").tobytes()])], ["rows", *_TREE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            while n >= most:
                table = pa.Table.from_batches(held).combine_chunks()
                yield packed(table.slice(0, most).to_batches()[0])
                held, n = table.slice(most).to_batches(), n - most
        if n:
            yield packed(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return given.mapInArrow(run, schema)


def _tree(batch: pa.RecordBatch, k: int, size: int) -> BallTree:
    at = {n: batch.column(n)[k] for n in _TREE}
    vectors = np.frombuffer(at["vectors"].as_py(), "<i4").astype(np.int64).reshape(-1, size)
    shaped = [np.frombuffer(at[n].as_py(), t).reshape(-1, size) for n, t in (("pivots", "<f8"), ("sums", "<i8"))]
    return BallTree(vectors, *(at[n].values.to_numpy() for n in ("lo", "hi", "child", "radius")), *shaped)


def moved(forest: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floors of the means, or where they were if nothing is theirs."""
    at = np.array(centroids, np.int64)
    k, size = at.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for b in batches:
            for i in range(b.num_rows):
                n, s = _tree(b, i, size).totals(at)
                count += n
                total += s
        number = np.repeat(np.arange(k, dtype=np.int32), size + 1)
        part = np.tile(np.arange(-1, size, dtype=np.int32), k)  # -1 for the count
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(part), pa.array(np.column_stack([count, total]).ravel())], ["cluster", "part", "n"])

    found = forest.select(*_TREE).mapInArrow(run, "cluster int, part int, n bigint").groupBy("cluster", "part").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    by = {(r["cluster"], r["part"]): int(r["n"]) for r in found}
    return [[by[c, d] // n for d in range(size)] if (n := by.get((c, -1), 0)) else centroids[c] for c in range(k)]


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 1024, k: int = 8, rounds: int = 10, seed: str = "3", keep: list[str] | None = None, leaf: int = 32) -> DataFrame:
    """row (the columns keep, or all), cluster, distance, cluster_inertia, inertia and centroid of each usable vector.

    Components are floor(scale * x). Centroids begin as the k vectors with the
    least sha256 of seed:key (ties: lesser key, then vector), in that order, and
    move `rounds` times to the floors of their vectors' means. Distances are
    squared, of equally near centroids the first counts.

    Vectors of another size, or with null or non-finite components, and null ones
    have no row. Repeated rows are vectors of their own; a null key is hashed as
    the empty one. With fewer than k vectors there are fewer centroids, with
    none no rows. Components beyond 2^27 are an error, as distances would not fit
    into 64 bits. Columns of any names stay inside row.
    """
    spark = rows.sparkSession
    forest = materialize(trees(rows, vector, size, scale, keep, leaf), "forest")
    v = F.col(f"`{vector}`").cast("array<double>")
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    first = rows.filter(usable(v, size)).select(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("h"), F.col(f"`{key}`").alias("k"), v.alias("v")).orderBy("h", "k", "v").limit(k).collect()
    at = [whole_numbers(np.array(r["v"]), scale).tolist() for r in first]
    for _ in range(rounds if at else 0):
        new = moved(forest, at)
        if new == at:
            break  # further rounds would move nothing either
        at = new
    final = np.array(at, np.int64).reshape(len(at), size)
    schema = T.StructType([T.StructField("row", forest.schema["rows"].dataType.elementType), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                tree = _tree(b, i, size)
                own = tree.labels(final)
                yield pa.RecordBatch.from_arrays([b.column("rows")[i].values, pa.array(own.astype(np.int32)), pa.array(((tree.vectors - final[own]) ** 2).sum(1))], ["row", "cluster", "distance"])

    assigned = materialize(forest.mapInArrow(run, schema), "assigned")
    sums = {r["cluster"]: int(r["n"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    told = [(c, n, sum(sums.values()), at[c]) for c, n in sums.items()]
    centroids = spark.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return assigned.join(F.broadcast(centroids), "cluster").select("row", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def spell(centroid: Column) -> Column:
    return F.array_join(centroid.cast("array<string>"), ",")


def oracle_sql(k: int = 8, rounds: int = 10, seed: str = "3", size: int = 64, scale: int = 1024) -> str:
    """The same clustering by plain comparison of all vectors with all centroids."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), comps AS MATERIALIZED (SELECT r, unnest(range({size})) AS d, unnest(v) AS x FROM kept
), first AS (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec_id, v) - 1 AS c FROM kept
), c0 AS MATERIALIZED (SELECT c, unnest(range({size})) AS d, unnest(v) AS x FROM first WHERE c < {k})"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
  SELECT r, first(c ORDER BY dist, c) AS c, min(dist) AS dist FROM (
    SELECT r, c, CAST(sum((comps.x - c{t}.x) * (comps.x - c{t}.x)) AS BIGINT) AS dist FROM comps JOIN c{t} USING (d) GROUP BY r, c
  ) GROUP BY r)""")
        if t < rounds:
            steps.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT c{t}.c, c{t}.d, CAST(CASE WHEN n IS NULL THEN c{t}.x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
  FROM c{t} LEFT JOIN (SELECT c, d, sum(x) AS s, count(*) AS n FROM a{t} JOIN comps USING (r) GROUP BY c, d) m ON m.c = c{t}.c AND m.d = c{t}.d)""")
    last = f"a{rounds}"
    return f"""WITH {', '.join(steps)}
SELECT kept.vec_id, CAST({last}.c AS INTEGER) AS cluster, dist AS distance, CAST(sum(dist) OVER (PARTITION BY {last}.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM {last} JOIN kept USING (r) JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h ON h.c = {last}.c"""
