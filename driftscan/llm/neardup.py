"""Near-duplicate documents by circulant MinHash.

A document is the set of its 5-word shingles, as 64-bit hashes. The first
permutation scatters a shingle over D slots; the second is one fixed random
order of the slots, and coordinate k of the signature is the least value of that
order shifted circularly by k, so that two permutations give all coordinates.
Bands of coordinates bring candidates together; links are confirmed on the full
sets.

Documents with equal sets are one node from the start. Within a band's bucket
every node is first compared with the bucket's centre alone, the node that meets
most others. The links found are joined into components, and only nodes of a
bucket that are still in different components are then held against each other:
by their sizes, by one bit of each coordinate, and by their sets or samples of
them, all within the join, so that pairs that no link joins are not emitted. A
large group of copies thus costs about one comparison a member, and no link
between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftscan.llm.components import connected_components
from driftscan.llm.texts import blocks
from driftscan.session import drop_path, materialize, scratch_tables

WORDS, SLOTS = 5, 1 << 20
BANDS, ROWS = 32, 6
#: Shingles of a set that go along into a bucket; a larger set sends a sample of about as many.
SAMPLE = 1024
_M = np.uint64(0x9E3779B97F4A7C13)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes | None, words: int = WORDS, block: int = 1_000_000) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text; a text of fewer words is one shingle, one of none has none."""
    hashes = []
    for own in (b.lower().split() for b in blocks(text or b"", block)):
        hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)))
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    if not len(h):
        return h
    n = min(words, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = out * _M + h[k : k + len(out)]
    return np.unique(_mix(out + np.uint64(n)))


@lru_cache(maxsize=1)
def _order(coordinates: int) -> np.ndarray:
    """Row s holds the second permutation at slots s, s+1, ... (mod D): a view, not a table."""
    order = np.random.default_rng(20).permutation(SLOTS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[: coordinates - 1]]), coordinates)


def signature(sh: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    order, slots = _order(coordinates), (sh >> np.uint64(44)).astype(np.int64)
    out = np.full(coordinates, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(slots), 2048):
        np.minimum(out, order[slots[at : at + 2048]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = sig.reshape(bands, -1).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(rows.shape[1]):
        key = _mix(key * _M + rows[:, k])
    return key.view(np.int64)


SIGNATURES = "doc_id bigint, n bigint, digest binary, bands array<bigint>, bits array<bigint>"


def signatures(documents: DataFrame) -> DataFrame:
    """doc_id, n (size of the shingle set), digest of the set, band keys and the lowest bit of each coordinate; null ids pass."""
    names = [x.split()[0] for x in SIGNATURES.split(", ")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                ids, n, digests, bands, sigs = batch.column(0)[lo : lo + 1000], [], [], [], []
                for text in batch.column(1)[lo : lo + 1000]:
                    sh = shingles(text.as_py())
                    n.append(len(sh))
                    digests.append(xxhash.xxh3_128_digest(sh.tobytes()) if len(sh) else None)
                    sig = signature(sh) if len(sh) else None
                    bands.append(band_keys(sig) if len(sh) else None)
                    sigs.append(np.packbits((sig & 1).astype(np.uint8)).view(np.int64) if len(sh) else None)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))], names)

    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, SIGNATURES)


def shingle_sets(documents: DataFrame) -> DataFrame:
    """doc_id, sh (sorted distinct shingle hashes)."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                sets = [shingles(t.as_py()).view(np.int64) for t in batch.column(1)[lo : lo + 200]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + 200], pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "sh"])

    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, "doc_id bigint, sh array<bigint>")


def _differing(a: str, b: str) -> Column:
    """Coordinates whose lowest bits differ; of two sets with similarity j a share (1 - j) / 2 does so."""
    return sum((F.bit_count(F.col(f"{a}.bits")[k].bitwiseXOR(F.col(f"{b}.bits")[k])) for k in range(BANDS * ROWS // 64)), F.lit(0))


def most_differing(percent: int) -> int:
    """Six standard deviations above what a pair just linked is expected to have."""
    p, n = (1 - percent / 100) / 2, BANDS * ROWS
    return math.ceil(n * p + 6 * math.sqrt(n * p * (1 - p)))


def _linked(a: Column, b: Column, percent: int) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both * 100 >= (F.size(a) + F.size(b) - both) * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are linked."""
    left, right = sets.select(F.col("doc_id").alias("a"), F.col("sh").alias("sa")), sets.select(F.col("doc_id").alias("b"), F.col("sh").alias("sb"))
    return materialize(pairs.join(left, "a").join(right, "b").filter(_linked(F.col("sa"), F.col("sb"), percent)).select("a", "b").distinct(), "links")


#: Ids are broadcast only where they have been counted to be at most so many.
MOST_BROADCAST = 500_000


def _sets_of(documents: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """Full shingle sets of the wanted ids; where ids are repeated, each of an id's sets once."""
    ids = materialize(wanted.select(F.col("node").alias("doc_id")).distinct(), "wanted")
    if ids.count() <= MOST_BROADCAST:
        ids = F.broadcast(ids)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    sets = shingle_sets(texts)
    return materialize(sets.distinct() if repeated else sets, "sets")


def compact(sets: DataFrame, most: int = SAMPLE) -> DataFrame:
    """node, n, level, k0, k1, sample: 32 bits of each hash, of a set over `most` only those in the lowest 2^-level of the range.

    k0 counts the sample, k1 what one level more would leave, so that sets of
    neighbouring levels can be compared.
    """
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.size("sh") / float(most)))).cast("int")
    own = sets.filter(F.size("sh") > 0).select(F.col("doc_id").alias("node"), "sh", F.size("sh").alias("n"), level.alias("level"))
    high = [F.expr(f"filter(sh, h -> shiftrightunsigned(h, 32) < shiftright(4294967296L, level + {k}))") for k in (0, 1)]
    own = own.select("node", "n", "level", high[0].alias("low"), F.size(high[1]).alias("k1"))
    return own.select("node", "n", "level", F.size("low").alias("k0"), "k1", F.expr("transform(low, h -> cast(h & 2147483647L as int))").alias("sample"))


def _near(x: str, y: str, percent: int) -> Column:
    """Whether the samples leave a link possible: exact for sets that are their own sample, else within five standard deviations."""
    deeper = F.greatest(F.col(f"{x}.level"), F.col(f"{y}.level"))
    kx, ky = (F.when(F.col(f"{s}.level") == deeper, F.col(f"{s}.k0")).otherwise(F.col(f"{s}.k1")) for s in (x, y))
    both, p = F.size(F.array_intersect(F.col(f"{x}.sample"), F.col(f"{y}.sample"))), percent / 100
    margin = F.when(deeper == 0, F.lit(0.0)).otherwise(5 * math.sqrt(p * (1 - p)) / F.sqrt(F.greatest(F.lit(1), F.least(kx, ky)).cast("double")))
    return both >= (F.lit(p) - margin) * (kx + ky - both) - 2


def _fits(n: str, m: str, percent: int) -> Column:
    """Whether sets of these sizes can be linked at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def near_duplicates(documents: DataFrame, percent: int = 85, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of documents.

    Documents are linked when 100 * |intersection| >= percent * |union| of their
    shingle sets (percent 80 or more); component_id is the smallest id reached.
    Null and empty texts have no shingles and no links. Rows with one id are one
    node; those with a null id are linked with nothing, have a null
    component_id, and are kept. The other columns are not read. Sets above
    `sample` shingles are first compared by samples of about as many; a sample as
    large as the largest set leaves all comparisons exact.
    """
    with scratch_tables() as made:
        out = materialize(_found(documents, percent, sample), "near_duplicates")
    for path in made[:-1]:
        drop_path(documents.sparkSession, path)
    return out


def _found(documents: DataFrame, percent: int, sample: int) -> DataFrame:
    sig = materialize(signatures(documents), "signatures")
    named = sig.filter("n > 0 and doc_id is not null")
    nodes = materialize(named.groupBy("digest").agg(F.min("doc_id").alias("node")), "nodes")
    own = [F.when(F.col("doc_id") == F.col("node"), F.col(c)).alias(c) for c in ("bands", "bits")]
    members = materialize(named.join(nodes, "digest").select("doc_id", "node", "n", *own), "members")
    in_bands = members.filter("bands is not null").select("node", "n", F.explode("bands").alias("band"))

    # buckets of two nodes or more, and each bucket's centre: the node that meets most others
    buckets = in_bands.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("size")).filter("lo < hi")
    shared = materialize(in_bands.join(materialize(buckets.select("band", "size"), "buckets"), "band").distinct(), "shared")
    popular = shared.groupBy("node").agg(F.sum("size").alias("met"))
    ranked = materialize(shared.join(popular, "node").select("band", "node", "n", "met"), "ranked")
    top = ranked.groupBy("band").agg(F.max(F.struct("met", (-F.col("node")).alias("minus"), F.col("n"))).alias("top"))
    centres = materialize(top.select("band", (-F.col("top.minus")).alias("centre"), F.col("top.n").alias("n_centre")), "centres")
    star = ranked.select("band", "node", "n").join(centres, "band").filter((F.col("node") != F.col("centre")) & _fits("n", "n_centre", percent))
    star = materialize(star.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct(), "star")
    same_id = materialize(members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("rows")).filter("rows > 1").select("a", "b"), "same_id")
    sets = _sets_of(documents, shared, not same_id.isEmpty())
    links = _verified(star, sets, percent).unionByName(same_id.filter("a < b"))
    found = connected_components(links, "a", "b")

    # what is left within buckets: nodes of different components that have not met
    placed = materialize(shared.select("band", "node").join(found, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component")), "placed")
    mixed = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("band")
    side = materialize(placed.join(materialize(mixed, "mixed"), "band"), "open").join(compact(sets, sample), "node").join(members.filter("bits is not null").select("node", "bits").distinct(), "node")
    x, y = side.alias("x"), side.alias("y")
    met = (F.col("x.band") == F.col("y.band")) & (F.col("x.component") < F.col("y.component"))
    apart = x.join(y, met & _fits("x.n", "y.n", percent) & (_differing("x", "y") <= most_differing(percent)) & _near("x", "y", percent))
    apart = apart.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    apart = materialize(apart.distinct().join(star, ["a", "b"], "left_anti"), "apart")
    if not apart.isEmpty():
        found = connected_components(links.unionByName(_verified(apart, sets, percent)), "a", "b")

    ids = members.select("doc_id", "node").join(found, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    out = sig.select("doc_id", "n").join(ids, "doc_id", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
