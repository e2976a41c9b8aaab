"""Importance resampling of documents towards a target's distribution of word runs.

Each partition keeps a trie of words: a node stands for a run of words, holds
how often it was met and the CRC state of its letters, from which a longer run's
is continued. The counts of a partition's nodes are merged into bucket totals,
and these over all partitions. Documents are scored by walking a trie whose
nodes have their bucket's gain attached. A full trie hands its counts over and
starts anew, so that its size is bounded and nothing is lost.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftscan.llm.texts import blocks
from driftscan.operators import ranges
from driftscan.session import materialize, ship

#: Bytes 0-9, a-z and 128 up make words, A-Z as a-z; all others stand between them.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
#: What a node takes beside its word's letters.
NODE_BYTES = 220


class WordTrie:
    """Nodes of word runs of up to `longest` words; node 0 is the root. gains: of each bucket, attached to nodes as they are made."""

    def __init__(self, longest: int, buckets: int, most_bytes: int, gains: np.ndarray | None = None):
        self.longest, self.buckets, self.most_bytes, self.gains = longest, buckets, most_bytes, gains
        self.totals = np.zeros(buckets, np.int64)
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}  # children of the root
        self.children: dict[int, int] = {}  # of other nodes, by node and the root's child that is the word
        self.letters: list[bytes] = [b""]  # of the root's children, by node
        self.state, self.count = np.zeros(1 << 12, np.uint32), np.zeros(1 << 12, np.int64)
        self.gain = np.zeros(1 << 12, np.int64)
        self.n, self.held = 1, 0

    def _grow(self, states: list[int]) -> None:
        stop = self.n + len(states)
        while stop > len(self.state):
            self.state, self.count, self.gain = (np.concatenate([x, np.zeros_like(x)]) for x in (self.state, self.count, self.gain))
        self.state[self.n : stop] = states
        if self.gains is not None:
            self.gain[self.n : stop] = self.gains[self.state[self.n : stop] % self.buckets]
        self.n, self.held = stop, self.held + NODE_BYTES * len(states)

    def first(self, words: list[bytes]) -> np.ndarray:
        """The root's child of each word."""
        new = list(set(words).difference(self.words))
        if new:
            made = range(self.n, self.n + len(new))
            self.words.update(zip(new, made, strict=True))
            if self.longest > 1:
                self.letters += [b""] * (made.stop - len(self.letters))
                self.letters[made.start : made.stop] = new
            self._grow(list(map(zlib.crc32, new)))
            self.held += sum(map(len, new))
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))

    def deeper(self, nodes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The child of each node by the word, given as the root's child."""
        keys, back = np.unique(nodes << 32 | words, return_inverse=True)
        found = list(map(self.children.get, keys.tolist()))
        new = [k for k, x in enumerate(found) if x is None]
        states = []
        for k in new:
            key = int(keys[k])
            found[k] = self.children[key] = self.n + len(states)
            states.append(zlib.crc32(b" " + self.letters[key & 0xFFFFFFFF], int(self.state[key >> 32])))
        if states:
            self._grow(states)
        return np.array(found, np.int64)[back]

    def walk(self, runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Node and run of every feature in the runs of words, level by level."""
        if self.held > self.most_bytes:
            self.flush()
        at = np.repeat(np.arange(len(runs)), np.fromiter(map(len, runs), np.int64, len(runs)))
        words = self.first([w for r in runs for w in r])
        nodes = words
        yield nodes, at
        for k in range(1, self.longest):
            same = at[k:] == at[:-k] if k < len(at) else np.zeros(0, bool)  # a run's words stand together
            # nodes[i] stands for the k words from starts[i] on
            starts = np.flatnonzero(same)
            held = nodes[starts] if k == 1 else nodes[np.searchsorted(before, starts)]
            nodes, before = self.deeper(held, words[starts + k]), starts
            yield nodes, at[starts]

    def add(self, runs: list[list[bytes]], signs: list[int]) -> None:
        sign = np.array(signs, np.int64)
        for nodes, at in self.walk(runs):
            np.add.at(self.count, nodes, sign[at])

    def score(self, runs: list[list[bytes]], signs: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Features and sum of gains of each run, times its sign."""
        n, weight = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
        for nodes, at in self.walk(runs):
            n += np.bincount(at, minlength=len(runs))
            np.add.at(weight, at, self.gain[nodes])
        sign = np.array(signs, np.int64)
        return n * sign, weight * sign

    def flush(self) -> None:
        """Counts go to the buckets' totals, and the trie is empty."""
        np.add.at(self.totals, self.state[1 : self.n] % self.buckets, self.count[1 : self.n])
        self.clear()


def signed_runs(text: bytes, longest: int, block_bytes: int = 1_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """The words of a text, lower-cased, in bounded runs with signs.

    A long text's run begins with the last words of the one before, so that no
    feature is cut; what lies wholly in those is taken off again by a run of
    sign -1.
    """
    before: list[bytes] = []
    for block in blocks(text.translate(_WORDS), block_bytes):
        words = block.split()
        if before:
            yield -1, before
        yield 1, before + words
        before = (before + words)[1 - longest :] if longest > 1 else []


def _batches(column: pa.Array, longest: int, most_bytes: int = 1_000_000) -> Iterator[tuple[list[list[bytes]], list[int], list[int]]]:
    """Runs of many texts together: runs, signs and the text's place of each."""
    runs, signs, of, held = [], [], [], 0
    for k, text in enumerate(column):
        for sign, words in signed_runs(text.as_py() or b"", longest):
            runs.append(words)
            signs.append(sign)
            of.append(k)
            held += sum(map(len, words)) + len(words)
            if held > most_bytes:
                yield runs, signs, of
                runs, signs, of, held = [], [], [], 0
    if runs:
        yield runs, signs, of


def bucket_totals(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000, trie_bytes: int = 64_000_000) -> DataFrame:
    """bucket and n, the features of all whole texts in it; buckets without any have no row."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = WordTrie(longest, buckets, trie_bytes)
        for b in batches:
            for runs, signs, _ in _batches(b.column(0), longest):
                trie.add(runs, signs)
        trie.flush()
        full = np.flatnonzero(trie.totals)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(trie.totals[full])], ["bucket", "n"])

    found = texts.select(F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(run, "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over its share in the raw texts, each count plus one."""
    size, s, t = len(raw), raw.tolist(), target.tolist()
    all_s, all_t = float(sum(s) + size), float(sum(t) + size)
    return np.array([math.floor(1000 * math.log((float(b + 1) * all_s) / (float(a + 1) * all_t))) for a, b in zip(s, t, strict=True)], np.int64)


def draw_noise(seed: str, key: str | None) -> int:
    """floor(-1000 ln(-ln u)) of a number u between 0 and 1 from a hash of seed and key; a null key is the empty one."""
    h = int(hashlib.sha256(f"{seed}:{key or ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(documents: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = 1, seed: str = "2024", keep: list[str] | None = None, trie_bytes: int = 64_000_000) -> DataFrame:
    """row (a struct of the columns keep, or of all), n_words, n_features, weight and score of each document."""
    ship(documents.sparkSession)
    row = F.struct(*(F.col(f"`{c}`") for c in (documents.columns if keep is None else keep)))
    given = documents.select(row.alias("row"), F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    numbers = ("n_words", "n_features", "weight", "score")
    schema = T.StructType([given.schema["row"], *(T.StructField(n, T.LongType()) for n in numbers)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = WordTrie(longest, len(gain), trie_bytes, gain)
        for b in batches:
            out = np.zeros((3, b.num_rows), np.int64)
            for runs, signs, of in _batches(b.column(2), longest):
                n, weight = trie.score(runs, signs)
                lengths = np.fromiter(map(len, runs), np.int64, len(runs)) * np.array(signs, np.int64)
                for k, x in enumerate((lengths, n, weight)):
                    np.add.at(out[k], of, x)
            noise = np.array([draw_noise(seed, x.as_py()) for x in b.column(1)], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, out), pa.array(out[2] + noise)], ["row", *numbers])

    return given.mapInArrow(run, schema)


def resample(documents: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", longest: int = 1, buckets: int = 10_000, seed: str = "2024", least_words: int = 20, percent: int = 10, keep: list[str] | None = None, trie_bytes: int = 64_000_000) -> DataFrame:
    """row (the columns keep, or all), n_words, n_features, weight, score and rank of each document.

    Features are runs of 1 to longest words, repeats counted, by the CRC of their
    letters in `buckets` buckets. Of the documents with least_words words the
    highest scores are drawn, floor(percent of them / 100); their rank counts
    from 1, ties to the lesser key, and is null for all others. Only `buckets`
    numbers of each table pass through the driver.

    Null and empty texts have no features and weight 0. A null key is hashed as
    the empty one and stands last among ties; repeated rows are documents of
    their own, in any order among each other. An empty table has no rows; an
    empty target gives gains as any other. Columns of any names stay inside row.
    """
    totals = []
    for texts in (documents, target):
        of = np.zeros(buckets, np.int64)
        for r in bucket_totals(texts, text, longest, buckets, trie_bytes).collect():
            of[r["bucket"]] = r["n"]
        totals.append(of)
    held = [*(documents.columns if keep is None else keep)]
    rows = scored(documents, gains(*totals), key, text, longest, seed, [*dict.fromkeys([*held, key])], trie_bytes)
    rows = materialize(rows, "scored")
    able = F.col("n_words") >= least_words
    n_drawn = rows.filter(able).count() * percent // 100
    placed = ranges.positions(rows.filter(able), F.col("score").desc(), F.col("row")[key].asc_nulls_last(), name="rank")
    rank = F.when(F.col("rank") <= n_drawn, F.col("rank")).alias("rank")
    out = placed.withColumn("rank", rank).unionByName(rows.filter(~able).withColumn("rank", F.lit(None).cast("bigint")))
    return out.withColumn("row", F.struct(*(F.col("row")[c].alias(c) for c in held)))


def oracle_sql(buckets: int = 10_000, seed: str = "2024", least_words: int = 20, percent: int = 10) -> str:
    """Single words' features by plain counting; the CRC goes letter by letter through a table made from its polynomial."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""WITH words AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, {words} AS w FROM documents
), counted AS MATERIALIZED (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM words) GROUP BY ALL
), aimed AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest({words}) AS word FROM benchmark) GROUP BY word
), byte AS (SELECT list(crc ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: {step}) AS crc FROM (SELECT unnest(range(256)) AS b))
), letters AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM counted UNION SELECT word FROM aimed)
), bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda i: CAST(strpos('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) * 16 + strpos('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 17 AS BIGINT)) AS b FROM letters
), hashed AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[CAST(xor(c & 255, x) AS BIGINT) + 1])), 4294967295) % {buckets} AS bucket FROM bytes, byte
), raw AS (SELECT bucket, sum(n) AS s FROM counted JOIN hashed USING (word) GROUP BY bucket
), target AS (SELECT bucket, sum(n) AS t FROM aimed JOIN hashed USING (word) GROUP BY bucket
), sums AS (SELECT coalesce((SELECT sum(s) FROM raw), 0) AS all_s, coalesce((SELECT sum(t) FROM target), 0) AS all_t
), gains AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(all_s + {buckets} AS DOUBLE)) / (CAST(s + 1 AS DOUBLE) * CAST(all_t + {buckets} AS DOUBLE)))) AS BIGINT) AS gain
  FROM raw LEFT JOIN target USING (bucket), sums
), weights AS (SELECT r, sum(n) AS n, sum(n * gain) AS weight FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r
), scores AS (
  SELECT doc_id, r, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (r)
), placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE n_words >= {least_words}
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM placed) * {percent} // 100 THEN rank END AS rank FROM scores LEFT JOIN placed USING (r)"""
