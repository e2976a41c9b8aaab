"""Resampling against SQL and against plain counting of word runs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from driftscan.llm import queries, resampling


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text, longest, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, longest=1, buckets=10_000, seed="2024", least=20, percent=10):
    s, t = (Counter(f for text in texts for f in features(text, longest, buckets)) for texts in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]
    out = []
    for key, text in docs:
        f = features(text, longest, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([key, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return [(*r, rank.get(id(r))) for r in out]


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got, want = map(tuple, queries.op13_resampling(spark, sf).collect()), con.execute(queries.ORACLES["op13_resampling"]).fetchall()
    assert len(want) and sorted(got, key=str) == sorted(want, key=str)


def test_query_matches_plain_counting(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = queries.op13_resampling(spark, sf).collect()
    assert sorted((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"] or 0) for r in got) == sorted((r[0], r[2], r[3], r[4], r[5] or 0) for r in brute(docs, target))


@pytest.mark.parametrize("longest", [1, 3])
def test_runs_long_texts_and_full_tries(longest, monkeypatch):
    text = "Él perro 7up, the-dog THE dog; ñandú 日本 " * 40 + "end"
    want = features(text, longest, 97)
    trie = resampling.WordTrie(longest, 97, 1500, np.arange(97))
    n = weight = 0
    for sign, run in resampling.signed_runs(text.encode(), longest, 50):
        trie.add([run, []], [sign, 1])
        got = trie.score([run], [sign])
        n, weight = n + got[0].sum(), weight + got[1].sum()
    trie.flush()
    assert (n, weight) == (len(want), sum(want))
    assert trie.totals.tolist() == np.bincount(want, minlength=97).tolist()


@pytest.mark.parametrize("longest", [1, 2])
def test_nulls_ties_repeats_and_clashing_names(spark, longest):
    long = "word " * 30_000 + "Alpha beta " * 20
    docs = [(1, None), (2, ""), (None, "one two " * 15), (None, "one two " * 15), (3, "one two " * 15), (3, "one two " * 15), (4, long), (5, "a " * 19), (6, "a-b " * 10), (7, "Ünï 中文 " * 12), (8, ", ; !")]
    target = ["two one", None, "", "alpha beta"]
    df = spark.createDataFrame([(k, t, 5, "r") for k, t in docs], "doc_id long, text string, score int, row string").repartition(3)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, aim, longest=longest, percent=50)
    rows = [(str(r["row"]["doc_id"]), r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"] or 0) for r in got.collect()]
    assert sorted(rows) == sorted((str(r[0]), *r[1:5], r[5] or 0) for r in brute(docs, target, longest, percent=50))
    assert got.select("row.*").columns == df.columns
    assert resampling.resample(df.limit(0), aim, keep=["text"]).count() == 0
    assert resampling.resample(df, aim.limit(0), keep=["text"]).count() == len(docs)
