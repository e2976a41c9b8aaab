"""Licences, fingerprints, evidence, quality and mixing."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from driftscan.llm import evidence, fingerprint, licenses, mixing, quality
from driftscan.session import load


def dice(a, b):
    a, b = set(licenses.bigrams_of(a)), set(licenses.bigrams_of(b))
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0


LICENCE_TEXTS = ["Released under the MIT License.", "prose\n  RELEASED under the MIT license!\nmore", "Licensed under the Apache License,\nVersion 2.0.", "Licensed under the Apache License, version 2.0 or later", "", None, "the " * 5000, "\n\n\n", "Released", "Licensed under CC BY-NC 4.0.\n\nReleased under the MIT License.\nReleased under the MIT License.", " ".join(["/* header\n * " + licenses.TEMPLATES[11][1], "x\n\ny"]), licenses.TEMPLATES[14][1] + "\n" + "prose " * 50, licenses.TEMPLATES[12][1].replace(". ", ".\n")]


def test_licenses_against_all_templates(spark):
    df = spark.createDataFrame([(k, t, "d") for k, t in enumerate(LICENCE_TEXTS)] + [(0, LICENCE_TEXTS[0], "d"), (None, LICENCE_TEXTS[0], "d")], "doc_id bigint, text string, dice string")
    got = {(r["doc_id"], r["license"]): (r["dice"], r["n_units"]) for r in licenses.scan_licenses(df).collect()}
    want = {}
    for k, t in [*enumerate(LICENCE_TEXTS), (None, LICENCE_TEXTS[0])]:
        units = set((t or "").split("\n")) | set(__import__("re").split(r"\n[ \t]*\n+", t or ""))
        for name in {n for n, _ in licenses.TEMPLATES}:
            best = {u: max(dice(u, x) for n, x in licenses.TEMPLATES if n == name) for u in units}
            good = {u: d for u, d in best.items() if d >= 0.8}
            if good:
                want[(k, name)] = (round(max(good.values()), 6), len(good))
    assert {k: v for k, v in got.items() if want.get(k) != v} == {k: v for k, v in want.items() if got.get(k) != v} == {}
    assert (10, "Apache-2.0") in got and (11, "LGPL-2.1") in got and (12, "GPL-3.0") in got and (2, "Apache-2.0") in got and (None, "MIT") in got


def test_license_sql(spark, sf):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(c.execute(licenses.oracle_sql()).fetchall())
    got = sorted((r["doc_id"], r["license"], r["dice"], r["n_units"]) for r in licenses.scan_licenses(load(spark, sf, "documents")).collect())
    assert got == want


def test_size_bounds():
    for n in range(1, 40):
        lo, hi = licenses.size_bounds(n, 0.8)
        reach = [k for k in range(1, 200) if 2 * min(n, k) / (n + k) >= 0.8]
        assert (lo, hi) == (reach[0], reach[-1])


def test_fingerprints(spark):
    rng = np.random.default_rng(5)
    texts = {k: " ".join(f"w{x}" for x in rng.integers(0, 3000, n)) for k, n in enumerate([300, 1, 3, 40, 2000, 8])}
    texts |= {10: "", 11: None, 12: "é😀ü " * 7, -5: "last one"}
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id bigint, text string, sketch string").repartition(3)
    got = {r["doc_id"]: r for r in fingerprint.edited_pairs(df, 3).collect()}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        t, nxt = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        h = len(t) // 2
        assert got[i]["edited_text"] == t[: len(t) - h] + nxt[:h] and got[i]["n_chars"] == len(t)
        assert got[i]["next_sketch"] == got[order[(k + 1) % len(order)]]["sketch"]
        assert bool(got[i]["sketch"]) == bool(t.split())
    assert len(got[4]["sketch"]) == pytest.approx(2000 / fingerprint.SCALE, rel=0.3)


def test_fingerprint_estimates_containment_and_merges(spark):
    words = [f"u{k}" for k in range(6000)]
    whole, part = " ".join(words), " ".join(words[1000:4000])
    df = spark.createDataFrame([(whole, part)], "a string, b string")
    s = fingerprint.add_sketch(fingerprint.add_sketch(df, "a", "sa"), "b", "sb")
    r = s.select(fingerprint.containment(F.col("sa"), F.col("sb")).alias("c"), fingerprint.merge(F.col("sa"), F.col("sb")).alias("m"), "sa").first()
    assert r["c"] == 1.0 and r["m"] == r["sa"]


def test_fingerprint_rows_with_one_id_and_null_ids(spark):
    df = spark.createDataFrame([(2, "b b b b"), (2, "a a a a"), (2, "a a a a"), (None, "n n"), (9, "z z z z")], "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["edited_text"]) for r in fingerprint.edited_pairs(df, 2).collect()), key=str)
    assert got == sorted([(2, "b b n n"), (2, "a a n n"), (2, "a a n n"), (None, "n z"), (9, "z z a a")], key=str)
    assert fingerprint.edited_pairs(df.limit(0), 2).count() == 0
    one = fingerprint.edited_pairs(df.limit(1), 2).first()
    assert len(one["edited_text"]) == 7 and hashlib.sha256(one["edited_text"].encode()).hexdigest()


def labelled(spark, n=400):
    rng = np.random.default_rng(4)
    docs, labels = [], []
    for k in range(n):
        q, t = int(rng.random() < 0.8), int(rng.random() < 0.1)
        words = [f"w{x}" for x in rng.integers(0, 50, 40)]
        if t:
            words[3] = words[20] = "vile"
        text = " ".join(words) if q else " ".join(w.upper() + "!!" for w in words)
        docs.append((k, text, f"h{k % 5}" if k % 3 else "hot", "p" if k % 2 else None, "x"))
        if k % 2:
            labels.append((k, q, t))
    docs += [(900, None, None, None, "x"), (901, "", "new", "p", "x"), (None, "w1 w2", "hot", "p", "x")]
    return spark.createDataFrame(docs, "doc_id bigint, text string, host string, path string, rate string").repartition(3), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_evidence_against_counts(spark):
    docs, labels = labelled(spark)
    m = evidence.fit(evidence.labelled_sample(docs, labels, 10_000), ("quality", "toxic"))
    n1, n0 = labels.filter("toxic = 1").count(), labels.filter("toxic = 0").count()
    p1, p0 = (n1 + 0.5) / (n1 + 1), 0.5 / (n0 + 1)  # shouted, and with marks after it, it is the same word
    assert m["toxic"].weights["vile"] == pytest.approx(np.log(p1 / p0) - np.log((1 - p1) / (1 - p0)))
    empty = evidence.fit(evidence.labelled_sample(docs, labels.limit(0), 100), ("quality",))
    assert empty["quality"].weights == {} and empty["quality"].base == 0


def test_every_telling_mark_counts(spark):
    rows = [(k, " ".join(f"{'ab'[k % 2]}{x}" for x in range(400)) if k % 4 < 2 else "", k % 2) for k in range(200)]
    m = evidence.fit(spark.createDataFrame(rows, "doc_id bigint, text string, quality int"), ("quality",), families={"quality": "words"})["quality"]
    assert {f"{c}{x}" for c in "ab" for x in range(400)} <= set(m.weights)
    docs = spark.createDataFrame([(0, "a0 b399 b7 unknown"), (1, "")], "doc_id bigint, text string")
    got = evidence.words_and_style(docs).select("doc_id", "words", evidence.log_odds(m, most=1e9).alias("odds")).collect()
    for r in got:
        assert r["odds"] == pytest.approx(m.base + sum(m.weights.get(x, 0.0) for x in r["words"]))


def test_weights_become_a_table_without_a_job(spark):
    m = evidence.NaiveBayes(0.25, {"a": 1.5, "it's \\ \"b\"": -2.0, "\x00c:1": 0.125, "\u00e9": 3.0})
    sc = spark.sparkContext
    sc.setJobGroup("weights", "log odds of a model")
    odds = evidence.log_odds(m)
    sc.setJobGroup("other", "")
    assert list(sc.statusTracker().getJobIdsForGroup("weights")) == []  # a job would start Python workers on the executors
    docs = spark.createDataFrame([(list(m.weights),), (["a", "none"],), ([],)], "words array<string>")
    assert [r["odds"] for r in docs.select(odds.alias("odds")).collect()] == [0.25 + 1.5 - 2.0 + 0.125 + 3.0, 1.75, 0.25]


def test_clean_documents_are_kept_in_every_language(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels, F.col("source"), F.col("lang")).select("doc_id", "path", "kept")
    clean = found.join(labels.filter("quality = 1 and toxic = 0").select("doc_id"), "doc_id")
    shares = {r["path"]: r["share"] for r in clean.groupBy("path").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert set(shares) == {"de", "en", "es", "fr"} and min(shares.values()) > 0.98


def test_quality_shrinks_sparse_sites(spark):
    docs, labels = labelled(spark)
    got = {r["doc_id"]: r for r in quality.classify(docs, labels, F.col("host"), F.col("path")).collect()}
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r for r in labels.collect()}
    assert np.mean([(got[k]["quality_score"] >= 0.5) == bool(t["quality"]) for k, t in truth.items()]) > 0.95
    assert np.mean([(got[k]["toxic_score"] >= 0.5) == bool(t["toxic"]) for k, t in truth.items()]) > 0.95
    scored = spark.createDataFrame([(k, f"h{k % 2}", "p", float(k % 2) * 4 - 2) for k in range(200)] + [(999, "lone", "p", 0.0)], "doc_id bigint, host string, path string, quality_odds double")
    out = {r["doc_id"]: r for r in quality.combine_sites(scored).collect()}
    p = 1 / (1 + np.exp(-np.where(np.arange(200) % 2, 2.0, -2.0)))
    mean = (p.sum() + 0.5) / 201
    assert out[999]["quality_host"] == pytest.approx(mean) and out[999]["quality_score"] == pytest.approx(0.5, abs=1e-6)
    assert out[0]["quality_host"] < mean < out[1]["quality_host"]
    assert quality.combine_sites(scored.limit(0)).count() == 0


def test_rates_reach_targets(spark):
    docs, labels = labelled(spark)
    rated, report = mixing.mix(docs, labels, weights={"good": 0.85, "good_toxic": 0.04, "low": 0.1, "low_toxic": 0.01})
    assert report["reached"] == pytest.approx(report["targets"], abs=2e-3 * max(report["start"]))
    rows = rated.collect()
    assert len(rows) == docs.count() and all(r["rate"] >= 0 for r in rows)
    reached = np.sum([np.array(r["p"]) * r["rate"] * r["tokens"] for r in rows], axis=0)
    assert reached == pytest.approx(report["reached"])
    assert rated.select("row.rate").count() == len(rows)
    kept = mixing.apply_rates(mixing.mix(docs, labels, factors={"good_toxic": 0.0, "low_toxic": 0.0}, most=1.0)[0])
    assert kept.columns == docs.columns and kept.filter("text like '%vile%'").count() == 0
    assert kept.filter("text not like '%vile%' and text not like '%!!%'").count() == docs.filter("text not like '%vile%' and text not like '%!!%'").count()


def test_mixing_empty(spark):
    docs, labels = labelled(spark, 4)
    rated, report = mixing.mix(docs.limit(0), labels, weights={"good": 1.0})
    assert rated.count() == 0 and report["reached"] == [0.0] * 4


def test_rates_against_least_squares_in_numpy(spark):
    docs, labels = labelled(spark)
    weights = {"good": 0.7, "good_toxic": 0.0, "low": 0.3, "low_toxic": 0.0}
    for most in (None, 1.0):
        rated, report = mixing.mix(docs, labels, weights=weights, most=most)
        rows = rated.collect()
        p, t = np.array([r["p"] for r in rows]), np.array([float(r["tokens"]) for r in rows])
        start = t @ p
        target = np.array([weights[d] for d in mixing.DOMAINS]) * start.sum()
        scale = np.maximum(1, start)
        rate = np.ones(len(t))
        for _ in range(20_000):
            rate = np.clip(rate - p @ (((t * rate) @ p - target) / scale), 0, most)
        got = np.array([r["rate"] for r in rows])
        assert got.min() >= 0 and (most is None or got.max() <= most)

        def loss(r, p=p, t=t, target=target, scale=scale):
            return ((((t * r) @ p - target) / scale) ** 2 * scale).sum() / scale.sum()

        assert report["settled"] and loss(got) <= loss(rate) + 1e-3
        assert (t * got) @ p == pytest.approx(report["reached"])


def test_rates_are_fitted_on_distinct_posteriors(spark, monkeypatch):
    docs, labels = labelled(spark)
    fit, read = mixing.fit_rates, []
    monkeypatch.setattr(mixing, "fit_rates", lambda posteriors, *rest: read.append(posteriors) or fit(posteriors, *rest))
    rated, report = mixing.mix(docs.unionByName(docs), labels, weights={"good": 0.7, "good_toxic": 0.0, "low": 0.3, "low_toxic": 0.0})
    rows = rated.collect()
    tokens = {}
    for r in rows:
        tokens[tuple(r["p"])] = tokens.get(tuple(r["p"]), 0) + r["tokens"]
    got = [(tuple(r["p"]), r["tokens"]) for r in read[0].collect()]
    assert len(got) == len(tokens) <= len(rows) / 2 and dict(got) == tokens
    assert np.sum([np.array(r["p"]) * r["rate"] * r["tokens"] for r in rows], axis=0) == pytest.approx(report["reached"])


def test_rates_above_one_make_copies(spark):
    rows = [(k, "x", [0.0, 0.5, 1.0, 1.5, 2.0, 3.25][k % 6]) for k in range(6000)]
    rated = spark.createDataFrame(rows, "doc_id bigint, text string, rate double").select(F.struct("doc_id", "text").alias("row"), "rate")
    n = {r["g"]: r["n"] for r in mixing.apply_rates(rated).groupBy((F.col("doc_id") % 6).alias("g")).agg(F.count("*").alias("n")).collect()}
    assert 0 not in n and n[2] == 1000 and n[4] == 2000
    assert n[1] == pytest.approx(500, abs=80) and n[3] == pytest.approx(1500, abs=80) and n[5] == pytest.approx(3250, abs=80)


def test_accuracy_on_labels_held_out(spark):
    """Fitted on half of the labels, by a hash of the id; held against the other half."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = quality.classify(docs, labels.filter(half), F.col("source"), F.col("lang"))
    r = found.join(labels.filter(~half), "doc_id").agg(*(F.avg(((F.col(f"{t}_score") >= 0.5).cast("int") == F.col(t)).cast("int")).alias(t) for t in ("quality", "toxic")), *(F.avg(F.abs(F.col(f"{t}_score") - F.col(t))).alias(f"{t}_off") for t in ("quality", "toxic"))).first()
    assert r["quality"] > 0.985 and r["toxic"] > 0.98, r


def test_sites_keep_columns_of_any_name(spark):
    scored = spark.createDataFrame([(1, "h", "p", 0.5, 7, 8)], "doc_id bigint, host string, path string, quality_odds double, n_site int, t_host int")
    r = quality.combine_sites(scored).first()
    assert (r["n_site"], r["t_host"]) == (7, 8)
