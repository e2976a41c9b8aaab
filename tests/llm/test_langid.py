import numpy as np
import pytest
from pyspark.sql import functions as F

from driftscan.llm import langid
from driftscan.session import load


def test_gradients_are_those_of_the_loss():
    net = langid.fit([b"abc", b"xyz", b"abx"], ["p", "q", "p"], hidden=3, updates=1, batch=3)
    codes, mask = langid.pad([b"abca", b"xy", b"zz"])
    labels, weights = np.array([0, 1, 1]), np.ones(3, np.float32)
    for arr in (net.out, net.u[0], net.u[1], net.w[0], net.w[1], net.bias):
        arr[...] = arr.astype(np.float32)
    _, g = net.gradients(codes, mask, labels, weights)
    for name, arr in (("out", net.out), ("bias", net.bias), ("u0", net.u[0]), ("u1", net.u[1]), ("w0", net.w[0]), ("w1", net.w[1])):
        flat = np.argmax(np.abs(g[name]))
        at = np.unravel_index(flat, arr.shape)
        old, eps = arr[at], np.float32(1e-2)
        arr[at] = old + eps
        up, _ = net.gradients(codes, mask, labels, weights)
        arr[at] = old - eps
        down, _ = net.gradients(codes, mask, labels, weights)
        arr[at] = old
        assert (up - down) / (2 * eps) == pytest.approx(g[name][at], rel=0.05, abs=1e-3)


def test_held_out_accuracy(spark, sf):
    docs = load(spark, sf, "documents")
    found = langid.identify(docs, langid.train(docs)).select("row.doc_id", "row.lang", "lang_pred", "score").withColumn("held", langid.held_out(F.col("doc_id")))
    r = found.filter("held").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r["a"] > 0.95 and 0 <= r["lo"] and r["hi"] <= 1


def test_edges(spark):
    rows = [(k, t, lang, "c") for k, (t, lang) in enumerate([("the quick brown fox", "en"), ("le renard brun vite", "fr")] * 30)]
    rows += [(None, None, "en", None), (100, "", "fr", None), (101, "123 !!", "en", None), (102, "x" * 5000, None, None), (102, "x" * 5000, None, None), (103, "ж", None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string")
    net = langid.train(df)
    assert net.langs == ["en", "fr"]
    got = langid.identify(df, net).collect()
    assert len(got) == len(rows)
    pred = {r["row"]["doc_id"]: r["lang_pred"] for r in got}
    assert pred[None] == pred[100] == pred[101] == "und" and pred[102] in net.langs and pred[103] in net.langs
    assert pred[0] == "en" and pred[1] == "fr"
    assert {r["lang_pred"] for r in langid.identify(df, langid.train(df.withColumn("lang", F.lit(None).cast("string")))).collect()} == {"und"}
    assert langid.identify(df.limit(0), net).count() == 0


def test_scores_are_those_of_a_pass_byte_by_byte():
    words = [b"the fox and", b"der fuchs und", b"le renard", b"el zorro"] * 20
    net = langid.fit(words, ["en", "de", "fr", "es"] * 20, hidden=5, segment=16, updates=4)
    texts = [b"The fox, and", b"le renard le " * 7, b"", b"a" * 100, "éß und".encode(), b"x" * 16, b"y" * 32]
    got = net.probabilities(texts, rows=3)
    each = np.concatenate([net.probabilities([t]) for t in texts])
    assert np.allclose(got, each, atol=1e-6)

    def gate(x):
        return 1 / (1 + np.exp(-x))

    for text, p in zip(texts, got, strict=True):
        total, h = np.zeros(4), net.hidden
        low = text.lower()
        for at in range(0, len(low), 16):
            own = low[at : at + 16]
            both = np.zeros((len(own), 2 * h))
            for d in (0, 1):
                s = np.zeros(h)
                for k in range(len(own)) if d == 0 else reversed(range(len(own))):
                    x, u = net.w[d][own[k]].astype(float), net.u[d].astype(float)
                    z, r = gate(x[:h] + s @ u[:, :h]), gate(x[h : 2 * h] + s @ u[:, h : 2 * h])
                    s = s + z * (np.tanh(x[2 * h :] + (r * s) @ u[:, 2 * h :]) - s)
                    both[k, d * h : (d + 1) * h] = s
            e = np.exp(both @ net.out + net.bias)
            total += (e / e.sum(axis=1, keepdims=True)).sum(axis=0)
        assert np.allclose(p, total / len(text) if text else 0.25, atol=1e-5)


def test_rare_languages_are_learned(spark):
    rows = [(k, "some english words here", "en") for k in range(2000)] + [(5000 + k, "mots rares en texte", "fr") for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    _, langs = langid.training_segments(df, max_docs=100, max_segments=400)
    assert langs.count("fr") >= 12 and langs.count("en") < 400
