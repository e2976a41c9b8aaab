import random
from collections import defaultdict

import numpy as np
import pytest

from driftscan.llm import components, neardup


def brute(rows, percent):
    def sh(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [(i, sh(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i) if s else i) for i, s in sets}


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    docs = []
    base = [word() for _ in range(150)]
    for _ in range(120):  # one group whose members differ from the base in 0 to 5 words
        w = base[:]
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 5])):
            w[rng.randrange(150)] = word()
        docs.append(" ".join(w))
    for _ in range(40):
        docs.append(" ".join(word() for _ in range(rng.randrange(1, 80))))
    chain = [word() for _ in range(120)]
    for _ in range(8):  # each linked with the one before it only
        chain = chain[4:] + [word() for _ in range(4)]
        docs.append(" ".join(chain))
    docs += ["a b c", "A  b\tc", "a b", "", None, " \n ", docs[0].upper(), docs[130], "x y z w v " * 300]
    rng.shuffle(docs)
    return [(k * 3 + 1, t) for k, t in enumerate(docs)]


@pytest.mark.parametrize("percent", [85, 80])
def test_against_all_pairs(spark, percent):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, component_id string").repartition(3)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(df, percent).collect()}
    want = brute(rows, percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_nulls_repeats_and_empty(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(4, text), (4, text), (None, text), (9, text), (None, None), (5, "other words that stand quite alone here")], "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(4, 4, True), (4, 4, True), (9, 4, False), (None, None, True), (None, None, True), (5, 5, True)], key=str)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_shingles_in_blocks():
    text = ("alpha beta gamma\tdelta\nepsilon " * 50).encode()
    assert (neardup.shingles(text, block=64) == neardup.shingles(text)).all()


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 63, 600, dtype=np.uint64), rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    x, y = np.unique(a), np.unique(np.concatenate([a[:400], b]))
    want = 400 / 800
    assert abs((neardup.signature(x, 192) == neardup.signature(y, 192)).mean() - want) < 0.15


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(50)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for start in near:
        seen, todo = set(), [start]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += near[x]
        assert got[start] == min(seen)
    assert set(got) == set(near)


@pytest.mark.parametrize("sample", [1024, 1_000_000])
def test_sets_larger_than_the_sample_against_all_pairs(spark, sample):
    """Texts of 3,000 words on both sides of the least similarity, with and without exact comparison."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    docs = []
    for _ in range(6):
        base = [word() for _ in range(3000)]
        for share in (0, 0.005, 0.01, 0.013, 0.016, 0.02, 0.03):  # of words changed; at about 0.016 a fifteenth of all shingles go
            w = base[:]
            for k in rng.sample(range(3000), int(3000 * share)):
                w[k] = word()
            docs.append(" ".join(w))
        docs.append(" ".join(base[:2600]))
    rng.shuffle(docs)
    rows = list(enumerate(docs, 1))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, 85, sample).collect()}
    assert got == brute(rows, 85)
    assert max(n for n, _ in got.values()) > 2900 and 6 < len({c for _, c in got.values()}) < len(rows)
