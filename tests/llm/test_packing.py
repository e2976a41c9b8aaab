import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from driftscan.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_are_the_tokenizers_ids(spark):
    texts = ["don't stop, It's 12,3! été… a-.b ,, x—. <|endoftext|>. \x1cz", None, "", "word " * 5000, "Ünïcode ΣΣ İ́ naïve!!", "short", "short", "a" * 30000] + [f"sentence number {k} with words, and marks!" * (k % 9) for k in range(120)]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)] + [(None, "no id", 0)], "doc_id bigint, text string, ids int").repartition(3)
    rows = packing.pack(df, PATH, open_windows=4, merge_partitions=2).collect()
    t = Tokenizer.from_file(PATH)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for k, text in [*enumerate(texts), (None, "no id")]:
        want = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(by_doc[k], key=lambda r: r["start"])
        assert [i for r in own for i in np.frombuffer(r["ids"], "<u4").tolist()] == want
        assert all(r["doc_tokens"] == len(want) and r["length"] == len(r["ids"]) // 4 for r in own)
    pad = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        pad += 0 if at & (at - 1) == 0 else 2048 - at
    assert pad / sum(r["length"] for r in rows) < 0.01


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), PATH).count() == 0


@pytest.mark.parametrize("cap", [1, 10**6])
def test_table_of_words_is_bounded(cap):
    w = packing.WordIds(PATH, cap_bytes=cap)
    t = Tokenizer.from_file(PATH)
    for text in ("one two three.", "two three. four", "it's 4 o'clock, isn't it?", "x" * 500):
        assert w.encode(text.encode(), block_bytes=8).tolist() == t.encode(text, add_special_tokens=False).ids


def test_table_holds_bytes_whatever_the_words():
    w = packing.WordIds(PATH, cap_bytes=200_000)
    rows = [(k, " ".join(f"{k}x{j}" + "y" * (k % 500) for j in range(50)).encode()) for k in range(200)]
    for _ in packing.encoded(w, rows, block_bytes=20_000):
        assert w.held < 200_000 + 50_000 + 200 * 20_000 / 4


def test_long_text_is_taken_in_blocks(spark):
    text = " ".join(f"w{k % 997} and, so" for k in range(60_000))
    t = Tokenizer.from_file(PATH)
    want = [*t.encode(text, add_special_tokens=False).ids, 1]
    rows = packing.pack(spark.createDataFrame([(1, text), (2, "short")], "doc_id bigint, text string"), PATH).filter("doc_id = 1").orderBy("start").collect()
    assert [i for r in rows for i in np.frombuffer(r["ids"], "<u4").tolist()] == want


def test_pieces_of_random_mixtures():
    r = random.Random(5)
    parts = ["a", "Z", "don't", "'", "<", "|", ">", "<|endoftext|>", "é", "É", "×", "÷", "ß", "ÿ", "Ā", "ÃÃ", "0", "42", "²", ".", ",!", "_", "-", "\x00", "\x1c", "\x7f", "\x85", "\xa0", "\u0301", "Σ", "İ", "中", "🙂", " ", " ", "\n", "\t\x0b", "\u2003"]
    texts = ["".join(r.choices(parts, k=r.randrange(30))) for _ in range(3000)]
    w, t = packing.WordIds(PATH, cap_bytes=100_000), Tokenizer.from_file(PATH)
    for (k, ids), text in zip(packing.encoded(w, ((k, x.encode()) for k, x in enumerate(texts)), block_bytes=5_000), texts, strict=True):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, (k, text)


def test_table_keeps_many_words():
    """Each piece is encoded once, with or without a mark after it, while a table of 4 MB has room for 40,000."""
    w, n = packing.WordIds(PATH, cap_bytes=4_000_000), []
    learn = w.learn
    w.learn = lambda words, *more: (n.append(len(words)), learn(words, *more))
    words = ["".join("abcdefghij"[int(c)] for c in str(k)) for k in range(40_000)]
    for mark in (" ", ", ", ". "):
        w.encode(mark.join(words).encode(), block_bytes=50_000)
    assert sum(n) == 40_000 + 2


def test_text_for_another_vocabulary_is_cut_at_white_space():
    w = packing.WordIds(PATH)
    assert w.kinds is packing._KINDS
    x = np.frombuffer(b"so, 12 it's", np.uint8)
    assert [x[b : b + n].tobytes() for b, n in zip(*packing.cut(x)[:2], strict=True)] == [b"so", b",", b"1", b"2", b"it's"]
    assert [x[b : b + n].tobytes() for b, n in zip(*packing.cut(x, packing._WORDS)[:2], strict=True)] == [b"so,", b"12", b"it's"]
    w.kinds = packing._WORDS
    assert w.encode(b"so, 12 it's").tolist() == w.tokenizer.encode("so, 12 it's", add_special_tokens=False).ids


def test_pieces_of_one_hash_keep_their_own_ids(monkeypatch):
    monkeypatch.setattr(packing, "hash", len, raising=False)
    w, t = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    for text in ("one two three four", "two one seven, three", "four five six seven"):
        assert w.encode(text.encode()).tolist() == t.encode(text, add_special_tokens=False).ids
