"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from driftscan.llm import bpe, queries

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\x00\x01 a", "Hello, World's 123", "ΟΔΟΣ Σ", "İstanbul", "a<|startoftext|>b <|ENDOFTEXT|> <|endoftext|>", "é ö", "́́ x", "x​y z w", "日本語 👍🏽 ½ ²", "don't I'LL ''s 's't", "a\x1cb\x1fc", "\x85q\x85", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "     trailing   \n\n  ", "ﷺ ﬁ", "각 각"]


def sample(rng: random.Random) -> str:
    kinds = ["abcdefgh THE ing", "éèüßñçÀÈ", "0123456789", "!?.,;:'\"-_<>|", " \t\n\r 　\x1c\x85", "абвгжΣσς日本語한국", "़̧̀́", "👍🏽👩‍👩‍👧🇩🇪"]
    return "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(80)))


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_and_text_are_the_library_s(path):
    want, got, rng = Tokenizer.from_file(path), bpe.BytePairs(path), random.Random(7)
    for text in [*ODD, *(sample(rng) for _ in range(3000))]:
        ids = want.encode(text, add_special_tokens=False).ids
        assert got.encode(text.encode()).tolist() == ids, text
        assert got.decode(ids) == want.decode(ids, skip_special_tokens=False), text
        assert got.encode(text.encode(), 3).tolist() == ids, text


def test_every_letter_as_in_the_library():
    want, got = Tokenizer.from_file(WORDS), bpe.BytePairs(WORDS)
    for first in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}b " for c in range(first, first + 64) if not 0xD800 <= c < 0xE000 and bpe.unicodedata.category(chr(c)) != "Cn")
        assert got.encode(text.encode()).tolist() == want.encode(text, add_special_tokens=False).ids, hex(first)


def test_a_full_table_and_long_pieces_change_nothing():
    want, got, rng = Tokenizer.from_file(WORDS), bpe.BytePairs(WORDS, 2000), random.Random(3)
    for _ in range(50):
        text = " ".join(sample(rng) for _ in range(5))
        assert got.encode(text.encode()).tolist() == want.encode(text, add_special_tokens=False).ids
        assert got.held < 60_000
    one = "abcdefghij" * 30_000
    assert got.encode(one.encode()).tolist() == want.encode(one, add_special_tokens=False).ids
    got.encode(b"b")
    assert one not in got.table and got.held < 1000


def test_a_very_long_text_goes_in_blocks():
    got, text = bpe.BytePairs(WORDS), "word and another one. " * 200_000
    assert got.encode(text.encode()).tolist() == got.encode(b"word and another one. ").tolist() * 200_000


def test_query(spark, sf):
    tokenizer = Tokenizer.from_file(WORDS)
    rows = {r["doc_id"]: r for r in queries.op12_bpe(spark, sf).collect()}
    given = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(given)
    for d in given:
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids
        r = rows[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_empty_tables_and_clashing_names(spark):
    rows = spark.createDataFrame([(1, None, [1], "x"), (None, "a b", None, "y"), (None, "a b", None, "y"), (2, "", [2], None)], "doc_id long, text string, ids array<int>, out string")
    got = bpe.encode(rows, WORDS)
    by = [(r["row"]["doc_id"], r["row"]["out"], r["ids"]) for r in got.collect()]
    assert sorted(by, key=str) == sorted([(1, "x", []), (None, "y", [320, 321]), (None, "y", [320, 321]), (2, None, [])], key=str)
    back = bpe.decode(got, WORDS).select("row.row.doc_id", "decoded").collect()
    assert sorted(r["decoded"] for r in back) == ["", "", "a</w> b</w>", "a</w> b</w>"]
    odd = spark.createDataFrame([(None,), ([320, None, -1, 99999, 49407],)], "ids array<int>")
    assert sorted(r["decoded"] for r in bpe.decode(odd, WORDS).collect()) == ["", "a</w> <|endoftext|>"]
    assert bpe.encode(rows.limit(0), WORDS, keep=["doc_id"]).count() == 0
    assert bpe.encode(rows, WORDS, keep=["doc_id"]).select("row.*", F.size("ids").alias("n")).columns == ["doc_id", "n"]
