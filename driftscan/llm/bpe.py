"""Byte-pair encoding of whole texts, and decoding.

A piece of text becomes a doubly linked list of symbols. A priority queue holds
the merge rank of every adjacent pair; the least is merged, its neighbours'
new pairs are queued, and entries whose pair has changed meanwhile are skipped.
Pieces that recur are looked up in a table bounded by bytes.

The tokenizer file says how texts are normalised and cut and which pairs are
merged; files with other components than these are refused.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftscan.session import ship

# The pattern by which byte-level vocabularies cut texts if the file names none.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What a table entry takes beside its letters and ids.
ENTRY_BYTES = 200
#: The first white space of a run; no piece goes on over one.
_CUT = regex.compile(rb"(?<![ \t-\r])(?<!\xc2[\x85\xa0])(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80)[ \t-\r]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others by 256 and up in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def blocks(text: bytes, size: int) -> Iterator[bytes]:
    """The text in blocks of about size bytes, cut only where a run of white space begins."""
    at = 0
    while at < len(text):
        found = _CUT.search(text, at + size) if at + size < len(text) else None
        stop = found.start() if found else len(text)
        yield text[at:stop]
        at = stop


class BytePairs:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, table_bytes: int = 128_000_000):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix")):
            raise ValueError("unsupported model")
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if len(vocab) > 1 << 20:
            raise ValueError("unsupported size of vocabulary")
        self.ranks = {vocab[a] << 20 | vocab[b]: k for k, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        letters = byte_letters()
        self.inner, self.last = [vocab[c] for c in letters], [vocab[c + self.suffix] for c in letters]
        self.first = [[self.ranks.get(a << 20 | b, -1) for b in self.inner] for a in self.inner]
        special = {x["content"]: x["id"] for x in file.get("added_tokens") or []}
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in file.get("added_tokens") or []):
            raise ValueError("unsupported added token")
        self.special, self.marks = special, regex.compile("|".join(map(regex.escape, special))) if special else None
        self._normal(file.get("normalizer"))
        self._cutting(file.get("pre_tokenizer"))
        self.byte_level = (file.get("decoder") or {}).get("type") == "ByteLevel"
        if file.get("decoder") and not self.byte_level:
            raise ValueError("unsupported decoder")
        names = {k: x for x, k in vocab.items()} | {k: x for x, k in special.items()}
        self.strings = [names.get(k, "") for k in range(max(names) + 1)]
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.table_bytes = table_bytes
        self.reset()

    def reset(self) -> None:
        """Empties the table of pieces, which says where in flat each one's ids lie."""
        self.table: dict[str, int] = {}
        self.flat, self.begin, self.size = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.held = self.n_flat = 0

    def _normal(self, node: dict | None) -> None:
        steps = [] if node is None else node["normalizers"] if node["type"] == "Sequence" else [node]
        self.compose = self.lower = False
        for s in steps:
            if s["type"] == "NFC" and not self.lower:
                self.compose = True
            elif s["type"] == "Lowercase":
                self.lower = True
            elif s != {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}:  # runs of white space are dropped anyway
                raise ValueError(f"unsupported normalizer {s['type']}")
            elif self.lower:
                raise ValueError("unsupported order of normalizers")

    def _cutting(self, node: dict | None) -> None:
        steps = [] if node is None else node["pretokenizers"] if node["type"] == "Sequence" else [node]
        pattern = None
        for s in steps:
            if s["type"] == "Split" and (s["behavior"], s["invert"]) == ("Removed", True):
                pattern = s["pattern"]["Regex"]
            elif s["type"] == "ByteLevel" and not s["add_prefix_space"]:
                pattern = BYTE_LEVEL_PATTERN if s.get("use_regex", True) else pattern
            else:
                raise ValueError(f"unsupported pre-tokenizer {s['type']}")
        if pattern is None:
            raise ValueError("no cutting pattern")
        # white space is Unicode's property, not Python's wider set
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s+(?!\S)", r"\p{White_Space}+(?!\P{White_Space})").replace(r"\s", r"\p{White_Space}"))

    def normalize(self, text: str) -> str:
        if text.isascii():
            return text.lower() if self.lower else text
        if self.compose and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower() if self.lower else text  # letters are lowered one by one, without a final form

    def piece(self, raw: bytes) -> list[int]:
        """The symbols of a piece after all merges, by rank and then from the left."""
        symbols = list(map(self.inner.__getitem__, raw))
        symbols[-1] = self.last[raw[-1]]
        n = len(symbols)
        if n == 1:
            return symbols
        # ranks[k]: rank of symbol k and the one after it as it stands now, -1 for none; an entry of another rank is stale
        first, shift, mask = self.first, n.bit_length(), (1 << n.bit_length()) - 1
        ranks = [first[a][b] for a, b in zip(raw, raw[1:-1], strict=False)]
        rank_of, merged = self.ranks.get, self.merged
        ranks.append(rank_of(symbols[-2] << 20 | symbols[-1], -1))
        queue = [r << shift | k for k, r in enumerate(ranks) if r >= 0]
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            at, rank = entry & mask, entry >> shift
            if ranks[at] != rank:
                continue
            new, right = merged[rank], after[at]
            after[at] = follow = after[right]
            symbols[at], symbols[right] = new, -1
            if follow < n:
                before[follow] = at
                ranks[right] = -1
                ranks[at] = rank = rank_of(new << 20 | symbols[follow], -1)
                if rank >= 0:
                    heappush(queue, rank << shift | at)
            else:
                ranks[at] = -1
            lead = before[at]
            if lead >= 0:
                ranks[lead] = rank = rank_of(symbols[lead] << 20 | new, -1)
                if rank >= 0:
                    heappush(queue, rank << shift | lead)
        return [s for s in symbols if s >= 0]

    def learn(self, pieces: list[str]) -> None:
        """Adds pieces that are not in the table."""
        ids = [self.piece(p.encode()) for p in pieces]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        first, n = len(self.table), len(pieces)
        stop = self.n_flat + int(size.sum())
        while stop > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + n > len(self.size):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        self.flat[self.n_flat : stop] = np.fromiter(chain.from_iterable(ids), np.int32, stop - self.n_flat)
        self.begin[first : first + n], self.size[first : first + n] = self.n_flat + np.cumsum(size) - size, size
        self.table.update(zip(pieces, range(first, first + n), strict=True))
        self.held += ENTRY_BYTES * n + sum(map(len, pieces)) + 4 * (stop - self.n_flat)
        self.n_flat = stop

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text in which no string is special. A full table is emptied first."""
        if self.held > self.table_bytes:
            self.reset()
        pieces = self.pattern.findall(self.normalize(text))
        new = set(pieces).difference(self.table)
        if new:
            self.learn(list(new))
        at = np.fromiter(map(self.table.__getitem__, pieces), np.int64, len(pieces))
        begin, size = self.begin[at], self.size[at]
        return self.flat[np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)]

    def encode(self, text: bytes, block_bytes: int = 1_000_000) -> np.ndarray:
        """Ids of a whole text in UTF-8, block by block."""
        parts: list[np.ndarray] = []
        for block in blocks(text, block_bytes):
            part, at = block.decode("utf-8", "replace"), 0
            for m in self.marks.finditer(part) if self.marks else ():
                parts += [self.plain(part[at : m.start()]), np.array([self.special[m[0]]], np.int32)]
                at = m.end()
            parts.append(self.plain(part[at:] if at else part))
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary's strings in order: one space between them, or, for a byte-level decoder, the bytes they stand for."""
        n = len(self.strings)
        strings = (self.strings[k] for k in ids if 0 <= k < n)
        if not self.byte_level:
            return " ".join(s for s in strings if s)
        return b"".join(bytes(map(self.byte_of.__getitem__, s)) if all(c in self.byte_of for c in s) else s.encode() for s in strings).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def byte_pairs(path: str, table_bytes: int = 128_000_000) -> BytePairs:
    return BytePairs(path, table_bytes)


def _append(batch: pa.RecordBatch, rows: slice, column: pa.Array) -> pa.RecordBatch:
    part = batch.slice(rows.start, rows.stop - rows.start)
    return pa.RecordBatch.from_arrays([*part.columns[:-1], column], [*batch.schema.names[:-1], "out"])


def _mapped(rows: DataFrame, given, out: T.DataType, f, keep: list[str] | None, name: str, most_bytes: int = 4_000_000) -> DataFrame:
    """row (the columns keep, or all) and name: f of each value of the column given, an Arrow array for a list of values.

    Output is handed on whenever about most_bytes of input have been taken, and a long value alone.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in (rows.columns if keep is None else keep)))
    held = rows.select(row.alias("row"), given.alias("given"))
    schema = T.StructType([held.schema["row"], T.StructField("out", out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = _sizes(b.column(1))
            first = 0
            while first < b.num_rows:
                stop = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), most_bytes, "right")))
                yield _append(b, slice(first, stop), f(b.column(1).slice(first, stop - first)))
                first = stop

    return held.mapInArrow(run, schema).withColumnRenamed("out", name)


def _sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    n = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
    return np.asarray(pc.fill_null(n, 0), np.int64) + 16


def encode(documents: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None, table_bytes: int = 128_000_000) -> DataFrame:
    """row (a struct of the columns keep, or of all) and ids, the ids of each whole text by the tokenizer file at this path.

    The result is what the tokenizers library gives without special tokens added,
    truncation or padding; strings of special tokens inside a text are such
    tokens, as there. A null text is an empty one and has no ids. Repeated rows
    and rows with null keys stay as they are; columns of any other names, clashing
    ones as well, stay inside row. An empty table has no rows. table_bytes bounds
    a worker's table of pieces and changes no result.
    """
    ship(documents.sparkSession)

    def f(column: pa.Array) -> pa.Array:
        pairs = byte_pairs(tokenizer, table_bytes)
        ids = [pairs.encode(x.as_py() or b"") for x in column]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))

    return _mapped(documents, F.col(f"`{text}`").cast("binary"), T.ArrayType(T.IntegerType()), f, keep, "ids")


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """row (the columns keep, or all) and decoded, the text of the list of ids; a null list or one without ids is the empty text.

    Special tokens are not skipped; ids that the vocabulary has not, and null ones, are.
    """
    ship(rows.sparkSession)

    def f(column: pa.Array) -> pa.Array:
        pairs = byte_pairs(tokenizer)
        ends, values = column.offsets.to_numpy(), column.values
        if values.null_count or column.null_count:
            return pa.array([pairs.decode([k for k in x.as_py() or [] if k is not None]) for x in column], pa.string())
        flat = values.to_numpy()
        return pa.array([pairs.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)], pa.string())

    return _mapped(rows, F.col(f"`{ids}`").cast("array<int>"), T.StringType(), f, keep, "decoded")
