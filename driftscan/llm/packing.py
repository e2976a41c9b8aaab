"""Bounded-space online packing of tokenized documents into fixed windows.

Each partition keeps at most `open_windows` windows open. A document's ids are
cut at whole windows; the rest is placed into the open window that it fills
best. When it fits none and no more window may be opened, the fullest is topped
up with the head of the piece and emitted. What is left open at the end of a
partition is carried, ids and all, to a second step that merges the leftovers
of `merge_partitions` partitions at a time: bounded work for any input size.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftscan.llm.texts import blocks
from driftscan.session import materialize

PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, leftover bigint"
_TYPES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("leftover", pa.int64())])


#: Kinds of bytes: letters, digits and marks are cut as the vocabulary's pre-tokenizer does; a word with any other byte stays whole.
_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
_WORDS = np.full(256, _OTHER, np.uint8)
_WORDS[list(b" \t\n\r\x0b\x0c")] = _SPACE
_KINDS = _WORDS.copy()
_KINDS[33:127] = _MARK
_KINDS[list(b"abcdefghijklmnopqrstuvwxyz\xc3")] = _LETTER
_KINDS[list(b"0123456789")] = _DIGIT
_KINDS[list(b"'<")] = _OTHER  # short forms, and what special tokens begin with
#: How the vocabulary for which _KINDS are made normalises and cuts; texts for any other are cut at white space alone.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_CUTTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, … of each span, size of them, one span after another."""
    at = np.repeat((begin - np.cumsum(size) + size).astype(np.int32), size)
    at += np.arange(len(at), dtype=np.int32)
    return at


def cut(x: np.ndarray, kinds: np.ndarray = _KINDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the pieces of a lower-cased text's bytes begin, their length, and which are words that stay whole.

    Pieces are runs of letters (of Latin-1), single digits and runs of marks.
    """
    kind = kinds[x]
    after = np.flatnonzero(x[:-1] == 0xC3) + 1
    second = x[after]
    kind[after[(kind[after] == _OTHER) & (second < 0xC0) & (second != 0x97) & (second != 0xB7) & (kinds[0xC3] == _LETTER)]] = _LETTER  # but the signs of times and division
    if (kind == _OTHER).any():
        edge = np.diff(kind != _SPACE, prepend=False, append=False).nonzero()[0]
        begin, stop = edge[::2], edge[1::2]
        odd = np.logical_or.reduceat(kind == _OTHER, begin)
        kind[_spread(begin[odd], (stop - begin)[odd])] = _OTHER
    begin = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)])[: len(x)])
    size, first = np.diff(begin, append=len(x)), kind[begin]
    return begin[first != _SPACE], size[first != _SPACE], first[first != _SPACE] == _OTHER


class WordIds:
    """Ids of a text's pieces, each computed once while it stays in a table of about cap_bytes.

    The vocabulary lower-cases and its pre-tokenizer never joins text over white
    space, so a text's ids are those of its pieces in order. Pieces are numbered as
    they come: number k is known[k], and its ids are the size[k] ones of flat from
    begin[k] on. hashes are sorted and number says whose each is; a piece counts as
    known if the bytes are the same, so that equal hashes only cost encoding again.
    """

    def __init__(self, path: str, cap_bytes: int = 48_000_000):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.cap_bytes = Tokenizer.from_file(path), cap_bytes
        told = [x and json.loads(x.__getstate__()) for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        self.kinds = _KINDS if told == [_NORMALIZER, _CUTTER] else _WORDS
        # what is cut already needs neither composition nor the pattern; the model is the same object
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.normalizer = normalizers.Lowercase()
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.closing = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.closing[[k for x, k in self.tokenizer.get_vocab().items() if x.endswith("</w>")]] = True
        self.reset()

    def reset(self) -> None:
        self.known, self.hashes, self.number = pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    @property
    def held(self) -> int:
        return sum(x.nbytes for x in (self.known, self.hashes, self.number, self.flat, self.begin, self.size))

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number a piece, of pieces that each end with their one closing id."""
        ids = np.array(self.plain.encode_batch_fast([b" ".join(pieces).decode()], add_special_tokens=False)[0].ids, np.uint32)
        close = np.flatnonzero(self.closing[ids])
        if len(close) != len(pieces) or close[-1] != len(ids) - 1:
            return self._each(pieces)
        return ids, np.diff(close, prepend=-1)

    def _each(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def learn(self, pieces: list[bytes], whole: np.ndarray) -> None:
        """Appends ids of pieces; whole are words that the tokenizer has to cut."""
        begin, size = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int32)
        parts, at = [self.flat], len(self.flat)
        for how in (True, False):
            which = np.flatnonzero(whole != how)
            for first in range(0, len(which), 4096):
                k = which[first : first + 4096]
                ids, sizes = (self._together if how else self._each)([pieces[i] for i in k.tolist()])
                size[k], begin[k] = sizes, at + np.cumsum(sizes) - sizes
                parts.append(ids)
                at += len(ids)
        self.flat, self.begin, self.size = np.concatenate(parts), np.concatenate([self.begin, begin]), np.concatenate([self.size, size])

    def numbers(self, pieces: pa.Array, whole: np.ndarray) -> np.ndarray:
        """The numbers of distinct pieces; those that are not in the table are added."""
        values = pieces.to_pylist()
        hashes, number = np.fromiter(map(hash, values), np.int64, len(values)), np.full(len(values), -1, np.int64)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            same = np.flatnonzero(self.hashes[at] == hashes)
            found = self.number[at[same]]
            same_bytes = pc.equal(self.known.take(pa.array(found)), pieces.take(pa.array(same))).to_numpy(zero_copy_only=False)
            number[same[same_bytes]] = found[same_bytes]
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = len(self.known) + np.arange(len(new))
            self.learn([values[i] for i in new.tolist()], whole[new])
            self.known = pa.concat_arrays([self.known, pieces.take(pa.array(new))])
            new = new[np.argsort(hashes[new])]
            at = np.searchsorted(self.hashes, hashes[new])
            self.hashes, self.number = np.insert(self.hashes, at, hashes[new]), np.insert(self.number, at, number[new].astype(np.int32))
        return number

    def ids(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A text's ids in order, where its pieces begin, and how many ids come before each and after all. A full table is emptied first."""
        if self.held > self.cap_bytes:
            self.reset()
        x = np.frombuffer(text.lower(), np.uint8)
        begin, size, whole = cut(x, self.kinds)
        stop = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(stop), pa.py_buffer(x[_WORDS[x] != _SPACE])]).dictionary_encode()
        codes = found.indices.to_numpy()
        odd = np.zeros(len(found.dictionary), bool)
        odd[codes] = whole
        k = self.numbers(found.dictionary, odd)[codes]
        return self.flat[_spread(self.begin[k], self.size[k])], begin, np.concatenate([[0], np.cumsum(self.size[k])])

    def encode(self, text: bytes, block_bytes: int = 1_000_000) -> np.ndarray:
        """All ids of a whole text, block by block."""
        parts = [self.ids(b)[0] for b in blocks(text, block_bytes)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


@lru_cache(maxsize=1)
def word_ids(path: str, cap_bytes: int) -> WordIds:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
    return WordIds(path, cap_bytes)


def encoded(words: WordIds, rows: Iterable[tuple[int | None, bytes]], block_bytes: int = 1_000_000) -> Iterator[tuple[int | None, np.ndarray]]:
    """Document and ids of each row: short texts are looked up together, a long one in blocks."""
    docs, texts, held = [], [], 0

    def flush() -> Iterator[tuple[int | None, np.ndarray]]:
        ids, begin, before = words.ids(b" ".join(texts))
        ends = before[np.searchsorted(begin, np.cumsum([0, *(len(t) + 1 for t in texts)]))].tolist()
        return ((doc, ids[a:b]) for doc, a, b in zip(docs, ends, ends[1:], strict=False))

    for doc, text in rows:
        if held and held + len(text) > block_bytes:
            yield from flush()
            docs, texts, held = [], [], 0
        if len(text) > block_bytes:
            yield doc, words.encode(text, block_bytes)
        else:
            docs.append(doc)
            texts.append(text)
            held += len(text) + 1
    if docs:
        yield from flush()


class Window:
    __slots__ = ("pieces", "used")

    def __init__(self):
        self.pieces, self.used = [], 0

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        self.pieces.append((doc, start, ids, total, self.used))
        self.used += len(ids)


class Packer:
    """The open windows of one partition; full ones are handed to `emit`."""

    def __init__(self, size: int, open_windows: int, min_piece: int, emit):
        self.size, self.limit, self.min_piece, self.emit, self.open = size, open_windows, min_piece, emit, []

    def _close(self, window: Window) -> None:
        self.open.remove(window)
        self.emit(window)

    def place(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids):
            if len(ids) >= self.size:
                whole = Window()
                whole.add(doc, start, ids[: self.size], total)
                self.emit(whole)
                start, ids = start + self.size, ids[self.size :]
                continue
            best = min((w for w in self.open if self.size - w.used >= len(ids)), key=lambda w: self.size - w.used, default=None)
            if best is None and len(self.open) >= self.limit:
                fullest = max(self.open, key=lambda w: w.used)
                gap = self.size - fullest.used
                if gap >= self.min_piece:
                    fullest.add(doc, start, ids[:gap], total)
                    start, ids = start + gap, ids[gap:]
                self._close(fullest)
                continue
            if best is None:
                best = Window()
                self.open.append(best)
            best.add(doc, start, ids, total)
            if best.used == self.size:
                self._close(best)
            return


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _TYPES, strict=True)], schema=_TYPES)


def pack(documents: DataFrame, tokenizer: str, size: int = 2048, open_windows: int = 16, min_piece: int = 8, end_id: int = 1, merge_partitions: int = 64, table_bytes: int = 48_000_000) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    A null text is empty and still has its end id. Null doc_ids and repeated
    rows are packed as documents of their own. Sequences hold at most `size`
    ids; all are full but for gaps under min_piece and, at the very end of each
    merge group, sequences whose length is a power of two. table_bytes bounds each
    worker's table of words: a larger one has fewer words encoded again.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        words, out, made, held = word_ids(tokenizer, table_bytes), [], 0, 0
        # Arrow keeps what it has freed, and a worker goes on to the next task and stage with it
        give_back = pa.default_memory_pool().release_unused

        def emit(window: Window, leftover=None) -> None:
            nonlocal made, held
            key = (part << 32) | made
            made += 1
            held += 4 * window.used + 100 * len(window.pieces)
            out.extend((doc, start, len(ids), ids.astype("<u4").tobytes(), total, key, offset, leftover) for doc, start, ids, total, offset in window.pieces)

        packer = Packer(size, open_windows, min_piece, emit)
        rows = ((doc.as_py(), text.as_py() or b"") for batch in batches for doc, text in zip(batch.column(0), batch.column(1), strict=True))
        for doc, ids in encoded(words, rows):
            ids = np.append(ids, np.uint32(end_id))
            for at in range(0, len(ids), 128 * size):  # of a long document, so much between two batches
                packer.place(doc, at, ids[at : at + 128 * size], len(ids))
                if held >= 1_000_000:
                    yield _table(out)
                    out.clear()
                    held = 0
                    give_back()
        for window in packer.open:
            emit(window, part // merge_partitions)
        if out:
            yield _table(out)
        out.clear()
        give_back()

    def merge(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        """Leftover windows, fullest first, topped up from the emptiest until one is left, which is cut into powers of two."""
        windows: dict[int, list] = {}
        for r in group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            windows.setdefault(r["sequence_id"], []).append((r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]))
        rows, base, made = [], (1 << 62) | (key[0].as_py() << 32), 0

        def emit(pieces: list) -> None:
            nonlocal made
            offset = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids), ids.tobytes(), total, base | made, offset, None))
                offset += len(ids)
            made += 1

        def cut(pieces: list, n: int) -> tuple[list, list]:
            head, rest = [], []
            for doc, start, ids, total in pieces:
                if n >= len(ids):
                    head.append((doc, start, ids, total))
                else:
                    if n:
                        head.append((doc, start, ids[:n], total))
                    rest.append((doc, start + n, ids[n:], total))
                n = max(0, n - len(ids))
            return head, rest

        order = sorted(windows.values(), key=lambda p: -sum(len(x[2]) for x in p))
        while order:
            now = order.pop(0)
            used = sum(len(x[2]) for x in now)
            while used < size and order:
                head, rest = cut(order.pop(), size - used)
                now, used = now + head, used + sum(len(x[2]) for x in head)
                if rest:
                    order.append(rest)
            while used < size and used:
                n = 1 << (used.bit_length() - 1)
                head, now = cut(now, n)
                emit(head)
                used -= n
            if used:
                emit(now)
        return pa.Table.from_batches([_table(rows)])

    pieces = materialize(documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, PIECE_SCHEMA), "pieces")
    merged = pieces.filter("leftover is not null").groupBy("leftover").applyInArrow(merge, PIECE_SCHEMA)
    return pieces.filter("leftover is null").unionByName(merged).drop("leftover")
