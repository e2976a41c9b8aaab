"""Language identification by a bidirectional gated recurrent network over bytes.

Two recurrences with gates, one in either direction, read the bytes of a
segment; a softmax over both states labels every byte position, white space
included, and a document's probabilities are the mean over all its positions.
Segments are runs of `segment` bytes of the text, lower-cased in A-Z; the state
runs through words and white space and starts anew only where a segment does.

Training is backpropagation through time in numpy on the driver, over a bounded
sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UND = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class ByteGRU:
    """Weights: w[d] embeds bytes into the three gates of direction d, u[d] is recurrent, out and bias label positions."""

    langs: list[str]
    w: list[np.ndarray]
    u: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    segment: int = 128

    @property
    def hidden(self) -> int:
        return self.u[0].shape[0]

    def forward(self, codes: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Probabilities (position, row, language) for byte codes (position, row); masked positions leave the state as it is."""
        steps, rows = codes.shape
        h, states, traces = self.hidden, [], []
        for d in (0, 1):
            state, all_states, trace = np.zeros((rows, h), np.float32), np.empty((steps, rows, h), np.float32), []
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x = self.w[d][codes[t]]
                zr = _sigmoid(x[:, : 2 * h] + state @ self.u[d][:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h :] + (r * state) @ self.u[d][:, 2 * h :])
                new = state + (mask[t][:, None] * z) * (c - state)
                if keep:
                    trace.append((t, state, z, r, c))
                state = all_states[t] = new
            states.append(all_states)
            traces.append(trace)
        both = np.concatenate(states, axis=2)
        logits = both @ self.out + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        return (p, both, traces) if keep else p

    def gradients(self, codes, mask, labels, weights):
        """Loss and gradients of the weighted cross entropy over all positions, by backpropagation through time."""
        p, both, traces = self.forward(codes, mask, keep=True)
        steps, rows = codes.shape
        h, share = self.hidden, (mask * weights[None, :]).astype(np.float32)
        share /= share.sum()
        loss = -(share * np.log(p[:, np.arange(rows), labels] + 1e-9)).sum()
        d_logits = p * share[:, :, None]
        d_logits[:, np.arange(rows), labels] -= share
        grads = {"out": np.tensordot(both, d_logits, ((0, 1), (0, 1))), "bias": d_logits.sum((0, 1))}
        d_both = d_logits @ self.out.T
        for d in (0, 1):
            gw, gu, carry = np.zeros_like(self.w[d]), np.zeros_like(self.u[d]), np.zeros((rows, h), np.float32)
            for t, state, z, r, c in reversed(traces[d]):
                up = carry + d_both[t][:, d * h : (d + 1) * h]
                m = mask[t][:, None]
                d_c = up * m * z * (1 - c * c)
                d_rs = d_c @ self.u[d][:, 2 * h :].T
                d_zr = np.concatenate([up * m * (c - state) * z * (1 - z), d_rs * state * r * (1 - r)], axis=1)
                carry = up * (1 - m * z) + d_rs * r + d_zr @ self.u[d][:, : 2 * h].T
                gu[:, : 2 * h] += state.T @ d_zr
                gu[:, 2 * h :] += (r * state).T @ d_c
                np.add.at(gw, codes[t], np.concatenate([d_zr, d_c], axis=1))
            grads[f"w{d}"], grads[f"u{d}"] = gw, gu
        return loss, grads

    def sums(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each column of codes (position, row) the sum of its first `length` positions' probabilities.

        The same network as forward(), laid out feature by row, which numpy runs
        faster, with the halves of the logistic function folded into the weights.
        """
        steps, rows = codes.shape
        h, half = self.hidden, np.float32(0.5)
        states = np.empty((steps, 2 * h, rows), np.float32)
        short = lengths.min(initial=steps)
        for d in (0, 1):
            w_gates, w_new = np.ascontiguousarray(self.w[d][:, : 2 * h].T) * half, np.ascontiguousarray(self.w[d][:, 2 * h :].T)
            u_gates, u_new = np.ascontiguousarray(self.u[d][:, : 2 * h].T) * half, np.ascontiguousarray(self.u[d][:, 2 * h :].T)
            state, gates, new = np.zeros((h, rows), np.float32), np.empty((2 * h, rows), np.float32), np.empty((h, rows), np.float32)
            x_gates, x_new, reset = np.empty_like(gates), np.empty_like(new), np.empty_like(new)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                np.matmul(u_gates, state, out=gates)
                gates += np.take(w_gates, codes[t], axis=1, out=x_gates, mode="clip")
                np.tanh(gates, out=gates)
                gates *= half
                gates += half
                np.matmul(u_new, np.multiply(gates[h:], state, out=reset), out=new)
                new += np.take(w_new, codes[t], axis=1, out=x_new, mode="clip")
                np.tanh(new, out=new)
                new -= state
                new *= gates[:h]
                if t >= short:
                    new *= t < lengths
                state += new
                states[t, d * h : (d + 1) * h] = state
        p = np.matmul(np.ascontiguousarray(self.out.T), states)
        p += self.bias[:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        if short < steps:
            p *= (np.arange(steps)[:, None] < lengths)[:, None, :]
        return p.sum(axis=0, dtype=np.float64).T

    def probabilities(self, texts: list[bytes], rows: int = 2048) -> np.ndarray:
        """One row of language probabilities for each text; alike for all languages where a text is empty."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        out = np.zeros((len(texts), len(self.langs)))
        flat = np.frombuffer(b"".join(texts).lower(), np.uint8)
        n_whole, rest = sizes // self.segment, sizes % self.segment
        begin = np.cumsum(sizes) - sizes
        # whole segments, then the ends of texts in the order of their lengths
        owner = np.repeat(np.arange(len(texts)), n_whole)
        at = begin[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n_whole) - n_whole, n_whole)) * self.segment
        ends = np.flatnonzero(rest)
        ends = ends[np.argsort(rest[ends], kind="stable")]
        owner = np.concatenate([owner, ends])
        at = np.concatenate([at, begin[ends] + n_whole[ends] * self.segment])
        length = np.concatenate([np.full(len(owner) - len(ends), self.segment), rest[ends]])
        for lo in range(0, len(owner), rows):
            own, size = at[lo : lo + rows], length[lo : lo + rows]
            where = own[None, :] + np.arange(size.max())[:, None]
            np.add.at(out, owner[lo : lo + rows], self.sums(flat[np.minimum(where, len(flat) - 1)], size))
        return np.where(sizes[:, None] > 0, out / np.maximum(1, sizes)[:, None], 1 / len(self.langs))


def pad(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes (position, row), filled up with zeros, and the mask of what is not filling."""
    longest = max(map(len, words))
    codes = np.frombuffer(b"".join(x.ljust(longest, b"\0") for x in words), np.uint8).reshape(len(words), longest).T
    return np.ascontiguousarray(codes), (np.arange(longest)[:, None] < np.array([len(x) for x in words])[None, :]).astype(np.float32)


def fit(segments: list[bytes], labels: list[str], hidden: int = 8, segment: int = 128, updates: int = 160, batch: int = 256, rate: float = 0.02, seed: int = 7) -> ByteGRU:
    """A network for the languages among labels; each language weighs alike. Adam with a falling rate, deterministic for one seed.

    The number of updates is the same for a small sample, which is gone through more often.
    """
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    net = ByteGRU(
        langs,
        [rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32) for _ in (0, 1)],
        [rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32) for _ in (0, 1)],
        rng.normal(0, 0.2, (2 * hidden, len(langs))).astype(np.float32),
        np.zeros(len(langs), np.float32),
        segment,
    )
    y = np.array([langs.index(x) for x in labels])
    per_class = (len(y) / (len(langs) * np.maximum(1, np.bincount(y, minlength=len(langs))))).astype(np.float32)
    at, moments = 0, {}
    while at < updates:
        order = rng.permutation(len(segments))
        for lo in range(0, len(order), batch)[: updates - at]:
            k = order[lo : lo + batch]
            codes, mask = pad([segments[i] for i in k])
            _, grads = net.gradients(codes, mask, y[k], per_class[y[k]])
            step = rate * 0.5 ** (4 * at / updates)
            at += 1
            held = {"out": net.out, "bias": net.bias, "w0": net.w[0], "w1": net.w[1], "u0": net.u[0], "u1": net.u[1]}
            for name, g in grads.items():
                g = np.clip(g, -1, 1)
                m, v = moments.get(name, (0, 0))
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                moments[name] = m, v
                held[name] -= (step * (m / (1 - 0.9**at)) / (np.sqrt(v / (1 - 0.999**at)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's digits leaves 2 modulo 4; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_segments(documents: DataFrame, max_docs: int = 2400, max_segments: int = 9600, segment: int = 64, seed: int = 7) -> tuple[list[bytes], list[str]]:
    """A bounded sample for fit(): about max_docs documents by the hash of their ids, an equal number of each language where there are as many, and about max_segments segments of them, at most 64 of one, at places drawn over the whole text.

    Only rows with a text and a language take part, and none that is held out.
    """
    known = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    n = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("lang").alias("n")).collect()}
    if not n:
        return [], []
    per_doc = max(1, min(64, max_segments // min(max_docs, sum(n.values()))))
    cut = reduce(lambda c, lang: c.when(F.col("lang") == lang, int(min(1.0, max_docs / len(n) / n[lang]) * 2**31)), sorted(n), F)

    def draw(batches):
        for b in batches:
            segments, langs = [], []
            for doc, lang, text in zip(b.column(0), b.column(1), b.column(2), strict=True):
                own = text.as_py().lower()
                rng = np.random.default_rng([seed, abs(doc.as_py() or 0)])
                for at in rng.integers(0, max(1, len(own) - segment + 1), per_doc if own else 0):
                    segments.append(own[at : at + segment])
                    langs.append(lang.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(segments, pa.binary()), pa.array(langs, pa.string())], ["segment", "lang"])

    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < cut).select(F.col("doc_id").cast("bigint"), "lang", F.col("text").cast("binary"))
    rows = sample.mapInArrow(draw, "segment binary, lang string").toArrow().sort_by([("lang", "ascending"), ("segment", "ascending")])
    return rows.column(0).to_pylist(), rows.column(1).to_pylist()


def _labels(net: ByteGRU | None, texts: list[bytes | None]) -> pa.StructArray:
    known = [x is not None and any(map(str.isalpha, x.decode())) for x in texts]
    langs, scores = [UND] * len(texts), [0.0] * len(texts)
    some = [k for k, x in enumerate(known) if x and net]
    if some:
        p = net.probabilities([texts[k] for k in some])
        for k, row in zip(some, p, strict=True):
            langs[k], scores[k] = net.langs[row.argmax()], round(float(min(1.0, row.max())), 6)
    return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])


def label_texts(net: ByteGRU | None, block_bytes: int = 262_144):
    """An Arrow UDF from a binary text to a struct of lang and score, a block of texts at a time."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            done, texts, held = [], [], 0
            for x in array:
                texts.append(x.as_py())
                held += len(texts[-1] or b"")
                if held >= block_bytes:
                    done.append(_labels(net, texts))
                    texts, held = [], 0
            done.append(_labels(net, texts))
            yield pa.concat_arrays(done)

    # not deterministic to the planner, which would else call it once in a filter and once more in the result
    return F.arrow_udf(run, "struct<lang:string,score:double>").asNondeterministic()


def identify(documents: DataFrame, net: ByteGRU | None, keep: list[str] | None = None) -> DataFrame:
    """row (a struct of the columns in keep, by default all), lang_pred and score for every row of documents.

    A text that is null or has no letter, and every text where no language was
    learned, is `und` with score 0. Null ids stay null, repeated rows give
    repeated results; other columns, whatever their names, pass in the struct.
    Only texts go to Python, and only labels come back.
    """
    found = documents.select(F.struct(*(keep or documents.columns)).alias("row"), label_texts(net)(F.col("text").cast("binary")).alias("found"))
    return found.select("row", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def train(documents: DataFrame, max_docs: int = 2400, **options) -> ByteGRU | None:
    """The network for the languages found in documents, or None where nothing is labelled."""
    segments, langs = training_segments(documents, max_docs)
    return fit(segments, langs, **options) if segments else None
