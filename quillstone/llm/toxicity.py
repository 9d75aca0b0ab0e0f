"""Toxicity: a bidirectional GRU with attention pooling over character and word inputs, in numpy.

Texts are cut into overlapping windows of WINDOW words, every STRIDE words. A word's input is a
hashed word embedding beside the mean of its hashed character n-gram embeddings. The text's score is
that of its worst window; training sends the gradient through that window alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import set_batches
from quillstone.llm.labelled import Parameters, held_out, trained, training_rows
from quillstone.llm.textops import U, mix, text_slices, word_spans, powers

WINDOW, STRIDE = 48, 36
WORD_BITS, CHAR_BITS = 15, 16
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 12, 12, 8
GRAMS = (3, 5)
#: Training rows of either label at most, and the bytes of their texts.
EACH, MOST_BYTES = 3_000, 1 << 12
EPOCHS, BATCH, RATE = 5, 64, 0.01
THRESHOLD = 0.5
#: Training texts that have to hold a word or n-gram for its bucket to have an embedding at the start, and the scale of its evidence in it.
LEAST_TEXTS, EVIDENCE = 3, 0.3
#: Windows that go through the network at once.
LANES = 2_048

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += U(32)
_TABLE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
_TABLE = _TABLE[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


class Words:
    """The distinct words among some spans: bucket of the word, buckets of its character n-grams."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        lo = int(starts[0]) if len(starts) else 0
        hi = int(ends[-1]) if len(ends) else 0
        c = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_TABLE[data[lo:hi]] * powers(hi - lo, _BASE), out=c[1:])
        h = mix((c[ends - lo] - c[starts - lo]) * powers(hi - lo + 1, _INVERSE)[starts - lo] + U(1))
        _, first, self.index = np.unique(h, return_index=True, return_inverse=True)
        self.bucket = (h[first] >> U(64 - WORD_BITS)).astype(np.int64)
        size = ends[first] - starts[first]
        # the distinct words' bytes one after the other, each with a zero byte on both sides
        begin = np.r_[0, np.cumsum(size + 2)]
        source = np.arange(begin[-1]) - np.repeat(begin[:-1], size + 2) - 1
        inside = (source >= 0) & (source < np.repeat(size, size + 2))
        code = np.zeros(begin[-1], np.uint64)
        code[inside] = _TABLE[data[(np.repeat(starts[first], size + 2) + source)[inside]]]
        owner = np.repeat(np.arange(len(first)), size + 2)
        keys, owners = [], []
        for g in GRAMS:
            if len(code) >= g:
                acc = np.full(len(code) - g + 1, g, np.uint64)
                for j in range(g):
                    acc = acc * U(_BASE) + code[j : len(code) - g + 1 + j]
                whole = owner[: len(acc)] == owner[g - 1 :]
                keys.append(mix(acc[whole]) >> U(64 - CHAR_BITS))
                owners.append(owner[: len(acc)][whole])
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        self.owner = owner[order]
        self.gram = np.concatenate(keys)[order].astype(np.int64) if keys else np.zeros(0, np.int64)
        self.first_gram = np.searchsorted(self.owner, np.arange(len(first)))
        self.n_grams = np.bincount(self.owner, minlength=len(first)).astype(np.float32)


def windows_of(rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and row of every window, given each word's row in order."""
    count = np.bincount(rows, minlength=n_rows)
    first = np.r_[0, np.cumsum(count)][:-1]
    n = np.where(count > 0, 1 + -(-np.maximum(count - WINDOW, 0) // STRIDE), 0)
    row = np.repeat(np.arange(n_rows), n)
    nth = np.arange(len(row)) - np.repeat(np.r_[0, np.cumsum(n)][:-1], n)
    return first[row] + nth * STRIDE, np.minimum(WINDOW, count[row] - nth * STRIDE), row


class Network:
    """Parameters by name; scoring and training of windows of words."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        put = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        d = WORD_DIM + CHAR_DIM
        self.p = {
            "word": put(1 << WORD_BITS, WORD_DIM, scale=0.1),
            "char": put(1 << CHAR_BITS, CHAR_DIM, scale=0.3),
            "wf": put(d, 3 * HIDDEN, scale=d**-0.5), "bf": np.zeros(3 * HIDDEN, np.float32), "uf": put(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "wb": put(d, 3 * HIDDEN, scale=d**-0.5), "bb": np.zeros(3 * HIDDEN, np.float32), "ub": put(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "a": put(2 * HIDDEN, ATTENTION, scale=0.3), "v": put(ATTENTION, scale=0.3),
            "o": put(2 * HIDDEN, scale=0.3), "c": np.zeros(1, np.float32),
        }

    def inputs(self, words: Words) -> np.ndarray:
        char = np.add.reduceat(self.p["char"][words.gram], words.first_gram, axis=0) / words.n_grams[:, None]
        return np.concatenate([self.p["word"][words.bucket], char], axis=1)

    def _run(self, x: np.ndarray, index: np.ndarray, mask: np.ndarray, way: str, keep: list | None) -> list[np.ndarray]:
        """Hidden states by step in one direction. x: distinct words' projections; index: (steps, lanes)."""
        u = self.p["u" + way]
        h = np.zeros((index.shape[1], HIDDEN), np.float32)
        out: list = [None] * len(index)
        for t in range(len(index)) if way == "f" else range(len(index) - 1, -1, -1):
            xt, hu = x[index[t]], h @ u
            zr = _sigmoid(xt[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(xt[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            m = mask[t][:, None]
            new = h + m * (1 - z) * (n - h)
            if keep is not None:
                keep.append((t, h, z, r, n, hu[:, 2 * HIDDEN :], m))
            out[t] = h = new
        return out

    def forward(self, words: Words, index: np.ndarray, mask: np.ndarray, cache: dict | None = None) -> np.ndarray:
        """Logits of the lanes. index: distinct word by (step, lane); mask: 1 where the lane has a word."""
        e = self.inputs(words)
        kept = {w: [] if cache is not None else None for w in "fb"}
        states = {w: self._run(e @ self.p["w" + w] + self.p["b" + w], index, mask, w, kept[w]) for w in "fb"}
        h = np.concatenate([np.stack(states["f"]), np.stack(states["b"])], axis=2)
        g = np.tanh(h @ self.p["a"])
        s = g @ self.p["v"] + (mask - 1) * np.float32(1e4)
        s = np.exp(s - s.max(axis=0))
        alpha = s / s.sum(axis=0)
        ctx = (alpha[:, :, None] * h).sum(axis=0)
        if cache is not None:
            cache |= {"e": e, "kept": kept, "h": h, "g": g, "alpha": alpha, "ctx": ctx}
        return ctx @ self.p["o"] + self.p["c"][0]

    def gradients(self, words: Words, index: np.ndarray, cache: dict, d_logit: np.ndarray) -> dict[str, np.ndarray]:
        p, (h, g, alpha, ctx, e) = self.p, (cache[k] for k in ("h", "g", "alpha", "ctx", "e"))
        out = {"o": ctx.T @ d_logit, "c": np.array([d_logit.sum()], np.float32)}
        d_ctx = d_logit[:, None] * p["o"]
        d_alpha = (d_ctx[None] * h).sum(axis=2)
        d_s = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        out["v"] = np.tensordot(d_s, g, axes=([0, 1], [0, 1]))
        d_g = d_s[:, :, None] * p["v"] * (1 - g * g)
        out["a"] = np.tensordot(h, d_g, axes=([0, 1], [0, 1]))
        d_h = alpha[:, :, None] * d_ctx[None] + d_g @ p["a"].T
        d_e = np.zeros_like(e)
        for w, part in (("f", d_h[:, :, :HIDDEN]), ("b", d_h[:, :, HIDDEN:])):
            u, d_u, d_x = p["u" + w], np.zeros_like(p["u" + w]), np.zeros((len(e), 3 * HIDDEN), np.float32)
            back = np.zeros_like(part[0])
            for t, before, z, r, n, hn, m in reversed(cache["kept"][w]):
                d = part[t] + back
                dn = d * m * (1 - z) * (1 - n * n)
                dz = -d * m * (n - before) * z * (1 - z)
                dr = dn * hn * r * (1 - r)
                d_hu = np.concatenate([dz, dr, dn * r], axis=1)
                np.add.at(d_x, index[t], np.concatenate([dz, dr, dn], axis=1))
                d_u += before.T @ d_hu
                back = d * (1 - m * (1 - z)) + d_hu @ u.T
            out["u" + w], out["w" + w], out["b" + w] = d_u, e.T @ d_x, d_x.sum(axis=0)
            d_e += d_x @ p["w" + w].T
        out["word"], out["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(out["word"], words.bucket, d_e[:, :WORD_DIM])
        np.add.at(out["char"], words.gram, (d_e[:, WORD_DIM:] / words.n_grams[:, None])[words.owner])
        return out

    def window_logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Logit and row of every window of the texts, and where the windows lie."""
        starts, ends, rows = word_spans(data, offsets)
        first, size, row = windows_of(rows, len(offsets) - 1)
        logits = np.zeros(len(first), np.float32)
        for i in range(0, len(first), LANES):
            logits[i : i + LANES] = self.forward(*lanes(data, starts, ends, first[i : i + LANES], size[i : i + LANES]))
        return logits, row, (starts, ends, first, size)


def lanes(data, starts, ends, first, size) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words, index and mask of forward() for some windows."""
    lo, hi = int(first.min()), int((first + size).max())
    words = Words(data, starts[lo:hi], ends[lo:hi])
    at = np.arange(WINDOW)[:, None]
    return words, words.index[np.minimum(first - lo + at, hi - lo - 1)], (at < size).astype(np.float32)


def _prime(net: Network, raw: list[np.ndarray], labels: np.ndarray) -> None:
    """Starts the first dimension of both embeddings at the z-score of the log-odds between toxic and other
    training texts; what fewer than LEAST_TEXTS texts hold starts at zero."""
    held = {"word": np.zeros((2, 1 << WORD_BITS)), "char": np.zeros((2, 1 << CHAR_BITS))}
    for data, y in zip(raw, labels.astype(int)):
        starts, ends, _ = word_spans(data, np.array([0, len(data)]))
        words = Words(data, starts, ends)
        held["word"][y][np.unique(words.bucket)] += 1
        held["char"][y][np.unique(words.gram)] += 1
    n = [(labels == y).sum() + 1 for y in (0, 1)]
    for k, (clean, toxic) in held.items():
        z = (np.log((toxic + 0.5) / n[1]) - np.log((clean + 0.5) / n[0])) / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
        seen = clean + toxic >= LEAST_TEXTS
        net.p[k][~seen] = 0
        net.p[k][seen, 0] = EVIDENCE * z[seen]


def train(rows: list[tuple[str, int]], seed: int = 3) -> Network:
    """Adam on the logistic loss of each text's worst window. Without texts of both labels: as initialised, bias -2."""
    net = Network(seed)
    rows = [(t, y) for t, y in rows if t.strip()]
    labels = np.array([y for _, y in rows], np.float32)
    if len(set(labels.tolist())) < 2:
        net.p["c"][0] = -2
        return net
    raw = [np.frombuffer(t.encode(), np.uint8) for t, _ in rows]
    _prime(net, raw, labels)
    rng = np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in net.p.items()} for _ in range(2))
    sides = [np.flatnonzero(labels == y) for y in (0, 1)]
    sizes = np.array([len(x) for x in raw])
    seen = np.zeros(len(rows))  # each text's last logit
    step = 0
    for epoch in range(EPOCHS):
        # texts of about one window first: with them the label belongs to the window
        pools = [s[np.argsort(sizes[s], kind="stable")][: max(BATCH, len(s) // 3)] if epoch < 2 else s for s in sides]
        for _ in range(max(30, 2 * max(map(len, sides)) // BATCH)):
            pick = np.concatenate([rng.choice(s, BATCH // 2) for s in pools])
            if epoch >= 2:  # half of the clean texts are those that are nearest to a mistake
                clean = sides[0]
                hard = clean[np.argsort(-seen[clean], kind="stable")[: max(BATCH, len(clean) // 20)]]
                pick[: BATCH // 4] = rng.choice(hard, BATCH // 4)
            data, offsets = np.concatenate([raw[k] for k in pick]), np.r_[0, np.cumsum(sizes[pick])]
            logits, row, (starts, ends, first, size) = net.window_logits(data, offsets)
            order = np.lexsort((logits, row))
            worst = order[np.r_[row[order][1:] != row[order][:-1], True]]
            y = labels[pick][row[worst]]
            words, index, mask = lanes(data, starts, ends, first[worst], size[worst])
            cache: dict = {}
            z = net.forward(words, index, mask, cache)
            seen[pick[row[worst]]] = z
            grad = net.gradients(words, index, cache, ((_sigmoid(z) - y) / len(y)).astype(np.float32))
            step += 1
            for k, g in grad.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                net.p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


def fit_toxicity(docs: DataFrame, labels: DataFrame, each: int = EACH, most_bytes: int = MOST_BYTES, path: str | None = None) -> Parameters:
    """The model of score_toxicity(), trained on at most `each` rows of either label outside the held-out fold (see
    training_rows) and written to path, if given, from where labelled.load() reads it."""
    return trained(training_rows(docs, labels, "toxic", each, most_bytes), lambda rows: train(rows).p, path)


def score_toxicity(docs: DataFrame, labels: DataFrame | None, each: int = EACH, most_bytes: int = MOST_BYTES, model: Parameters | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, score, predicted.

    labels: doc_id, toxic. Only the text is scored, in all its windows, by `model` or, without one,
    by fit_toxicity(); the parameters, of fixed size, are broadcast. Null texts and texts without
    words score 0. Equal texts have equal scores; repeated rows each get their row. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    set_batches(spark)
    shared = spark.sparkContext.broadcast(model or fit_toxicity(docs, labels, each, most_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.__new__(Network)
        net.p = shared.value
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(1)):
                logits, row, _ = net.window_logits(data, offsets)
                worst = np.full(j - i, -np.inf)
                np.maximum.at(worst, row, logits)
                score = 1 / (1 + np.exp(-np.maximum(worst, -700)))
                score[np.isinf(worst)] = 0.0
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(score)], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
