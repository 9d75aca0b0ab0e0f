"""Quality: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import set_batches
from quillstone.llm.labelled import Parameters, held_out, trained, training_rows
from quillstone.llm.textops import BYTE_TABLE, U, mix, powers, prefix_hash, span_hash, text_slices, word_spans

BITS = 20
#: Training rows of either label at most, and the bytes of their texts.
EACH, MOST_BYTES = 5_000, 1 << 13
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.3, 1.0, 0.02, 1.0
THRESHOLD = 0.3
#: One in so many training rows sets the scores' scale and is not trained on.
SLICE = 5

#: Bytes by kind: lower-case and other letters, upper case, digits; every other byte stands for itself.
_KIND = np.arange(256)
_KIND[ord("a") : ord("z") + 1] = _KIND[128:] = ord("a")
_KIND[ord("A") : ord("Z") + 1] = ord("A")
_KIND[ord("0") : ord("9") + 1] = ord("0")


def _shape_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's sequence of byte kinds, runs counted once: `Then` and `This` are alike, `THE!!` isn't."""
    kind = _KIND[data]
    new = np.r_[True, kind[1:] != kind[:-1]]
    new[starts] = True
    nth = np.cumsum(new)
    before = np.zeros(len(data), np.int64)
    before[starts] = np.diff(np.r_[0, nth[starts]])
    k = nth - np.cumsum(before)  # the run's number within its word
    step = np.where(new, BYTE_TABLE[kind], U(0)) * powers(len(data) + 1, 0x9E3779B97F4A7C15)[k]
    total = np.r_[U(0), np.cumsum(step)]
    return mix(total[ends] - total[starts] + U(7))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hashed feature and value of the word n-grams of each row.

    Grams: one, two and three words; shapes of one, two and three words; and a word's repetition of
    one of the two before it. A value is the square root of the gram's count over the row's grams other than
    those of two and three words, which thus take no weight from the rest.
    """
    starts, ends, rows = word_spans(data, offsets)
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    word = mix(span_hash(prefix_hash(data), starts, ends) + U(1))
    shape = _shape_hashes(data, starts, ends)
    grams, at, phrases, phrases_at = [word, shape * U(3)], [rows, rows], [], []
    for k in (2, 3):
        if n >= k:
            same = rows[: n - k + 1] == rows[k - 1 :]
            for unit, salt in ((shape, 0), (word, 11)):
                joined = unit[: n - k + 1]
                for j in range(1, k):
                    joined = mix(joined) + unit[j : n - k + 1 + j] * U(k + salt)
                (grams if unit is shape else phrases).append(joined[same])
                (at if unit is shape else phrases_at).append(rows[: n - k + 1][same])
            again = same & (word[: n - k + 1] == word[k - 1 :])
            grams.append(np.full(int(again.sum()), k * 977, np.uint64))
            at.append(rows[: n - k + 1][again])
    total = np.bincount(np.concatenate(at), minlength=len(offsets) - 1)
    row = np.concatenate(at + phrases_at)
    key, count = np.unique(row.astype(np.uint64) << U(BITS) | mix(np.concatenate(grams + phrases)) >> U(64 - BITS), return_counts=True)
    row = (key >> U(BITS)).astype(np.int64)
    return row, (key & U((1 << BITS) - 1)).astype(np.int64), np.sqrt(count / total[row])


def calibration(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logits by which scores are probabilities where both labels weigh the same: logistic regression of one
    variable, by Newton's method, with the two targets drawn in from 0 and 1 as few rows suggest (Platt 1999). (1, 0) if a label has no rows."""
    n = np.array([(labels == v).sum() for v in (0, 1)], np.float64)
    if not n.all():
        return 1.0, 0.0
    target = np.where(labels == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    weight = np.where(labels == 1, 0.5 / n[1], 0.5 / n[0]) * len(labels)
    x, at = np.stack([logits, np.ones(len(logits))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ at))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (weight * (p - target)))
        at = at - np.clip(step, -2, 2)
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def train(rows: list[tuple[str, int]]) -> np.ndarray:
    """Weights, the last one the bias, by per-coordinate FTRL-proximal over shuffled epochs; every SLICE-th row is left
    out of that, and the weights are scaled and shifted by calibration() on those. Without rows: zeros."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS
    examples = []
    for text, label in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        _, index, value = features(data, np.array([0, len(data)]))
        examples.append((np.r_[index, bias].astype(np.int32), np.r_[value, 0.3].astype(np.float32), label))

    def weights(i):
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    rng = np.random.default_rng(11)
    apart = np.arange(len(examples)) % SLICE == SLICE - 1
    for _ in range(EPOCHS):
        for k in rng.permutation(np.flatnonzero(~apart)):
            index, value, label = examples[k]
            w = weights(index)
            g = (1 / (1 + np.exp(-(w @ value))) - label) * value
            sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA
            z[index] += g - sigma * w
            n[index] += g * g
    w = weights(np.arange(bias + 1))
    kept = np.flatnonzero(apart)
    slope, shift = calibration(np.array([w[examples[k][0]] @ examples[k][1] for k in kept]), np.array([examples[k][2] for k in kept]))
    w *= slope
    w[bias] += shift / 0.3
    return w.astype(np.float32)


def fit_quality(docs: DataFrame, labels: DataFrame, each: int = EACH, most_bytes: int = MOST_BYTES, path: str | None = None) -> Parameters:
    """The model of score_quality(), trained on at most `each` rows of either label outside the held-out fold (see
    training_rows) and written to path, if given, from where labelled.load() reads it."""
    return trained(training_rows(docs, labels, "quality", each, most_bytes), lambda rows: {"weights": train(rows)}, path)


def score_quality(docs: DataFrame, labels: DataFrame | None, each: int = EACH, most_bytes: int = MOST_BYTES, model: Parameters | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, score, predicted.

    labels: doc_id, quality. Only the text is scored, by `model` or, without one, by fit_quality();
    the weights (2**BITS floats) are broadcast. Null and empty texts have no grams and get the score
    of the bias. Without labels every score is 0.5. Equal texts have equal scores; repeated rows each
    get their row. Other columns are ignored.
    """
    spark = docs.sparkSession
    set_batches(spark)
    shared = spark.sparkContext.broadcast((model or fit_quality(docs, labels, each, most_bytes))["weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(1)):
                row, index, value = features(data, offsets)
                logit = np.bincount(row, w[index] * value, j - i) + w[-1] * 0.3
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(1 / (1 + np.exp(-logit)))], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
