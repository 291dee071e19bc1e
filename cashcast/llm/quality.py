"""Operator 3, quality classifier: hashed word n-gram logistic regression, trained with FTRL.

A text is a sequence of words: runs of letters, runs of digits, runs of one symbol, line
ends. A word equal to the one before it becomes a repeat mark. Features are hashed 1- and
2-grams of the words and 1- to 3-grams of their shapes (kind, case, length); a feature's
value is its share of the text's n-grams. The weights are fitted by follow-the-regularised-
leader updates (per-coordinate rates, L1 and L2) on a bounded sample of labelled rows;
scoring is a sparse dot product of whole texts with a weight array of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashcast.llm import textkit as tk
from cashcast.llm.learning import fold, labelled_sample
from cashcast.session import ship_package

#: Labelled rows of each label that the fit reads at most (about; chosen by a hash of the id).
LEARN_DOCS = 3000
EPOCHS = 4
FEATURE_BITS = 18
SCALE = 30.0
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 1.0
THRESHOLD = 0.7

_KIND = np.arange(256, dtype=np.uint8)  # a symbol is a kind of its own
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 0
_KIND[tk.byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))] = 1
_KIND[0x30:0x3A] = 2
_UPPER = tk.byte_table((0x41, 0x5A))
_SMALL = tk.byte_table((0x61, 0x7A))


def _ngrams(h: np.ndarray, rows: np.ndarray, n: int, tag: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text row) of the n-grams that lie inside one text."""
    g = tk.window_hash(h + np.uint64(tag * 0x9E3779B1), n)
    own = rows[:len(g)]
    ok = own == rows[n - 1:n - 1 + len(g)]
    return (g[ok] & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int64), own[ok]


def features(data: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature, text row) of every n-gram of a piece, a pair of arrays for each kind of n-gram."""
    if not len(data):
        return []
    kind = _KIND[data]
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = kind[1:] != kind[:-1]
    new[off] = True
    at = np.flatnonzero(new)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] != 0
    starts, ends = starts[keep], ends[keep]
    rows = np.searchsorted(off, starts, "right") - 1
    word = tk.span_hash(tk.prefix_sums(tk.LOWER[data]), starts, ends)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (rows[1:] == rows[:-1])
    word[again] = np.uint64(7)
    count = lambda t: (lambda c: c[ends] - c[starts])(np.concatenate([[0], np.cumsum(t[data])]))
    upper, small = count(_UPPER), count(_SMALL)
    case = np.where(upper > 0, np.where(small > 0, 1, 2), 0)
    k = kind[starts].astype(np.uint64)
    shape = tk.mix((k << np.uint64(16)) | (case.astype(np.uint64) << np.uint64(8)) | np.minimum(ends - starts, 12).astype(np.uint64))
    shape[again] = np.uint64(7)
    return [_ngrams(word, rows, 1, 1), _ngrams(word, rows, 2, 2), _ngrams(shape, rows, 1, 3), _ngrams(shape, rows, 2, 4),
            _ngrams(shape, rows, 3, 5)]


def vectors(data: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse vector (features, values) of each text of a piece."""
    f = features(data, off)
    feature = np.concatenate([x for x, _ in f] or [np.zeros(0, np.int64)])
    rows = np.concatenate([r for _, r in f] or [np.zeros(0, np.int64)])
    key, n = np.unique((rows << FEATURE_BITS) | feature, return_counts=True)
    row = key >> FEATURE_BITS
    total = np.bincount(rows, minlength=len(off) - 1)
    value = SCALE * n / total[row]
    cut = tk.row_starts(row, len(off) - 1)
    index = key & ((1 << FEATURE_BITS) - 1)
    return [(index[a:b], value[a:b]) for a, b in zip(cut[:-1], cut[1:])]


class Ftrl:
    """Follow-the-regularised-leader logistic regression over hashed features; the last weight is the bias."""

    def __init__(self, size: int) -> None:
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, at: np.ndarray, x: np.ndarray, label: int, weight: float) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        g = weight * (p - label) * x
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] += g * g


def fit(sample: list[tuple[str, int, float]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (bias last) from (text, label, weight) of a bounded sample."""
    model = Ftrl(1 << FEATURE_BITS)
    xs = []
    for text, _, _ in sample:
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        xs.append(vectors(raw, np.array([0, len(raw)]))[0])
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for i in rng.permutation(len(sample)):
            model.update(*xs[i], sample[i][1], sample[i][2])
    return model.weights()


def _scorer(spark: SparkSession, weights: np.ndarray):
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))  # 2^FEATURE_BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            for i, j, data, off in tk.pieces(b.column("text")):
                n = j - i
                dot, total = np.zeros(n), np.zeros(n)
                for feature, rows in features(data, off):
                    dot += np.bincount(rows, weights=w[feature], minlength=n)
                    total += np.bincount(rows, minlength=n)
                logit = float(w[-1]) + SCALE * dot / np.maximum(total, 1)
                score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, n), pa.array(score)], ["doc_id", "score"])
    return run


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs``.

    Uses ``doc_id`` and ``text``; other columns are ignored, whatever their names. A null or
    empty text has no features: its score is the bias alone (0.5 without any labelled row);
    repeated rows score alike; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_scorer(docs.sparkSession, weights), "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, learn_docs: int = LEARN_DOCS) -> DataFrame:
    """Learn from the learning fold's ``quality`` labels and score every row of ``docs``."""
    weights = fit(labelled_sample(docs, labels, "quality", 4, 2, learn_docs))
    return score(docs, weights).select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
