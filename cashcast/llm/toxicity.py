"""Operator 6, toxicity: subword-bag embeddings averaged into a linear softmax.

A text is the bag of its words' character n-grams (3 to 5 bytes, word borders included),
hashed to buckets with an embedding each; the embeddings are averaged and a
linear softmax over the two labels decides. Embeddings and softmax are trained jointly in
numpy on a bounded sample, by Adagrad on the cross entropy. A misspelt word shares most of
its n-grams with the word, so unseen spellings score alike; whole words are no features, as
the model would lean on them alone.

Average and softmax are linear, so a text's margin is the average of one number per bucket
(its embedding times the softmax weights): whole texts are scored by one lookup per n-gram.
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
LEARN_DOCS = 4000
EPOCHS = 10
BATCH = 32
BUCKET_BITS = 18
DIM = 8
RATE = 0.4
DECAY = 1e-6
SIZES = (3, 4, 5)
#: Texts of the sample that a bucket must occur in to be trained; other buckets stay zero.
MIN_TEXTS = 6
#: Long texts are scored by equal passages of about so many bytes; the most toxic one counts.
PASSAGE = 768
#: Neutral subwords averaged into every bag, so that a few n-grams alone decide nothing.
NEUTRAL = 350
THRESHOLD = 0.5

_WORD = tk.byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF), (0x40, 0x40))
_PLAIN = np.where(_WORD, np.arange(256), 0x20).astype(np.uint8)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)


def passages(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of equal passages of about ``PASSAGE`` bytes, and the first passage of each text."""
    size = np.diff(off)
    k = np.maximum(1, size // PASSAGE)
    first = np.concatenate([[0], np.cumsum(k)])
    row = np.repeat(np.arange(len(size)), k)
    at = off[:-1][row] + (np.arange(first[-1]) - first[:-1][row]) * size[row] // k[row]
    return np.append(at, off[-1]), first


def subwords(data: np.ndarray, off: np.ndarray, bins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, bin) of all character n-grams of a piece, a pair of arrays for each size.

    ``bins`` are offsets that cut the bytes into texts or passages. A word equal to the one
    before it is left out.
    """
    n = len(off) - 1
    mask = np.uint64((1 << BUCKET_BITS) - 1)
    starts, ends, row = tk.word_spans(data, off, _WORD)
    word = tk.span_hash(tk.prefix_sums(tk.LOWER[data]), starts, ends)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    plain = _PLAIN[data]
    if again.any():
        drop = np.zeros(len(data) + 1, np.int8)
        drop[starts[again]] += 1
        drop[ends[again]] -= 1
        plain[np.cumsum(drop[:-1]) > 0] = 0x20
    rows = np.repeat(np.arange(n), np.diff(off))
    t = np.full(len(data) + n + 1, 0x20, np.uint8)  # a blank between texts
    t[np.arange(len(data)) + rows + 1] = plain
    begin = off + np.arange(n + 1)
    gaps = np.concatenate([[0], np.cumsum(t == 0x20)])
    wide = t.astype(np.uint64)
    packed = wide
    for k in range(2, max(SIZES) + 1):
        packed = (packed[:-1] << np.uint64(8)) | wide[k - 1:]
        if k in SIZES:
            inside = gaps[k - 1:len(t)][:len(packed)] - gaps[1:1 + len(packed)]
            at = np.flatnonzero(inside == 0)
            row = np.searchsorted(begin, at, "right") - 1
            place = np.maximum(at - row - 1, off[row])
            yield (tk.mix(packed[at] + np.uint64(k << 56)) & mask).astype(np.int64), np.searchsorted(bins, place, "right") - 1


class Bags:
    """Embeddings of the buckets and the softmax weights over their average."""

    def __init__(self, known: np.ndarray) -> None:
        rng = np.random.default_rng(5)
        self.vectors = rng.uniform(-1, 1, (1 << BUCKET_BITS, DIM)) / DIM
        self.vectors[~known] = 0
        self.softmax = np.zeros((DIM, 2))
        self.bias = np.zeros(2)
        self.seen = np.full((1 << BUCKET_BITS, DIM), 1e-6)
        self.seen_softmax, self.seen_bias = np.full((DIM, 2), 1e-6), np.full(2, 1e-6)

    def step(self, bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weight: np.ndarray) -> None:
        """One update on a batch of (buckets, shares) with their labels."""
        at = np.concatenate([b for b, _ in bags])
        share = np.concatenate([s for _, s in bags])
        doc = np.repeat(np.arange(len(bags)), [len(b) for b, _ in bags])
        used, where = np.unique(at, return_inverse=True)
        mean = np.stack([np.bincount(doc, share * self.vectors[at, d], len(bags)) for d in range(DIM)], 1)
        logit = mean @ self.softmax + self.bias
        p = np.exp(logit - logit.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(bags)), labels] -= 1
        p *= weight[:, None]
        back = p @ self.softmax.T
        grad = np.stack([np.bincount(where, share * back[doc, d], len(used)) for d in range(DIM)], 1) + DECAY * self.vectors[used]
        for value, seen, g in ((self.softmax, self.seen_softmax, mean.T @ p), (self.bias, self.seen_bias, p.sum(0))):
            seen += g * g
            value -= RATE * g / np.sqrt(seen)
        self.seen[used] += grad * grad
        self.vectors[used] -= RATE * grad / np.sqrt(self.seen[used])

    def margins(self) -> np.ndarray:
        """Each bucket's part in the margin of label 1 over label 0; last, the bias."""
        d = self.softmax[:, 1] - self.softmax[:, 0]
        return np.append(self.vectors @ d, self.bias[1] - self.bias[0]).astype(np.float32)


def fit(sample: list[tuple[str, int, float]], epochs: int = EPOCHS) -> np.ndarray:
    """Margins of all buckets (bias last) from (text, label, weight) of a bounded sample."""
    bags, texts = [], np.zeros(1 << BUCKET_BITS, int)
    for text, _, _ in sample:
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        off = np.array([0, len(raw)])
        b = np.concatenate([x for x, _ in subwords(raw, off, off)])
        used, n = np.unique(b, return_counts=True)
        texts[used] += 1
        bags.append((used.astype(np.int32), (n / (len(b) + NEUTRAL)).astype(np.float32)))
    known = texts >= MIN_TEXTS
    bags = [(b[known[b]], n[known[b]]) for b, n in bags]
    model = Bags(known)
    labels = np.array([y for _, y, _ in sample], int)
    weight = np.array([w for _, _, w in sample])
    rng = np.random.default_rng(17)
    for _ in range(epochs):
        order = rng.permutation(len(sample))
        for i in range(0, len(order), BATCH):
            part = order[i:i + BATCH]
            model.step([bags[k] for k in part], labels[part], weight[part])
    return model.margins()


def _scorer(spark: SparkSession, margins: np.ndarray):
    shared = spark.sparkContext.broadcast(margins)  # 2^BUCKET_BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for i, j, data, off in tk.pieces(b.column("text")):
                n = j - i
                bins, first = passages(off)
                margin, total = np.zeros(len(bins) - 1), np.zeros(len(bins) - 1)
                for bucket, part in subwords(data, off, bins):
                    margin += np.bincount(part, weights=m[bucket], minlength=len(margin))
                    total += np.bincount(part, minlength=len(margin))
                logit = float(m[-1]) + np.maximum.reduceat(margin / (total + NEUTRAL), first[:-1])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, n), pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], ["doc_id", "score"])
    return run


def score(docs: DataFrame, margins: np.ndarray) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs``.

    Uses ``doc_id`` and ``text``; other columns are ignored, whatever their names. A null or
    empty text has an empty bag: its score is the bias alone (0.5 without any labelled row);
    repeated rows score alike; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_scorer(docs.sparkSession, margins), "doc_id long, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn_docs: int = LEARN_DOCS) -> DataFrame:
    """Learn from the learning fold's ``toxic`` labels and score every row of ``docs``."""
    margins = fit(labelled_sample(docs, labels, "toxic", 5, 0, learn_docs))
    return score(docs, margins).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
