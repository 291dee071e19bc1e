"""Operator 11, target-distribution importance resampling: bit-sliced aggregation.

Features are runs of words hashed to buckets. A bucket's gain is the scaled logarithm of its
share in the target texts over its share in the corpus, an integer. A document's weight, the
sum of the gains of its features, is computed without multiplying: its bucket counts are cut
into planes (plane j has bit j of every bucket's count), the gains into signed planes (bit k of
the positive, and of the negative, gains), and the weight is the sum of
+-2^(j + k) * popcount(count plane j AND gain plane k): whole numbers, so exact in any order.

Two passes over the texts: bucket counts of the corpus (one array of fixed size per task, summed
by Spark), then the weights. Gumbel noise from a hash of the id makes the highest scores a draw
without replacement in proportion to exp(weight / 1000).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcast.llm import spanhash as sh
from cashcast.llm import textkit as tk
from cashcast.operators.ids import global_row_number
from cashcast.session import broadcast_if_small, ship_package, store

BUCKETS = 10_000
#: Features are runs of 1 to LONGEST words.
LONGEST = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: A gain is SCALE times a natural logarithm, rounded down.
SCALE = 1000
#: Documents whose planes are made together.
BLOCK = 128

_SCORED = "doc_id long, n_words long, n_features long, weight long"


def features(data: np.ndarray, off: np.ndarray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text row) of every feature, sorted by neither, and the number of words of each text."""
    buf, starts, ends, rows = sh.joined_words(data, off, tk.ALNUM)
    found, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(1, longest + 1):
        m = max(len(rows) - k + 1, 0)
        inside = np.flatnonzero(rows[:m] == rows[k - 1:k - 1 + m])
        found.append(sh.crc32(buf, starts[inside], ends[inside + k - 1]) % buckets)
        of.append(rows[inside])
    return np.concatenate(found), np.concatenate(of), np.bincount(rows, minlength=len(off) - 1)


def _counting(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, data, off in tk.pieces(b.column("text")):
                counts += np.bincount(features(data, off, longest, buckets)[0], minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket: ``buckets`` numbers, whatever the table."""
    ship_package(texts.sparkSession)
    own = texts.select(F.col("text").cast("string").alias("text"))
    got = own.mapInArrow(_counting(longest, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for r in got.collect():
        counts[r.bucket] = r.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain, from its counts in the corpus and in the target."""
    k = len(corpus)
    s_all, t_all = float(corpus.sum() + k), float(target.sum() + k)
    return np.array([math.floor(SCALE * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(corpus, target)], np.int64)


def _packed(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    wide = np.zeros((len(flags), -(-flags.shape[1] // 64) * 64), bool)
    wide[:, :flags.shape[1]] = flags
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(sign, k, bits) of the planes that are not empty."""
    out = []
    for sign in (1, -1):
        size = np.maximum(sign * gain, 0)
        for k in range(int(size.max(initial=0)).bit_length()):
            flags = (size >> k & 1).astype(bool)
            if flags.any():
                out.append((sign, k, _packed(flags[None])[0]))
    return out


def weights(bucket: np.ndarray, rows: np.ndarray, n: int, planes: list[tuple[int, int, np.ndarray]], buckets: int) -> np.ndarray:
    """Weights of n texts from their features' buckets."""
    key, count = np.unique(rows * buckets + bucket, return_counts=True)
    row, bucket = key // buckets, key % buckets
    out = np.zeros(n, np.int64)
    for i in range(0, n, BLOCK):
        a, z = np.searchsorted(row, [i, i + BLOCK])
        r, b, c = row[a:z] - i, bucket[a:z], count[a:z]
        for j in range(int(c.max(initial=0)).bit_length()):
            on = (c >> j & 1).astype(bool)
            have, at = np.unique(r[on], return_inverse=True)  # texts whose plane j is not empty
            flags = np.zeros((len(have), buckets), bool)
            flags[at, b[on]] = True
            plane = _packed(flags)
            sums = np.zeros(len(have), np.int64)
            for sign, k, bits in planes:
                sums += sign * (np.bitwise_count(plane & bits).sum(axis=1, dtype=np.int64) << (j + k))
            out[i + have] += sums
    return out


def _weighing(planes, longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in tk.pieces(b.column("text")):
                bucket, rows, n_words = features(data, off, longest, buckets)
                w = weights(bucket, rows, j - i, planes.value, buckets)
                n = np.bincount(rows, minlength=j - i)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(n_words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(w)],
                    ["doc_id", "n_words", "n_features", "weight"])
    return run


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """The noise of an id, scaled like the gains; a null id counts as an empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-SCALE * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0))).cast("long")


def importance_ranks(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
                     longest: int = LONGEST, buckets: int = BUCKETS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs`` (after the columns ``keep``).

    Uses ``doc_id`` and ``text`` of ``docs`` and ``text`` of ``target``; other columns are
    ignored, whatever their names, unless named in ``keep`` (long columns). A null text is empty
    and weighs 0; a null id is noised like an empty text and comes after equal scores with an
    id; rows of one id are rows of their own (equal ones in any order); an empty corpus gives no
    rows, an empty target the gains of no occurrence at all. Rank is null for what is not drawn.
    """
    ship_package(docs.sparkSession)
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    planes = docs.sparkSession.sparkContext.broadcast(gain_planes(gain))
    texts = docs.select(*[F.col(k).cast("long").alias(f"_{k}") for k in keep], F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    weighed = texts.mapInArrow(_carrying(_weighing(planes, longest, buckets), [f"_{k}" for k in keep]),
                               ", ".join([f"_{k} long" for k in keep] + [_SCORED]))
    scored = store(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
                   .withColumn("_row", F.monotonically_increasing_id()), "importance")
    drawn = percent * scored.filter(F.col("n_words") >= min_words).count() // 100
    short = F.col("n_words") < min_words
    ranked = global_row_number(scored, [short, F.desc("score"), F.asc_nulls_last("doc_id"), "_row"], "_n")
    rank = F.when(~short & (F.col("_n") <= drawn), F.col("_n"))
    return ranked.select(*[F.col(f"_{k}").alias(k) for k in keep], "doc_id", "n_features", "weight", "score", rank.alias("rank"))


def _carrying(step, names: list[str]):
    """``step`` with the columns ``names`` of its input put before its own; it keeps rows and order."""
    if not names:
        return step

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for out in step(iter([b])):
                own = [b.column(c).slice(at, out.num_rows) for c in names]
                at += out.num_rows
                yield pa.RecordBatch.from_arrays([*own, *out.columns], [*names, *out.schema.names])
    return run


def resample(docs: DataFrame, target: DataFrame, **params) -> DataFrame:
    """The drawn rows of ``docs``, all their columns as they are.

    Works on a numbered copy, so that the draw and the rows kept are of the same rows.
    """
    whole = store(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    flat = whole.select("row", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"))
    drawn = importance_ranks(flat, target, keep=("row",), **params).filter("rank IS NOT NULL").select("row")
    drawn = broadcast_if_small(drawn)
    return whole.join(drawn, "row", "left_semi").select("doc.*")
