"""Operator 12, SimHash near-dedup: fingerprints linked by the generalised pigeonhole principle.

A document's fingerprint has a bit set where more than half of the XXH64 values of its word
shingles have it set. Rows of one fingerprint are one class; classes within a few bits are
linked (see ``hamming``), and the links' components are the groups of near duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcast.llm import spanhash as sh
from cashcast.llm import textkit as tk
from cashcast.llm.graphs import components
from cashcast.llm.hamming import hamming_links
from cashcast.session import broadcast_if_small, release, ship_package, store

SHINGLE = 3
DISTANCE = 2
SEED = 42

_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(data: np.ndarray, off: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text row) of all runs of ``length`` words, in text order; of a shorter text's words as one run."""
    buf, starts, ends, rows = sh.joined_words(data, off, tk.NON_BLANK)
    n = np.bincount(rows, minlength=len(off) - 1)
    first = np.cumsum(n) - n
    m = max(len(rows) - length + 1, 0)
    whole = np.flatnonzero(rows[:m] == rows[length - 1:length - 1 + m])
    short = np.flatnonzero((n > 0) & (n < length))
    a = np.concatenate([whole, first[short]])
    z = np.concatenate([whole + length - 1, first[short] + n[short] - 1])
    order = np.argsort(rows[a], kind="stable")
    a, z = a[order], z[order]
    return sh.xxh64(buf, starts[a], ends[z], seed), rows[a]


def majority(h: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The fingerprints of n texts from their shingles' hashes, sorted by text.

    Bits are counted eight at a time, in the bytes of a word, over runs of at most 255 hashes
    of one text; the runs' counts are summed per text.
    """
    out = np.zeros(n, np.uint64)
    if not len(h):
        return out
    total = np.bincount(rows, minlength=n)
    place = np.arange(len(h)) - (np.cumsum(total) - total)[rows]
    runs = np.flatnonzero(place % 255 == 0)
    texts = np.flatnonzero(total)
    of = np.searchsorted(rows[runs], texts)
    for k in range(8):
        sums = np.add.reduceat((h >> np.uint64(k)) & _LANES, runs)
        lanes = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), of, axis=0)  # byte j: bit 8 j + k
        most = 2 * lanes > total[texts][:, None]
        for j in range(8):
            out[texts] |= most[:, j].astype(np.uint64) << np.uint64(8 * j + k)
    return out


def _fingerprints(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in tk.pieces(b.column("text")):
                h, rows = shingle_hashes(data, off, length, seed)
                fp = majority(h, rows, j - i)
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(i, j - i), b.column("doc_id").slice(i, j - i), pa.array(tk.signed(fp))], ["row", "doc_id", "fp"])
    return run


def fingerprints(texts: DataFrame, length: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(row, doc_id, fp) of every row of (row, doc_id, text); fp is the fingerprint as a signed long."""
    ship_package(texts.sparkSession)
    return texts.select("row", "doc_id", "text").mapInArrow(_fingerprints(length, seed), "row long, doc_id long, fp long")


def linked(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(row, doc_id, fp, c, component) of stored rows (row, doc_id, fp): c names the component,
    ``component`` is its least doc_id (null ids only if it has no other)."""
    classes = store(rows.select("fp").distinct(), "fingerprints")
    links = hamming_links(classes, distance)
    joined = broadcast_if_small(components(links))
    release(classes, links)
    named = rows.join(joined, rows["fp"] == joined["node"], "left").select(rows["*"], F.coalesce("component", "fp").alias("c"))
    several = named.groupBy("c").agg(F.min("doc_id").alias("component"), F.count(F.lit(1)).alias("rows"))
    several = broadcast_if_small(several.filter("rows > 1").select("c", "component"))
    return named.join(several, "c", "left").select("row", "doc_id", "fp", "c", F.coalesce("component", "doc_id").alias("component"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def simhash_components(docs: DataFrame, length: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of ``docs``.

    Uses ``doc_id`` and ``text``; other columns are ignored, whatever their names. Rows without
    words have the fingerprint 0 and are linked like any others; a null id takes part in links
    but is a component's id only if all its ids are null; rows of one id are rows of their own;
    an empty table gives no rows.
    """
    rows = store(fingerprints(_texts(docs), length, seed), "simhash_rows")
    return linked(rows, distance).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         F.col("component").alias("component_id"))


def deduplicate(docs: DataFrame, length: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED) -> DataFrame:
    """``docs`` with one row of each component: its smallest id (of several rows with it, the first).

    Rows without words are kept. Works on a numbered copy, so every pass sees the same rows.
    """
    whole = store(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    texts = whole.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"))
    rows = store(fingerprints(texts.filter(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))), length, seed), "simhash_rows")
    found = linked(rows, distance)
    first = found.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("rows"))
    first = broadcast_if_small(first.filter("rows > 1").select("c", F.col("first.row").alias("kept")))
    gone = broadcast_if_small(found.join(first, "c").filter("row <> kept").select("row"))
    return whole.join(gone, "row", "left_anti").select("doc.*")
