"""Operator 8, quality rules: cross-document line frequency.

Lines are normalised (words lower-cased, digits folded, blanks collapsed) and hashed; the
distinct documents of each host that hold a line are counted over the whole table; a line
held by more documents of its host than ``max(min_docs, share x documents of the host)``
counts as boilerplate and is taken out; a document of which less than ``keep_share`` of its
words is left is rejected. Per-document base rules come from the same pass over the text.

A line is counted once per document before anything is shuffled, and counts are partial
sums, so a line that every document holds reaches the reducers as one row per task. The
join that takes boilerplate out is an equi-join whose other side has one row per line, so
Spark can split a hot line's rows over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcast.llm import textkit as tk
from cashcast.session import ship_package, store

#: A line of more documents of its host than this, and than this share of them, is boilerplate.
MIN_DOCS = 10
SHARE = 0.005
#: A document must keep this share of its words.
KEEP_SHARE = 0.5
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
REPEAT_WINDOW = 8
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

_SCHEMA = ("doc_id long, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, line_hash array<long>, line_words array<int>")
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _later(key: np.ndarray) -> np.ndarray:
    """True for all but the first of equal keys, in the order of ``key``."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    out = np.zeros(len(key), bool)
    out[order[1:]] = s[1:] == s[:-1]
    return out


def _of_row(h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return tk.mix(h + rows.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def measure(data: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base counts of each text of a piece, and (row, hash, words) of its distinct normalised lines."""
    n = len(off) - 1
    starts, ends, rows = tk.word_spans(data, off, tk.NON_BLANK)
    out = {"n_words": np.bincount(rows, minlength=n)}
    out["word_chars"] = tk.per_text(tk.NON_BLANK[data] & ((data & 0xC0) != 0x80), off)
    out["n_symbols"] = tk.per_text(_SYMBOLS[data], off)
    exact = tk.prefix_sums(tk.EXACT[data])
    # lines: cut at every newline and at every text's start
    breaks = np.flatnonzero(data == 10) + 1
    line_at = np.unique(np.concatenate([breaks, off[:-1]]))
    line_of = np.searchsorted(line_at, starts, "right") - 1
    first = np.flatnonzero(np.diff(line_of, prepend=-1)) if len(line_of) else np.zeros(0, np.int64)
    used = line_of[first]
    line_end = np.append(line_at[1:], len(data))[used]
    line_end = line_end - ((line_end > line_at[used]) & (data[line_end - 1] == 10)) if len(used) else line_end
    line_row = rows[first]
    raw = _of_row(tk.span_hash(exact, line_at[used], line_end), line_row)
    out["n_dup_lines"] = np.bincount(line_row[_later(raw)], minlength=n)
    # words in repeated windows
    words = tk.span_hash(exact, starts, ends)
    win = tk.window_hash(words, REPEAT_WINDOW)
    whole = rows[:len(win)] == rows[REPEAT_WINDOW - 1:]
    at = np.flatnonzero(whole)
    key = _of_row(win[at], rows[at])
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    hit = at[order[same[1:] | same[:-1]]]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = np.bincount(rows[np.cumsum(cover[:-1]) > 0], minlength=n)
    # normalised lines, each once per text
    folded = tk.prefix_sums(tk.span_hash(tk.prefix_sums(tk.FOLDED[data]), starts, ends))
    last = np.append(first[1:], len(starts))
    norm = tk.span_hash(folded, first, last)
    own = _of_row(norm, line_row)
    _, at, inverse = np.unique(own, return_index=True, return_inverse=True)
    sums = np.bincount(inverse, weights=last - first, minlength=len(at)).astype(np.int32)
    order = np.lexsort((at, line_row[at])) if len(at) else at
    return out, line_row[at][order], norm[at][order], sums[order]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, j, data, off in tk.pieces(b.column("text")):
            counts, row, line, words = measure(data, off)
            at = pa.array(tk.row_starts(row, j - i).astype(np.int32))
            cols = [b.column("doc_id").slice(i, j - i), b.column("source").slice(i, j - i),
                    *(pa.array(counts[c].astype(np.int64)) for c in _COUNTS),
                    pa.ListArray.from_arrays(at, pa.array(tk.signed(line))),
                    pa.ListArray.from_arrays(at, pa.array(words))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "source", *_COUNTS, "line_hash", "line_words"])


def line_rules(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE,
               keep_share: float = KEEP_SHARE) -> DataFrame:
    """One row per row of ``docs``: base counts, words left, base_failed and kept.

    Uses ``doc_id``, ``text`` and ``source`` (the host); other columns are ignored, whatever
    their names. A null text has no words and fails the base rules; a null host is a host of
    its own; repeated rows (also of one doc_id) count as documents of their own; an empty
    table gives no rows. Ties need no order: all counts are exact.
    """
    ship_package(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string"))
    base = store(own.mapInArrow(_scan, _SCHEMA).withColumn("row", F.monotonically_increasing_id()), "line_rules")
    lines = base.select("row", "source", F.explode(F.arrays_zip("line_hash", "line_words")).alias("l")).select(
        "row", "source", F.col("l.line_hash").alias("line"), F.col("l.line_words").alias("words"))
    hosts = base.groupBy("source").agg(
        F.greatest(F.lit(float(min_docs)), F.count(F.lit(1)) * share).alias("limit")).select(
        F.col("source").alias("host"), "limit")
    counted = lines.groupBy("source", "line").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > min_docs)
    common = (counted.join(hosts, F.col("source").eqNullSafe(F.col("host")))
              .filter(F.col("docs") > F.col("limit"))
              .select("host", F.col("line").alias("common")))
    removed = (lines.join(common, (F.col("line") == F.col("common")) & F.col("source").eqNullSafe(F.col("host")))
               .groupBy("row").agg(F.sum("words").alias("taken"), F.count(F.lit(1)).alias("lines")))
    failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce(F.col("taken"), F.lit(0))
    return base.drop("line_hash", "line_words").join(removed, "row", "left").select(
        "doc_id", *_COUNTS, failed.alias("base_failed"),
        (~failed & (left >= F.lit(keep_share) * F.col("n_words"))).alias("kept"),
        F.coalesce(F.col("lines"), F.lit(0)).cast("long").alias("n_common_lines"), left.cast("long").alias("n_words_left"))
