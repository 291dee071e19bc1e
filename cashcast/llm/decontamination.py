"""Operator 1, benchmark decontamination: a distributed positional inverted index.

The index is partitioned by document: a segment is a run of whole documents with, for each
term that the test set asks for, the sorted list of its positions in the segment. Segments
are written once to the shared folder. A test window's terms are ordered by their frequency
in the whole index; in every segment the positions of the rarest term, less its offset in
the window, are the candidate starts, and the other terms' lists, each adjusted by its
offset, are intersected with them from rare to common. With a slop, a term may stand that
many places off its place, which gives proximity matches.

Positions never leave their segment: only term counts are shuffled. The test set is taken
in blocks of bounded size; what a task holds is one block's vocabulary and one segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcast.llm import textkit as tk
from cashcast.session import broadcast_if_small, release, ship_package, store

#: Words of a window, places that a proximity match allows, bytes of test text in a block.
WINDOW = 10
SLOP = 2
BLOCK_BYTES = 4 << 20
#: Candidates that are intersected at a time; more go in several rounds.
ROUND = 1 << 20

_INDEX = "keys binary, n_words binary, terms binary, counts binary, places binary"
_FOUND = "doc_id long, text_hash long, n_words long, n_hit long, item_ids array<string>, near_ids array<string>, spans array<long>"


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, rows = tk.word_spans(data, off, tk.ALNUM)
    return tk.span_hash(tk.prefix_sums(tk.LOWER[data]), starts, ends), rows


class Windows:
    """The windows of one block of test items: distinct word sequences and the items that hold them."""

    def __init__(self, items: list[tuple[str, str]], size: int) -> None:
        names = sorted({i for i, _ in items})
        number = np.searchsorted(np.array(names, object), np.array([i for i, _ in items], object)) if items else np.zeros(0, int)
        raw = [(t or "").encode() for _, t in items]
        off = np.concatenate([[0], np.cumsum([len(t) for t in raw], dtype=np.int64)])
        h, row = _words(np.frombuffer(b"".join(raw), np.uint8), off)
        count = np.bincount(row, minlength=len(items))
        # a window starts at every word that has enough behind it; a short item is one window
        start = np.arange(len(h))
        first = tk.row_starts(row, len(items))
        behind = first[row] + count[row] - start if len(h) else start
        length = np.minimum(count[row], size) if len(h) else start
        start = start[behind >= length]
        length = length[start]
        at = start[:, None] + np.arange(size)
        inside = np.arange(size) < length[:, None]
        words = np.where(inside, h[np.minimum(at, max(len(h) - 1, 0))] if len(h) else np.uint64(0), np.uint64(0))
        key = tk.mix((words * (np.arange(size, dtype=np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))).sum(1) + length.astype(np.uint64))
        _, pick, window = np.unique(key, return_index=True, return_inverse=True)
        pair = np.unique(np.stack([window, number[row[start]]], 1), axis=0) if len(start) else np.zeros((0, 2), int)
        self.names, self.item = names, pair[:, 1]
        self.item_at = np.searchsorted(pair[:, 0], np.arange(len(pick) + 1))
        self.vocabulary = np.unique(h)
        self.length = length[pick]
        self.term = np.where(inside[pick], np.searchsorted(self.vocabulary, words[pick]), -1).astype(np.int32)
        self.offset = np.tile(np.arange(size, dtype=np.int16), (len(pick), 1))

    def items(self, window: int) -> list[str]:
        """Ids of the items that hold the window."""
        return [self.names[k] for k in self.item[self.item_at[window]:self.item_at[window + 1]]]

    def rarest_first(self, frequency: np.ndarray) -> None:
        """Order each window's terms by frequency in the index; places past a short window go last."""
        f = np.where(self.term >= 0, frequency[self.term], np.iinfo(np.int64).max)
        order = np.argsort(f, axis=1, kind="stable")
        self.term = np.take_along_axis(self.term, order, 1)
        self.offset = np.take_along_axis(self.offset, order, 1)


def _indexer(vocabulary: np.ndarray, gap: int):
    """Batches of (doc_id, text_hash, text) to segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.stack([b.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "text_hash", "no_id")], 1)
            for i, j, data, off in tk.pieces(b.column("text")):
                h, rows = _words(data, off)
                term = np.searchsorted(vocabulary, h)
                term[term == len(vocabulary)] = 0
                at = np.flatnonzero(vocabulary[term] == h) if len(vocabulary) else np.zeros(0, np.int64)
                term, place = term[at], at + rows[at] * gap
                order = np.argsort(term, kind="stable")
                used, counts = np.unique(term, return_counts=True)
                blobs = [keys[i:j].astype(np.int64), np.bincount(rows, minlength=j - i).astype(np.int64), used.astype(np.int32),
                         counts.astype(np.int32), place[order].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in blobs],
                                                 ["keys", "n_words", "terms", "counts", "places"])
    return run


def _frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        t = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in b.column("terms")] or [np.zeros(0, np.int32)])
        n = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in b.column("counts")] or [np.zeros(0, np.int32)])
        used, at = np.unique(t, return_inverse=True)
        sums = np.bincount(at, weights=n, minlength=len(used)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums)], ["term", "n"])


def intersect(w: Windows, terms: np.ndarray, counts: np.ndarray, places: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of all places of one segment where every term stands within ``slop`` of its place."""
    first = np.zeros(len(w.vocabulary) + 1, np.int64)
    np.add.at(first, terms + 1, counts)
    first = np.cumsum(first)
    term = np.repeat(terms.astype(np.int64), counts)
    key = (term << 40) + places  # sorted: by term, then place
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = first[w.term[:, 0] + 1] - first[w.term[:, 0]]
    upto = np.cumsum(n)
    out = []
    a = 0
    while a < len(n):  # windows by rounds of bounded candidates
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + ROUND, "right")))
        win = np.repeat(np.arange(a, b), n[a:b])
        at = np.arange(len(win)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b]) + first[w.term[win, 0]]
        start = places[at] - w.offset[win, 0]
        ok = start >= 0
        win, start = win[ok], start[ok]
        for k in range(1, w.term.shape[1]):
            if not len(win):
                break
            asked = w.term[win, k]
            want = (asked.astype(np.int64) << 40) + start + w.offset[win, k]
            pos = np.searchsorted(key, want - slop)
            hit = key[np.minimum(pos, len(key) - 1)]
            ok = (asked < 0) | ((pos < len(key)) & (hit <= want + slop) & (hit >= want - slop))
            win, start = win[ok], start[ok]
        out.append((win, start))
        a = b
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _matcher(shared, gap: int, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            for keys, n_words, terms, counts, places in zip(*(b.column(c) for c in ("keys", "n_words", "terms", "counts", "places"))):
                keys = np.frombuffer(keys.as_buffer(), np.int64).reshape(-1, 3)
                n_words = np.frombuffer(n_words.as_buffer(), np.int64)
                terms, counts = (np.frombuffer(x.as_buffer(), np.int32) for x in (terms, counts))
                places = np.frombuffer(places.as_buffer(), np.int64)
                begin = np.cumsum(n_words) - n_words  # of each document, in words
                base = begin + np.arange(len(n_words)) * gap
                win, start = intersect(w, terms, counts, places, 0)
                row = np.searchsorted(base, start, "right") - 1
                cover = np.zeros(int(n_words.sum()) + 1, np.int64)
                np.add.at(cover, start - row * gap, 1)
                np.add.at(cover, start - row * gap + w.length[win], -1)
                inside = np.cumsum(cover[:-1]) > 0
                n_hit = tk.per_text(inside, np.append(begin, len(inside)))
                ids, spans = {}, {}
                for r, x in set(zip(row.tolist(), win.tolist())):
                    ids.setdefault(r, set()).update(w.items(x))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], inside, [0]])))
                for s, e in zip(edge[0::2].tolist(), edge[1::2].tolist()):
                    r = int(np.searchsorted(begin, s, "right")) - 1
                    while s < e:  # touching hits of neighbours in the segment part at their border
                        stop = min(e, int(begin[r] + n_words[r]))
                        if s < stop:
                            spans.setdefault(r, []).extend((s - int(begin[r]), stop - int(begin[r])))
                        s, r = max(s, stop), r + 1
                near = ids
                if slop:
                    near = {}
                    nw, ns = intersect(w, terms, counts, places, slop)
                    nr = np.searchsorted(base, ns, "right") - 1
                    for r, x in set(zip(nr.tolist(), nw.tolist())):
                        near.setdefault(max(r, 0), set()).update(w.items(x))
                k = range(len(n_words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, 0], mask=keys[:, 2] != 0), pa.array(keys[:, 1]), pa.array(n_words), pa.array(n_hit.astype(np.int64)),
                     pa.array([sorted(ids.get(r, ())) for r in k], pa.list_(pa.string())),
                     pa.array([sorted(near.get(r, ())) for r in k], pa.list_(pa.string())),
                     pa.array([spans.get(r, []) for r in k], pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "n_words", "n_hit", "item_ids", "near_ids", "spans"])
    return run


def find(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = SLOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, item_ids, near_ids, spans.

    ``item_ids`` are the items (ids as strings) with an exact window in the text, ``near_ids``
    those with a window whose words all stand within ``slop`` places of their place, ``spans``
    the (start, end) word numbers of the hit passages, flat.

    Uses ``doc_id`` and ``text`` of ``docs`` and ``item_id`` and ``text`` of ``items``; other
    columns are ignored, whatever their names. A null text has no words; an item without words
    has no windows; a null item id counts as an empty one; rows of one item id are one item;
    repeated document rows are answered each; without items nothing is hit; an empty table
    gives no rows. A window occurs inside one document only.
    """
    ship_package(docs.sparkSession)
    gap = size + 2 * slop + 1
    asked = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                         F.col("text").cast("string").alias("text"))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
                      F.col("doc_id").isNull().cast("long").alias("no_id"), F.col("text").cast("string").alias("text"))
    out = None
    for k in range(blocks):  # each block of the test set is one pass
        part = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else asked
        w = Windows([(r.item_id, r.text) for r in part.collect()], size)  # block_bytes of text
        index = store(own.mapInArrow(_indexer(w.vocabulary, gap), _INDEX), "postings")
        frequency = np.zeros(len(w.vocabulary), np.int64)
        for r in index.select("terms", "counts").mapInArrow(_frequency, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
            frequency[r.term] = r.n
        w.rarest_first(frequency)
        found = index.mapInArrow(_matcher(docs.sparkSession.sparkContext.broadcast(w), gap, slop), _FOUND)  # a block's size
        if blocks == 1:
            return found
        # equal rows have equal answers: one of each before the blocks meet, so copies are counted and not gathered
        answers = found.groupBy("doc_id", "text_hash").agg(
            *[F.first(c).alias(c) for c in ("n_words", "item_ids", "near_ids", "spans")], F.count(F.lit(1)).alias("copies"))
        answers = store(answers, "block")
        release(index)
        out = answers if out is None else out.unionByName(answers)
    # a document's answers, one of each block: its hit words are counted again from the spans
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    merged = out.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), union("item_ids").alias("item_ids"), union("near_ids").alias("near_ids"),
        union(_numbers("spans")).alias("hits"), F.max("copies").cast("int").alias("copies"))
    return (merged.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
            .select("doc_id", "text_hash", "n_words", F.size("hits").cast("long").alias("n_hit"), "item_ids", "near_ids",
                    _passages(F.col("hits")).alias("spans")))


def _numbers(spans: str):
    """Word numbers of flat spans."""
    pairs = F.when(F.size(spans) > 0, F.sequence(F.lit(0), F.size(spans) - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(pairs, lambda i: F.sequence(F.get(F.col(spans), i), F.get(F.col(spans), i + 1) - 1)))


def _passages(hits):
    """Flat spans of sorted word numbers: neighbours are one passage."""
    beside = lambda x, i, step: F.coalesce(F.get(hits, i + step) == x + step, F.lit(False))
    starts = F.filter(hits, lambda x, i: ~beside(x, i, -1))
    ends = F.filter(hits, lambda x, i: ~beside(x, i, 1))
    return F.flatten(F.zip_with(starts, ends, lambda s, e: F.array(s, e + 1)))


def digest(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Exact matches only: words, hit words and items of every row."""
    found = find(docs, items, slop=0, **options)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    bad = broadcast_if_small(find(docs, items, slop=0, **options).filter("n_hit > 0").select("doc_id", "text_hash").distinct())
    h = F.xxhash64(docs["text"].cast("string"))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["doc_id"]) & (h == bad["text_hash"]), "left_anti")
