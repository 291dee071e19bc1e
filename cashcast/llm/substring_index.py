"""Operator 5, suffix-array dedup by run-length indexes over content-defined buckets.

Every byte is removed that lies in a ``depth``-byte string which also starts earlier in the
corpus (smaller id, or the same document and an earlier start). A global suffix array would
have to see the corpus as one text; instead, the corpus is cut so that equal strings meet:
each window of ``depth`` bytes is named by its minimizer, the k-byte string in it with the
least hash, so equal windows have equal minimizers at equal offsets. A fragment is a run of
neighbouring windows with one minimizer (``depth`` to about 1.7 x ``depth`` bytes); it is
known by two hashes, of its minimizer and of its bytes.

* Fragments with equal bytes repeat as a whole: all but the first are removed. Copies within
  an input batch are found where they are read, so a hot fragment reaches the shuffle once
  per batch.
* Fragments that share a minimizer but not all bytes are few (the borders of copies). Their
  bytes are fetched, dealt by minimizer, and indexed bucket by bucket: a run-compressed
  Burrows-Wheeler transform with run samples. The fragments are streamed through it, and
  each window whose first occurrence is earlier is removed.
* A minimizer with more than ``BUCKET_BYTES`` of such fragments is not indexed: its windows are
  dealt one by one by the hash of all their bytes, so equal ones still meet, and all but the
  first of each are removed as they stream by.

What a task holds is a batch of fragments and one index; documents without any repeat are
never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcast.llm import textkit as tk
from cashcast.llm.graphs import Bloom
from cashcast.llm.run_index import RunIndex
from cashcast.session import broadcast_if_small, release, ship_package, store

DEPTH = 100
SEED = 32
#: Bytes of fragments of one minimizer that are compared in one index; it takes about a hundred times as much.
BUCKET_BYTES = 1 << 20
#: Bytes of fragments in one run-length index (whole buckets; a larger one of at most BUCKET_BYTES is one index).
INDEX_BYTES = 1 << 18
#: Bytes of text whose fragments are compared where they are read.
GATHER = 8 << 20
#: Windows of a text that are named at a time.
SPAN = 1 << 18
_LOW = np.uint64((1 << 20) - 1)

_FRAGMENT = "kind int, a long, g long, doc_id long, row long, start int, end int"
_TEXT = "a long, doc_id long, row long, start int, bytes binary"
_SPANS = "row long, start int, end int"
_WINDOW = "kind int, name long, doc_id long, row long, start long"


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours."""
    have = 1
    while 2 * have <= w:
        v = np.minimum(v[:len(v) - have], v[have:])
        have *= 2
    return v if have == w else np.minimum(v[:len(v) - (w - have)], v[w - have:])


def fragments(data: np.ndarray, off: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, ...]:
    """(minimizer hash, bytes hash, text row, start, end) of the fragments of a piece; ends are exclusive."""
    parts = []
    sums = tk.prefix_sums(tk.EXACT[data])
    for lo in range(0, len(data) - depth + 1, SPAN):
        hi = min(lo + SPAN, len(data) - depth + 1)  # windows [lo, hi)
        at = np.arange(lo, hi + depth - seed)
        h = tk.span_hash(sums, at, at + seed)
        least = _sliding_min((h & ~_LOW) | (at - lo).astype(np.uint64), depth - seed + 1)
        anchor = (least & _LOW).astype(np.int64)
        row = np.searchsorted(off, np.arange(lo, hi), "right") - 1
        ok = np.arange(lo, hi) + depth <= off[row + 1]
        new = np.ones(hi - lo, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (ok[1:] != ok[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], hi - lo)
        use = ok[begin]
        begin, end = begin[use], end[use]
        r = row[begin]
        parts.append((h[anchor[begin]], tk.span_hash(sums, begin + lo, end + lo + depth - 1), r, begin + lo - off[r], end + lo + depth - 1 - off[r]))
    if not parts:
        z = np.zeros(0, np.int64)
        return z.view(np.uint64), z.view(np.uint64), z, z, z
    return tuple(np.concatenate(x) for x in zip(*parts))


def merge(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans, row by row; touching spans become one."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order].astype(np.int64), end[order].astype(np.int64)
    wide = int(end.max()) + 1
    no = np.cumsum(np.concatenate([[0], row[1:] != row[:-1]])).astype(np.int64)
    s, e = start + no * (wide + 1), np.maximum.accumulate(end + no * (wide + 1))
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    return row[first], start[first], e[last] - no[last] * (wide + 1)


def _batch(kind, a, g, doc, row, start, end) -> pa.RecordBatch:
    n = len(row)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), pa.array(a.astype(np.int64)), pa.array(g.astype(np.int64)), pa.array(doc.astype(np.int64)),
         pa.array(row.astype(np.int64)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
        ["kind", "a", "g", "doc_id", "row", "start", "end"])


def _removed(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    row, start, end = merge(row, start, end)
    zero = np.zeros(len(row), np.int64)
    return _batch(0, tk.signed(tk.mix(row.astype(np.uint64))), zero, zero, row, start, end)


def _fragments(depth: int, seed: int):
    """Kind 1: the first fragments of a batch by their hashes; kind 0: spans of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = b.column("doc_id").to_numpy(zero_copy_only=False)
            ids = b.column("row").to_numpy(zero_copy_only=False)
            place = np.empty(len(doc), np.int64)  # documents in corpus order
            place[np.lexsort((ids, doc))] = np.arange(len(doc))
            parts, gathered = [], 0
            for i, j, data, off in tk.pieces(b.column("text")):
                a, g, r, s, e = fragments(data, off, depth, seed)
                parts.append((tk.signed(a), tk.signed(g), r + i, s, e))
                gathered += len(data)
                if gathered >= GATHER:
                    yield from firsts(parts, doc, ids, place)
                    parts, gathered = [], 0
            if parts:
                yield from firsts(parts, doc, ids, place)

    def firsts(parts, doc, ids, place) -> Iterator[pa.RecordBatch]:
        a, g, r, s, e = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((s, place[r])) if np.any(np.diff(place) < 0) else np.arange(len(r))
        order = order[np.argsort(tk.mix(a.view(np.uint64) + tk.mix(g.view(np.uint64)))[order], kind="stable")]
        a, g, r, s, e = a[order], g[order], r[order], s[order], e[order]
        again = np.zeros(len(r), bool)
        again[1:] = (a[1:] == a[:-1]) & (g[1:] == g[:-1])
        yield _removed(ids[r[again]], s[again], e[again])
        for c in range(0, len(r), 1 << 15):
            k = np.flatnonzero(~again[c:c + (1 << 15)]) + c
            yield _batch(1, a[k], g[k], doc[r[k]], ids[r[k]], s[k], e[k])
    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From fragments sorted by (kind, a, g, corpus order): kind 0 are removed spans, kind 1 those to compare by bytes."""
    names = ["kind", "a", "g", "doc_id", "row", "start", "end"]
    hold: list[np.ndarray] | None = None  # the first fragment so far of the last bucket, if it is its only one
    last_a = last_g = None
    for b in batches:
        kind, a, g, doc, row, start, end = (b.column(c).to_numpy() for c in names)
        z = kind == 0
        if z.any():
            yield _removed(row[z], start[z], end[z])
        a, g, doc, row, start, end = (x[~z] for x in (a, g, doc, row, start, end))
        if not len(a):
            continue
        same_a = np.concatenate([[last_a is not None and a[0] == last_a], a[1:] == a[:-1]])
        again = same_a & np.concatenate([[last_g is not None and g[0] == last_g], g[1:] == g[:-1]])
        if again.any():
            yield _removed(row[again], start[again], end[again])
        # distinct fragments of the batch; with the one held back, buckets of several are asked for
        cols = [x[~again] for x in (a, g, doc, row, start, end)]
        if hold is not None:
            cols = [np.append(h, c) for h, c in zip(hold, cols)]
        new = np.ones(len(cols[0]), bool)
        new[1:] = cols[0][1:] != cols[0][:-1]
        group = np.cumsum(new) - 1
        count = np.bincount(group, minlength=1) if len(group) else np.zeros(1, int)
        # a bucket that went on from earlier batches with several fragments already is known by `hold` being gone
        going = hold is None and last_a is not None and len(group) and cols[0][0] == last_a
        several = count > 1
        if going:
            several[0] = True
        open_single = len(count) and len(group) and not several[-1]
        ask = several[group] if len(group) else np.zeros(0, bool)
        hold = [c[-1:] for c in cols] if open_single else None
        if ask.any():
            yield _batch(1, *(c[ask] for c in cols))
        last_a, last_g = a[-1], g[-1]


def _asked(bloom, keep: bool):
    """Rows (h, row, doc_id, text) that the filter may hold, or those that it surely does not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = bloom.value
        for b in batches:
            yield b.filter(pa.array(f.holds(b.column("h").to_numpy()) == keep))
    return run


def large_buckets(asked: DataFrame, bytes_: int) -> DataFrame:
    """(a): the minimizers whose fragments to compare have more bytes than ``bytes_``."""
    return asked.groupBy("a").agg(F.sum(F.col("end") - F.col("start")).alias("size")).filter(F.col("size") > bytes_).select("a")


def _windows(depth: int):
    """Kind 1: the first windows of ``depth`` bytes of each name (a hash of all bytes) among those gathered; kind 0: the others."""
    def firsts(parts) -> pa.RecordBatch:
        name, doc, row, start = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((start, row, doc, name))
        name, doc, row, start = name[order], doc[order], row[order], start[order]
        again = np.zeros(len(name), bool)
        again[1:] = name[1:] == name[:-1]
        name[again] = tk.signed(tk.mix(row[again].astype(np.uint64)))
        return pa.RecordBatch.from_arrays([pa.array(np.where(again, 0, 1).astype(np.int32)), *(pa.array(x) for x in (name, doc, row, start))],
                                          ["kind", "name", "doc_id", "row", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, n = [], 0
            for k in range(b.num_rows):
                raw, row = b.column("text")[k].as_buffer(), b.column("row")[k].as_py()
                for s in b.column("spans")[k].as_py():
                    sums = tk.prefix_sums(tk.EXACT[np.frombuffer(raw[s["start"]:s["end"]], np.uint8)])
                    at = np.arange(s["end"] - s["start"] - depth + 1)
                    name = tk.signed(tk.span_hash(sums, at, at + depth))
                    parts.append((name, np.full(len(at), s["doc_id"], np.int64), np.full(len(at), row, np.int64), at + s["start"]))
                    n += len(at)
                    if n >= SPAN:
                        yield firsts(parts)
                        parts, n = [], 0
            if parts:
                yield firsts(parts)
    return run


def _again(depth: int):
    """From windows sorted by (kind, name, corpus order): the spans of kind 0, and of all but the first of each name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            kind, name, row, start = (b.column(c).to_numpy() for c in ("kind", "name", "row", "start"))
            z, one = kind == 0, np.flatnonzero(kind)
            if len(one):
                h = name[one]
                z[one] = np.concatenate([[last is not None and h[0] == last], h[1:] == h[:-1]])
                last = h[-1]
            r, s, e = merge(row[z], start[z], start[z] + depth)
            yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int64)), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))],
                                             ["row", "start", "end"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the spans asked for of each text."""
    for b in batches:
        spans, text = b.column("spans"), b.column("text")
        a, row, doc, start, out = [], [], [], [], []
        for k in range(b.num_rows):
            raw = text[k].as_buffer()
            for s in spans[k].as_py():
                a.append(s["a"])
                row.append(b.column("row")[k].as_py())
                doc.append(s["doc_id"])
                start.append(s["start"])
                out.append(raw[s["start"]:s["end"]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(doc, pa.int64()), pa.array(row, pa.int64()), pa.array(start, pa.int32()),
             pa.array([x.to_pybytes() for x in out], pa.binary())], ["a", "doc_id", "row", "start", "bytes"])


def _compare(depth: int):
    """From fragments sorted by (a, corpus order): spans of windows that occur earlier in their bucket."""
    def found(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        col = t.column("bytes").chunk(0)
        off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]]
        index = RunIndex(data, off - off[0], depth)
        f, o, first = index.first_seen()
        hit = first < index.begin[f] + o
        f, o = f[hit], o[hit]
        start = t.column("start").to_numpy()[f].astype(np.int64) + o
        row, start, end = merge(t.column("row").to_numpy()[f], start, start + depth)
        return pa.RecordBatch.from_arrays([pa.array(row.astype(np.int64)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
                                          ["row", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            for c in range(0, b.num_rows, 512):
                part = pa.Table.from_batches([b.slice(c, 512)])
                rest = part if rest is None else pa.concat_tables([rest, part])
                if rest.nbytes < INDEX_BYTES:
                    continue
                a = rest.column("a").to_numpy()
                border = np.flatnonzero(a[1:] != a[:-1])
                if len(border):  # whole buckets only
                    yield found(rest.slice(0, int(border[-1]) + 1))
                    rest = rest.slice(int(border[-1]) + 1)
        if rest is not None and len(rest):
            yield found(rest)
    return run


_RESULT = "doc_id long, row long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _result(with_text: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            texts = b.column("text")
            for k in range(b.num_rows):
                raw = memoryview(texts[k].as_buffer() or b"")
                spans = b.column("spans")[k].as_py() if "spans" in names else None
                kept, removed, n = [raw], 0, 0
                if spans:
                    x = np.array([(s["start"], s["end"]) for s in spans], np.int64)
                    _, start, end = merge(np.zeros(len(x), np.int64), x[:, 0], x[:, 1])
                    n, removed = len(start), int((end - start).sum())
                    kept = [raw[p:q] for p, q in zip([0, *end.tolist()], [*start.tolist(), len(raw)])]
                digest = hashlib.sha256()
                for part in kept:
                    digest.update(part)
                for o, v in zip(out, (len(raw), removed, n, digest.hexdigest(),
                                      b"".join(kept).decode("utf-8", "replace") if with_text else None)):
                    o.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(out[3], pa.string()),
                 pa.array(out[4], pa.string())], ["doc_id", "row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def repeated_spans(texts: DataFrame, depth: int = DEPTH, seed: int = SEED, bucket: int = BUCKET_BYTES) -> DataFrame:
    """(row, spans): per row of (row, doc_id, text), the spans covered by earlier strings; they may overlap."""
    spark = texts.sparkSession
    found = texts.select("doc_id", "row", "text").mapInArrow(_fragments(depth, seed), _FRAGMENT)
    dealt = found.repartition("a").sortWithinPartitions("kind", "a", "g", "doc_id", "row", "start")
    found = store(dealt.mapInArrow(_buckets, _FRAGMENT), "fragments")
    asked = found.filter("kind = 1")
    bloom = spark.sparkContext.broadcast(Bloom(asked.select("row").distinct(), F.col("row")))
    large = broadcast_if_small(large_buckets(asked, bucket))
    wanted = lambda how: asked.join(large, "a", how).groupBy("row").agg(
        F.collect_list(F.struct("a", "doc_id", "start", "end")).alias("spans"))
    some = texts.select(F.xxhash64("row").alias("h"), "row", "doc_id", "text").mapInArrow(_asked(bloom, True), "h long, row long, doc_id long, text string")
    cut = some.join(wanted("left_anti"), "row").select("row", "text", "spans").mapInArrow(_cut, _TEXT)
    dealt = cut.repartition("a").sortWithinPartitions("a", "doc_id", "row", "start")
    compared = store(dealt.mapInArrow(_compare(depth), _SPANS), "compared")
    spans = found.filter("kind = 0").select("row", "start", "end").unionByName(compared)
    if not large.isEmpty():
        windows = some.join(wanted("left_semi"), "row").select("row", "text", "spans").mapInArrow(_windows(depth), _WINDOW)
        dealt = windows.repartition("name").sortWithinPartitions("kind", "name", "doc_id", "row", "start")
        spans = spans.unionByName(dealt.mapInArrow(_again(depth), _SPANS))
    spans = store(spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    release(found, compared)
    return spans


def remove_repeats(docs: DataFrame, depth: int = DEPTH, seed: int = SEED, with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the text left).

    Uses ``doc_id`` and ``text``; other columns are ignored, whatever their names. A null text is
    empty; a text shorter than ``depth`` bytes has nothing removed; rows of one id are documents
    of their own, in the table's order; a null id comes before all others; an empty table gives
    no rows. ``kept`` may start or end inside a character, which is then replaced.
    """
    spark = docs.sparkSession
    ship_package(spark)
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    # a numbered copy: every later pass sees the same numbers, also after lost executors
    texts = store(docs.select(F.monotonically_increasing_id().alias("row"), order.alias("doc_id"),
                              F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "texts")
    spans = repeated_spans(texts, depth, seed)
    bloom = spark.sparkContext.broadcast(Bloom(spans, F.col("row")))
    hashed = texts.select(F.xxhash64("row").alias("h"), "row", "doc_id", "text")
    schema = "h long, row long, doc_id long, text string"
    some = hashed.mapInArrow(_asked(bloom, True), schema).join(spans, "row", "left").select("row", "doc_id", "text", "spans")
    clean = hashed.mapInArrow(_asked(bloom, False), schema).select("row", "doc_id", "text")
    out = some.mapInArrow(_result(with_text, ["spans"]), _RESULT).unionByName(clean.mapInArrow(_result(with_text, []), _RESULT))
    cols = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]
    return out.select(F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"), *cols)
