"""Operator 9, n-gram Jaccard join: adaptive multi-match prefixes.

A document's set is its distinct word shingles; rows of equal sets are one class. The
shingles of a set are ordered from rare to frequent by a fixed-size count sketch over all
documents. Two sets that reach the threshold share at least l of the tokens in their
prefixes of length |x| - ceil(t |x|) + l, and the smaller set of a pair has them in the
shorter prefix of length |x| - ceil(2t / (1 + t) |x|) + l, its indexed one. Each set lengthens
its prefix, a token and a match at a time, as long as that lowers its estimated cost (postings
written, postings met, candidates verified): sets with frequent tokens need more shared tokens.
A pair is verified, exactly, if it shares at least the smaller l of the two.

Links are wanted as components, so lists of a token are not expanded into all pairs: first
every list's members meet only their list's hub (the one with the fewest rarer tokens). What still lies in
another component than its hub is a stray; after some hub rounds, strays meet all members
of their lists that are not in their own component, whatever number that is, so no link
between different components is lost. There, only indexed postings of the smaller set meet
postings of the larger, and only in cells of a token and a class of sizes, which long lists
have several of: documents of one template that differ in words of their own have these first
and the template's behind their indexed prefix, so they do not meet at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashcast.llm import textkit as tk
from cashcast.llm.graphs import Bloom, components
from cashcast.session import broadcast_if_small, release, ship_package, store

SHINGLE = 4
PERCENT = 85
#: log2 of the sketch's counters; estimated costs of a posting, of a met posting and of a
#: verification; share of the sets that meet in one more token; rows of a token's list that go
#: to one task; shared tokens that are enough to verify a set with its hub.
SKETCH_BITS = 16
POSTING, MEET, VERIFY = 1.0, 0.02, 30.0
DECAY = 0.6
LIST_ROWS = 20_000
HUB_ROUNDS = 1
HUB_SHARED = 3

_BASE = "doc_id long, row long, n int, s long"
_POSTING = "token long, salt int, hot boolean, s long, n int, l int, pos int, indexed boolean, doc_id long"


def _sets(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row) of each text's distinct shingles, and each text's set size and set hash."""
    h, rows = tk.shingles(data, off, length)
    at = tk.distinct(rows, h)
    h, rows = h[at], rows[at]
    n = np.bincount(rows, minlength=len(off) - 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(tk.mix(h))])
    cut = np.concatenate([[0], np.cumsum(n)])
    return h, rows, n, tk.mix(sums[cut[1:]] - sums[cut[:-1]] + n.astype(np.uint64))


def _bases(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in tk.pieces(b.column("text")):
                _, _, n, s = _sets(data, off, length)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("row").slice(i, j - i), pa.array(n.astype(np.int32)), pa.array(tk.signed(s))],
                    ["doc_id", "row", "n", "s"])
    return run


def _counting(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for _, _, data, off in tk.pieces(b.column("text")):
                h, _, _, _ = _sets(data, off, length)
                counts += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["counter", "n"])
    return run


def frequencies(texts: DataFrame, length: int) -> tuple[np.ndarray, float]:
    """Estimated documents of a shingle by its counter (2^SKETCH_BITS numbers, at least 1), and the
    other documents that a shingle of unknown frequency is in, on average.

    The second follows from the counters' second moment: what they vary more than counts of
    unshared shingles would is due to shared ones.
    """
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    got = texts.select("text").mapInArrow(_counting(length), "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    for r in got.toPandas().itertuples(index=False):
        counts[r.counter] = r.n
    usual = float(np.median(counts))
    noise = usual + 4 * np.sqrt(usual + 1)
    cool = counts[counts <= noise]
    others = max(0.0, float(cool.var()) / max(float(cool.mean()), 1.0) - 1) if len(cool) else 0.0
    return np.where(counts > noise, np.maximum(1.0, counts - usual), 1.0).astype(np.float32), others


def overlap(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that a set of size n shares at least with any set that it is linked with, and with one not smaller."""
    return (n * percent + 99) // 100, (2 * n * percent + 99 + percent) // (100 + percent)


def matches(sums: np.ndarray, begin: np.ndarray, n: np.ndarray, others: float, percent: int) -> np.ndarray:
    """The l of each set (size n, its tokens from ``begin``): the first whose successor does not cost less.

    ``sums`` are the running sums of the tokens' estimated documents, from rare to frequent in each set.
    """
    least, least_same = overlap(n, percent)

    def cost(m: int) -> np.ndarray:
        met = np.minimum(n - least_same + m, n)
        met = sums[begin + met] - sums[begin] + (others - 1) * met
        return POSTING * np.minimum(n - least + m, n) + (MEET + VERIFY * DECAY ** (m - 1)) * met

    best, m = np.ones(len(n), np.int64), 1
    open_, now = n > 0, cost(1)
    while open_.any():
        m += 1
        then = cost(m)
        open_ &= (then < now) & (m <= least)
        best[open_] = m
        now = then
    return best


def _prefixes(freq, others: float, length: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f_all = freq.value
        level = np.floor(np.log2(f_all)).astype(np.int64)
        seen: set[int] = set()  # classes of this task; a copy's postings are its class's
        for b in batches:
            ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for i, j, data, off in tk.pieces(b.column("text")):
                h, rows, n, s = _sets(data, off, length)
                new = np.zeros(len(n), bool)
                for k, v in enumerate(s.tolist()):
                    if n[k] and v not in seen:
                        seen.add(v)
                        new[k] = True
                h, rows = h[new[rows]], rows[new[rows]]
                at = tk.distinct(rows, h, level[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)])
                h, rows = h[at], rows[at]
                size = np.where(new, n, 0)
                begin = np.cumsum(size) - size
                f = f_all[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                sums = np.concatenate([[0.0], np.cumsum(f, dtype=float)])
                m = matches(sums, begin, size, others, percent)
                least, least_same = overlap(size, percent)
                take = np.minimum(size - least + m, size)
                pos = np.arange(len(h)) - begin[rows]
                keep = pos < take[rows]
                h, r, f, pos = h[keep], rows[keep], f[keep], pos[keep]
                salts = np.maximum(1, np.ceil(f / LIST_ROWS)).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tk.signed(h)), pa.array((s[r] % salts).astype(np.int32)), pa.array(salts > 1), pa.array(tk.signed(s[r])),
                     pa.array(n[r].astype(np.int32)), pa.array(m[r].astype(np.int32)), pa.array(pos.astype(np.int32)),
                     pa.array(pos < (size - least_same + m)[r]), pa.array(ids[i:j][r].astype(np.int64))],
                    ["token", "salt", "hot", "s", "n", "l", "pos", "indexed", "doc_id"])
    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings sorted by (token, salt, s): one row per class and list, lists of one class left out."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
        t = t.combine_chunks()
        token, salt, s = (t.column(c).to_numpy() for c in ("token", "salt", "s"))
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
        last = int(np.flatnonzero(new)[-1])  # the last list may go on in the next batch
        out = _live(t.slice(0, last), new[:last], s[:last])
        rest = t.slice(last)
        fresh = np.ones(len(rest), bool)
        fresh[1:] = np.diff(s[last:]) != 0
        if not fresh.all():
            rest = rest.filter(pa.array(fresh))
        if out is not None:
            yield from out.to_batches()
    if rest is not None and len(rest):
        t = rest.combine_chunks()
        new = np.zeros(len(t), bool)
        new[0] = True
        out = _live(t, new, t.column("s").to_numpy())
        if out is not None:
            yield from out.to_batches()


def _live(t: pa.Table, new: np.ndarray, s: np.ndarray) -> pa.Table | None:
    if not len(t):
        return None
    fresh = new.copy()
    fresh[1:] |= s[1:] != s[:-1]
    group = np.cumsum(new) - 1
    classes = np.bincount(group[fresh])
    keep = fresh & ((classes[group] > 1) | t.column("hot").to_numpy())
    return t.filter(pa.array(keep)) if keep.any() else None


def _wanted(bloom, length: int):
    """Rows of (h, doc_id, text) whose class may be asked for, as sorted shingle hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = bloom.value
        seen: set[int] = set()
        for b in batches:
            pick = f.holds(b.column("h").to_numpy())
            if not pick.any():
                continue
            for _, _, data, off in tk.pieces(b.column("text").filter(pa.array(pick))):
                h, _, n, s = _sets(data, off, length)
                cut = np.concatenate([[0], np.cumsum(n)])
                at = [k for k, v in enumerate(s.tolist()) if n[k] and v not in seen and not seen.add(v)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tk.signed(s[at])), pa.array([h[cut[k]:cut[k + 1]].tobytes() for k in at], pa.binary())], ["s", "shingles"])
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            last, left = None, None
            for k, (key, x, y) in enumerate(zip(b.column("a").to_pylist(), b.column("x"), b.column("y"))):
                if key != last:
                    last, left = key, np.frombuffer(x.as_buffer(), np.uint64)
                right = np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(left, right)
                both = int((left[np.minimum(at, len(left) - 1)] == right).sum())
                ok[k] = 100 * both >= percent * (len(left) + len(right) - both)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])
    return run


class Join:
    """The join of one table (row, doc_id, text): its classes, live lists, verified links and components."""

    def __init__(self, texts: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> None:
        self.spark: SparkSession = texts.sparkSession
        ship_package(self.spark)
        self.length, self.percent = length, percent
        self.texts, self.tested, self.stored = texts.select("doc_id", "text"), None, []
        self.rows = store(texts.mapInArrow(_bases(length), _BASE), "ngram_rows")
        freq, others = frequencies(texts, length)
        postings = self.texts.mapInArrow(_prefixes(self.spark.sparkContext.broadcast(freq), others, length, percent), _POSTING)
        dealt = postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "s", "doc_id")
        self.lists = store(dealt.mapInArrow(_lists, _POSTING), "ngram_lists")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) of classes that reach the threshold."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = store(pairs, "ngram_pairs")
        self.stored.append(pairs)
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        classes = pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct()
        asked = self.rows.join(classes, "s").select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"))
        bloom = self.spark.sparkContext.broadcast(Bloom(asked, F.col("doc_id")))
        texts = self.texts.select(F.xxhash64(F.coalesce("doc_id", F.lit(0))).alias("h"), "text")
        sets = texts.mapInArrow(_wanted(bloom, self.length), "s long, shingles binary")
        sets = store(sets.join(classes, "s", "left_semi").groupBy("s").agg(F.first("shingles").alias("shingles")), "ngram_sets")
        left = sets.select(F.col("s").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("s").alias("b"), F.col("shingles").alias("y"))
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
        links = store(both.mapInArrow(_verify(self.percent), "a long, b long"), "ngram_links")
        release(sets)
        return links

    def reaches(self) -> Column:
        """Can a pair of (s, n, l, pos, s2, n2, l2, pos2) that shares this token reach the threshold?

        The sizes must fit, and of the first l common tokens each, at position pos, must leave
        enough tokens behind it in both sets: at most l - 1 common ones come before.
        """
        fits = 100 * F.least("n", "n2") >= self.percent * F.greatest("n", "n2")
        left = F.least("l", "l2") - 1 + F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
        return fits & ((100 + self.percent) * left >= self.percent * (F.col("n") + F.col("n2")))

    def candidates(self, met: DataFrame, enough: int | None = None) -> DataFrame:
        """Pairs (a < b) that share enough tokens, from a row (s, n, l, pos and the same of the other) per shared token."""
        wanted = F.col("l") if enough is None else F.least("l", F.lit(enough))
        return (met.groupBy(F.least("s", "s2").alias("a"), F.greatest("s", "s2").alias("b"))
                .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("l", "l2")).alias("l"))
                .filter(F.col("shared") >= wanted).select("a", "b"))

    def strays(self, lists: DataFrame) -> DataFrame:
        """Tokens shared by a stray and another member of its list, in another component, as rows for ``candidates``.

        The smaller set (of equal sizes, the one of the smaller hash) must have the token in its
        indexed prefix. Two sizes that can reach the threshold are in the same or neighbouring
        classes. A list of several salts meets salt by salt, so no task holds all its pairs.
        """
        cols = ["s", "n", "l", "c"]
        hub = lists.groupBy("token").agg(F.min(F.struct("pos", "doc_id", *cols)).alias("hub"))
        width = -np.log((self.percent - 1) / 100) if self.percent > 1 else np.inf  # a little wider than the ratio of sizes
        sized = F.floor(F.log("n") / F.lit(float(width))) if np.isfinite(width) else F.lit(0).cast("long")
        members = lists.join(hub, "token").select(
            "token", "salt", "indexed", "pos", *cols, (F.col("c") != F.col("hub.c")).alias("stray"), sized.alias("size"))
        members = store(members, "ngram_members")
        self.stored.append(members)
        # a stray meets strays and others, others meet strays only
        small = (members.filter("indexed")
                 .withColumn("kind", F.explode(F.when(F.col("stray"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))
                 .withColumn("size", F.explode(F.array("size", F.col("size") + 1))))
        large = members.select("token", "size", F.col("stray").alias("kind"), F.col("salt").alias("salt2"),
                               *[F.col(c).alias(c + "2") for c in ["pos", *cols]])
        key = ["token", "size", "kind"]
        cells = broadcast_if_small(small.select(*key, "salt").distinct().join(large.select(*key, "salt2").distinct(), key))
        met = (small.select(*key, "salt", "pos", *cols).join(cells, [*key, "salt"])
               .join(large.join(cells, [*key, "salt2"]), [*key, "salt", "salt2"]))
        ordered = (F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("s") < F.col("s2")))
        return met.filter(ordered & (F.col("c") != F.col("c2")) & self.reaches())

    def links(self) -> DataFrame:
        """Links (a, b) between classes that give all components."""
        found, lists = None, self.lists.withColumn("c", F.col("s"))
        cols = ["s", "n", "l", "c"]
        other = [F.col(f"hub.{c}").alias(c + "2") for c in ["pos", *cols]]
        for k in range(HUB_ROUNDS):
            # the hub of a list: the member with the least tokens of its own before it, as the original of
            # near copies has; later, of the members that are not in the first hub's component
            hub = lists.groupBy("token").agg(F.min(F.struct("pos", "doc_id", *cols)).alias("hub"))
            met = lists.join(hub, "token").filter(F.col("c") != F.col("hub.c"))
            if k:
                again = met.groupBy("token").agg(F.min(F.struct("pos", "doc_id", *cols)).alias("hub"))
                met = met.drop("hub").join(again, "token").filter(F.col("c") != F.col("hub.c"))
            found, lists = self._round(found, met.select("pos", *cols, *other).filter(self.reaches()))
        return found.unionByName(self.verified(self.candidates(self.strays(lists))))

    def _round(self, found: DataFrame | None, met: DataFrame) -> tuple[DataFrame, DataFrame]:
        new = self.verified(self.candidates(met, HUB_SHARED))
        found = new if found is None else found.unionByName(new)
        joined = components(found)
        lists = self.lists.join(joined, self.lists["s"] == joined["node"], "left").select(
            self.lists["*"], F.coalesce("component", "s").alias("c"))
        return found, lists

    def result(self) -> DataFrame:
        """(row, doc_id, n, c, component) of every row: c names its component, unless its set is
        empty; component is the least doc_id that links reach.

        Only components of several rows are joined back, so their table is narrow and small
        enough, as a rule, for the rows not to be dealt by component at all.
        """
        joined = broadcast_if_small(components(self.links()))
        release(self.lists, *self.stored)
        rows = self.rows.join(joined, self.rows["s"] == joined["node"], "left").select(
            self.rows["*"], F.when(F.col("n") > 0, F.coalesce("component", "s")).alias("c"))
        several = rows.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("component"), F.count(F.lit(1)).alias("rows"))
        several = broadcast_if_small(several.filter("rows > 1").select("c", "component"))
        return rows.join(several, "c", "left").select(
            "row", "doc_id", "n", "c", F.coalesce("component", "doc_id").alias("component"))


def ngram_components(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Uses ``doc_id`` and ``text``; other columns are ignored, whatever their names. Rows without
    words are empty sets and linked with nothing; rows of equal sets are linked; a null id takes
    part in links but is never a component's id unless all its ids are null; rows of one doc_id
    are rows of their own; an empty table gives no rows. Hashes have 64 bits.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    return Join(texts, length, percent).result().select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def deduplicate(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: its smallest id (of several rows with it, the first).

    Works on a numbered copy, so every pass sees the same rows; all columns are kept as they are.
    """
    whole = store(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    found = Join(whole.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"), "row"),
                 length, percent).result().filter("n > 0")
    first = found.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("rows"))
    first = broadcast_if_small(first.filter("rows > 1").select("c", F.col("first.row").alias("kept")))
    gone = broadcast_if_small(found.join(first, "c").filter("row <> kept").select("row"))
    return whole.join(gone, "row", "left_anti").select("doc.*")
