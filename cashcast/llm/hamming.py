"""Pairs of 64-bit words within a Hamming distance: the generalised pigeonhole principle.

The bits are grouped by correlation into groups of eight, neighbouring groups into m partitions.
If partition i gets the threshold t_i (-1: not looked at) and the t_i + 1 sum to the distance
plus one, two words within the distance are within t_i in some partition. So a word finds all
its partners if it probes, in every partition, all values within its own thresholds. Every word
picks its thresholds by dynamic programming over estimated costs: probes sent, and candidates
met, estimated from counts of the groups' values taken as independent. The m of least total
cost is used for all.

What a word meets in fact is known before candidates are made: probe lists longer than
``LIST_ROWS`` are counted exactly. Words that probe one are dense (they lie in a thick cluster,
which no partition separates). Dense words need no candidates: all words within half of the
distance of a centre are within the distance of each other, so every dense word names the
centres around it, and a centre links those that name it in a star. A centre is named by as
many words as its ball has, 65 for a distance of 2, however thick the cluster is. A pair of a
dense word and another is found by the other one's probes, as all words are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcast.session import broadcast_if_small, ship_package, store

GROUPS = 8
PARTITIONS = (2, 3, 4)
#: Costs of a probe sent and of a candidate met; words of a probe list that is not dense.
PROBE, MEET = 1.0, 0.25
LIST_ROWS = 1000

_ONES = np.bitwise_count(np.arange(256, dtype=np.uint8) ^ np.arange(256, dtype=np.uint8)[:, None])


def bits_of(words: np.ndarray) -> np.ndarray:
    """(n, 64) bits of 0 and 1, the lowest first."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair of bits is set together."""
    both = np.zeros((64, 64), np.int64)
    for b in batches:
        x = bits_of(b.column("fp").to_numpy()).astype(np.float32)
        for i in range(0, len(x), 1 << 16):  # float32 sums of ones are exact up to 2^24
            both += (x[i:i + (1 << 16)].T @ x[i:i + (1 << 16)]).astype(np.int64)
    i, j = np.triu_indices(64)
    yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(both[i, j])], ["i", "j", "n"])


def bit_groups(words: DataFrame, n: int) -> np.ndarray:
    """(GROUPS, 8) bit numbers: groups of correlated bits, correlated groups next to each other."""
    both = np.zeros((64, 64))
    for r in words.mapInArrow(_together, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        both[r.i, r.j] = both[r.j, r.i] = r.n  # 2,080 numbers
    share = both.diagonal() / max(n, 1)
    spread = np.sqrt(share * (1 - share))
    cov = both / max(n, 1) - np.outer(share, share)
    scale = np.outer(spread, spread)
    corr = np.abs(np.divide(cov, scale, out=np.ones((64, 64)), where=scale > 0))  # a constant bit goes with any
    np.fill_diagonal(corr, 0)
    free, order = list(range(64)), []
    while free:
        group = [max(free, key=lambda b: (corr[b, order[-8:]].sum() if order else corr[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < 8:
            b = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(b)
            free.remove(b)
        order += group
    return np.array(order).reshape(GROUPS, 8)


def group_values(words: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """(n, GROUPS) values of the groups, a byte each."""
    return np.packbits(bits_of(words)[:, groups.ravel()], axis=1)


def _values(groups: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(GROUPS * 256, np.int64)
        for b in batches:
            v = group_values(b.column("fp").to_numpy(), groups) + np.arange(GROUPS) * 256
            counts += np.bincount(v.ravel(), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["v", "n"])
    return run


def distance_shares(words: DataFrame, groups: np.ndarray, n: int, distance: int) -> np.ndarray:
    """(GROUPS, 256, distance + 1): the share of the words whose group is d away from the value."""
    counts = np.zeros(GROUPS * 256)
    for r in words.mapInArrow(_values(groups), "v long, n long").groupBy("v").agg(F.sum("n").alias("n")).collect():
        counts[r.v] = r.n  # 2,048 numbers
    counts = counts.reshape(GROUPS, 256) / max(n, 1)
    return np.stack([counts @ (_ONES == d) for d in range(distance + 1)], axis=2)


def cuts(m: int) -> list[tuple[int, int]]:
    """First and end group of the m partitions."""
    at = [-(-GROUPS * i // m) for i in range(m + 1)]
    return list(zip(at, at[1:]))


def ball(width: int, t: int) -> int:
    """Values of ``width`` bits within ``t`` of a value."""
    return sum(comb(width, d) for d in range(t + 1))


def allocate(values: np.ndarray, shares: np.ndarray, n: int, m: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds (words, m) of least estimated cost for words of these group values, and the cost.

    Dynamic programming over the partitions; the state is the sum of the t_i + 1 so far.
    """
    rows = np.arange(len(values))
    best = np.full((distance + 2, len(values)), np.inf)
    best[0] = 0
    picks = []
    for a, z in cuts(m):
        near = np.zeros((distance + 1, len(values)))
        near[0] = 1
        for g in range(a, z):  # the partition's distances, from its groups'
            own = shares[g][values[:, g]]
            near = np.stack([sum(near[d - e] * own[:, e] for e in range(d + 1)) for d in range(distance + 1)])
        met = n * np.cumsum(near, axis=0)
        step = np.full_like(best, np.inf)
        pick = np.zeros(best.shape, np.int8)
        for s in range(distance + 2):
            for t in range(-1, s):
                cost = best[s - t - 1] + (PROBE * ball(8 * (z - a), t) + MEET * met[t] if t >= 0 else 0)
                better = cost < step[s]
                step[s][better], pick[s][better] = cost[better], t
        best = step
        picks.append(pick)
    out = np.empty((len(values), m), np.int8)
    state = np.full(len(values), distance + 1)
    for i in reversed(range(m)):
        out[:, i] = picks[i][state, rows]
        state -= out[:, i] + 1
    return out, best[distance + 1]


def _costs(groups, shares, n: int, distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(PARTITIONS, 0.0)
        for b in batches:
            v = group_values(b.column("fp").to_numpy(), groups)
            for m in PARTITIONS:
                total[m] += float(allocate(v, shares, n, m, distance)[1].sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()))], ["m", "cost"])
    return run


def _keys(values: np.ndarray, a: int, z: int) -> np.ndarray:
    """The partition's bits as a number."""
    out = np.zeros(len(values), np.int64)
    for g in range(a, z):
        out = (out << 8) | values[:, g]
    return out


def _flips(width: int, t: int) -> np.ndarray:
    """All numbers of ``width`` bits with at most t ones, as XOR masks; by number of ones."""
    return np.array([sum(1 << b for b in c) for d in range(t + 1) for c in combinations(range(width), d)], np.uint64).view(np.int64)


def _entries(groups, m: int):
    """The index: every word under its value in each partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy()
            v = group_values(fp, groups)
            for i, (a, z) in enumerate(cuts(m)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), i, np.int32)), pa.array(_keys(v, a, z)), pa.array(fp)], ["part", "key", "fp"])
    return run


def _probes(groups, shares, n: int, m: int, distance: int):
    """The values that each word probes, by its own thresholds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy()
            v = group_values(fp, groups)
            t_of, _ = allocate(v, shares, n, m, distance)
            for i, (a, z) in enumerate(cuts(m)):
                key = _keys(v, a, z)
                for t in np.unique(t_of[:, i]):
                    at = np.flatnonzero(t_of[:, i] == t)
                    flips = _flips(8 * (z - a), int(t)) if t >= 0 else np.zeros(0, np.int64)
                    for k in range(0, len(at) * bool(len(flips)), 1 << 10):
                        own = at[k:k + (1 << 10)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(own) * len(flips), i, np.int32)), pa.array((key[own][:, None] ^ flips).ravel()),
                             pa.array(np.repeat(fp[own], len(flips)))], ["part", "key", "fp"])
    return run


def _centres(distance: int):
    """Every word within half of the distance (rounded up) of a centre; ``near`` if rounded down."""
    flips = _flips(64, (distance + 1) // 2)
    near = np.arange(len(flips)) < ball(64, distance // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy()
            for k in range(0, len(fp), 1 << 10):
                own = fp[k:k + (1 << 10)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((own[:, None] ^ flips).ravel()), pa.array(np.repeat(own, len(flips))), pa.array(np.tile(near, len(own)))],
                    ["centre", "fp", "near"])
    return run


def hamming_links(words: DataFrame, distance: int, list_rows: int = LIST_ROWS) -> DataFrame:
    """Links (a, b) between the distinct 64-bit numbers ``fp`` of ``words``, a stored table.

    Every link is one (a and b differ in 1 to ``distance`` bits), and any two words within the
    distance are joined by links: all pairs, except that dense words are linked in stars.
    """
    ship_package(words.sparkSession)
    n = words.count()
    groups = bit_groups(words, n)
    shares = distance_shares(words, groups, n, distance)
    costs = {r.m: r.cost for r in words.mapInArrow(_costs(groups, shares, n, distance), "m int, cost double")
             .groupBy("m").agg(F.sum("cost").alias("cost")).collect()}
    m = min(sorted(costs), key=costs.get, default=PARTITIONS[0])
    row = "part int, key long, fp long"
    entries = words.mapInArrow(_entries(groups, m), row)
    probes = words.mapInArrow(_probes(groups, shares, n, m, distance), row)
    long_ = broadcast_if_small(entries.groupBy("part", "key").count().filter(F.col("count") > list_rows).select("part", "key"))
    dense = broadcast_if_small(probes.join(long_, ["part", "key"], "left_semi").select("fp").distinct())
    met = (probes.join(dense, "fp", "left_anti").withColumnRenamed("fp", "x")
           .join(entries.join(long_, ["part", "key"], "left_anti").withColumnRenamed("fp", "y"), ["part", "key"]))
    apart = F.bit_count(F.col("x").bitwiseXOR(F.col("y")))
    thin = met.filter((F.col("x") != F.col("y")) & (apart <= distance)).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    stars = (dense.mapInArrow(_centres(distance), "centre long, fp long, near boolean").groupBy("centre")
             .agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("a"), F.collect_set("fp").alias("all"))  # a ball's words at most
             .filter("a IS NOT NULL").select("a", F.explode("all").alias("b")).filter("a <> b"))
    return store(thin.unionByName(stars).distinct(), "hamming_links")
