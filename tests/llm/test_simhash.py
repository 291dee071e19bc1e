"""Operator 12 against plain versions: fingerprints by counting, links by comparing all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cashcast.llm import hamming, simhash
from cashcast.llm.graphs import components
from cashcast.session import store
from tests.llm.cases import ROWS, awkward, by_id, empty, prose

LOW = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text, length=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    runs = [" ".join(w[i:i + length]) for i in range(max(len(w) - length, 0) + 1)] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, distance):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(fps))]


def test_fingerprints_and_components(spark):
    texts = [prose(60 + i % 5 * 200, i % 17) + (" one more" if i % 3 == 0 else "") for i in range(70)]
    texts += ["", None, "two words", "Two  WORDS", "ab", "naïve Größe über 東京 " * 5, prose(3000, 40), prose(3000, 40) + " x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in simhash.simhash_components(docs).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    assert [int(got[i].fingerprint, 16) for i in range(len(texts))] == fps
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in got.values())
    assert [got[i].component_id for i in range(len(texts))] == plain_components(fps, 2)
    assert got[70].component_id == got[71].component_id == 70 and got[72].component_id == got[73].component_id


def words_of(kind, rng):
    """Distinct 64-bit words: scattered pairs, a thick cluster, words that share half of their bits, and all of them."""
    out = set()
    if kind in ("scattered", "mixed"):
        for _ in range(300):
            x = int(rng.integers(0, 2**63)) * 2 + 1
            out |= {x, x ^ (1 << int(rng.integers(64))), x ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64)))}
    if kind in ("thick", "mixed"):
        centre = int(rng.integers(0, 2**63))
        for _ in range(900):
            x = centre
            for b in rng.integers(0, 64, int(rng.integers(0, 5))):
                x ^= 1 << int(b)
            out.add(x)
    if kind in ("half", "mixed"):
        top = int(rng.integers(0, 2**32)) << 32
        out |= {top | int(v) for v in rng.integers(0, 2**32, 400)} | {top | int(v) for v in rng.integers(0, 2**9, 200)}
    return sorted(out)


@pytest.mark.parametrize("kind", ["scattered", "thick", "half", "mixed"])
@pytest.mark.parametrize("distance, list_rows", [(2, 1000), (2, 5), (1, 5), (3, 20)])
def test_links_give_the_components_of_all_pairs(spark, kind, distance, list_rows):
    words = words_of(kind, np.random.default_rng(len(kind)))
    signed = [w - 2**64 if w >= 2**63 else w for w in words]
    frame = store(spark.createDataFrame([(w,) for w in signed], "fp long"), "words")
    links = hamming.hamming_links(frame, distance, list_rows).collect()
    x = np.array(words, np.uint64)
    for r in links:
        assert 1 <= bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= distance
    apart = np.bitwise_count(x[:, None] ^ x)
    expected = [int(np.flatnonzero(row)[0]) for row in _reach(apart <= distance)]
    at = {w: i for i, w in enumerate(signed)}
    joined = np.eye(len(x), dtype=bool)
    for r in links:
        joined[at[r.a], at[r.b]] = joined[at[r.b], at[r.a]] = True
    assert [int(np.flatnonzero(row)[0]) for row in _reach(joined)] == expected


def _reach(near):
    while True:
        more = (near.astype(np.float32) @ near.astype(np.float32)) > 0
        if (more == near).all():
            return near
        near = more


def test_thresholds_are_unequal_where_bits_are_hot():
    """A partition whose values are all alike is not looked at, or only exactly; thresholds always add up."""
    shares = np.zeros((8, 256, 3))
    even = np.bitwise_count(np.arange(256, dtype=np.uint8) ^ np.arange(256, dtype=np.uint8)[:, None])
    for d in range(3):
        shares[:, :, d] = (even == d).sum(axis=1) / 256
    shares[:2] = [1, 0, 0]  # the first two groups hold one value
    v = np.zeros((5, 8), np.uint8)
    for m in (2, 3, 4):
        t, cost = hamming.allocate(v, shares, 10_000_000, m, 2)
        assert ((t + 1).sum(axis=1) == 3).all() and np.isfinite(cost).all()
    t, _ = hamming.allocate(v, shares, 10_000_000, 4, 2)
    assert (t[:, 0] == -1).all() and t.max() >= 0
    # the cost is the least of all allocations
    for m in (2, 3):
        _, cost = hamming.allocate(v, shares, 10_000, m, 2)
        assert cost[0] == pytest.approx(_least_cost(v[0], shares, 10_000, m, 2))


def _least_cost(v, shares, n, m, distance):
    from itertools import product

    def cost(i, t):
        if t < 0:
            return 0.0
        a, z = hamming.cuts(m)[i]
        near = 0.0
        for ds in product(range(distance + 1), repeat=z - a):
            if sum(ds) <= t:
                near += np.prod([shares[g, v[g], d] for g, d in zip(range(a, z), ds)])
        return hamming.PROBE * hamming.ball(8 * (z - a), t) + hamming.MEET * n * near
    return min(sum(cost(i, t) for i, t in enumerate(ts)) for ts in product(range(-1, distance + 1), repeat=m) if sum(ts) + m == distance + 1)


def test_awkward_rows(spark):
    got = by_id(simhash.simhash_components(awkward(spark)))
    assert sum(map(len, got.values())) == len(ROWS)
    assert {got[i][0].component_id for i in (1, 2, 3)} == {1} and got[1][0].fingerprint == "0" * 16
    assert {r.component_id for i in (5, 6) for r in got[i]} == {5}
    assert {r.component_id for r in got[None]} == {1, None}  # the text without an id is alone, the empty one is not
    assert simhash.simhash_components(empty(spark)).count() == 0
    out = simhash.deduplicate(awkward(spark))
    assert out.columns == awkward(spark).columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(["1", "2", "3", "4", "5", "7", "8", "9", "10", "11", "None", "None"])
    assert simhash.deduplicate(empty(spark)).count() == 0


def test_a_fingerprint_of_many_rows(spark):
    """Rows of one text, a third of the table, are one class."""
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, prose(50, 1)).otherwise(
        F.concat(F.lit(prose(30, 2)), F.lit(" "), F.sha2(F.col("id").cast("string"), 256), F.lit(" "), F.md5(F.col("id").cast("string")))).alias("text"))
    got = simhash.simhash_components(docs)
    assert got.filter("doc_id % 3 = 0").select("component_id").distinct().collect()[0].component_id == 0
    rows = store(got.select(F.col("doc_id").alias("node"), "component_id"), "rows")
    assert components(rows.select(F.col("node").alias("a"), F.col("component_id").alias("b"))).count() == 900
