"""Operator 11 against a plain version: weights without planes, draws by sorting."""

import hashlib
import math
import re
import zlib

import numpy as np

from cashcast.llm import importance, spanhash
from tests.llm.cases import LONG, ROWS, awkward, by_id, empty, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def plain(docs, target, longest, buckets, percent, min_words, seed):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) pairs."""
    def feats(text):
        w = WORD.findall((text or "").translate(LOW))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    s, t = [0] * buckets, [0] * buckets
    for texts, counts in (([x for _, x in docs], s), (target, t)):
        for x in texts:
            for b in feats(x)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log(float(b + 1) * (sum(s) + buckets) / (float(a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, (d, x) in enumerate(docs):
        n, f = feats(x)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), i))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {r[5]: k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return sorted([(r[0], r[2], r[3], r[4], rank.get(r[5])) for r in rows], key=str)


def test_against_plain_version(spark):
    docs = [(i, prose(5 + 37 * i % 300, i) + (" The Target Words " * (i % 7))) for i in range(120)]
    docs += [(500 + i, None if i % 2 else "") for i in range(4)] + [(None, prose(50, 200)), (600, "naïve Ärger 東京 x " * 30), (601, "w" * 300 + " tail")]
    target = ["the target words of the benchmark", None, prose(40, 3), "naïve"]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for longest, buckets, percent in ((1, 10_000, 10), (2, 1000, 25), (3, 97, 100)):
        got = importance.importance_ranks(frame, goal, percent=percent, longest=longest, buckets=buckets)
        assert sorted(map(tuple, got.collect()), key=str) == plain(docs, target, longest, buckets, percent, 20, 2024)


def test_planes_add_up():
    rng = np.random.default_rng(4)
    gain = rng.integers(-20_000, 20_000, 777)
    rows, bucket = rng.integers(0, 300, 40_000), rng.integers(0, 777, 40_000) ** 2 % 777
    got = importance.weights(bucket, rows, 301, importance.gain_planes(gain), 777)
    assert (got == np.bincount(rows, gain[bucket], minlength=301).astype(np.int64)).all()
    assert importance.gain_planes(np.zeros(10, np.int64)) == []


def test_hashes_of_spans():
    import xxhash

    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 20_000, dtype=np.uint8)
    raw = data.tobytes()
    a = rng.integers(0, 19_000, 3000)
    n = rng.integers(1, 150, 3000)
    n[:6] = [1000, 31, 32, 33, 64, 65]
    a[6], n[6] = 19_999, 1
    spans = [raw[i:i + k] for i, k in zip(a, n)]
    assert spanhash.crc32(data, a, a + n).tolist() == [zlib.crc32(s) for s in spans]
    for seed in (0, 42):
        assert spanhash.xxh64(data, a, a + n, seed).tolist() == [xxhash.xxh64_intdigest(s, seed) for s in spans]


def test_awkward_rows(spark):
    target = spark.createDataFrame([("three short words", "x"), (None, "x")], "text string, rank string")
    got = by_id(importance.importance_ranks(awkward(spark), target, percent=100))
    assert sum(map(len, got.values())) == len(ROWS)
    assert (got[1][0].n_features, got[1][0].weight, got[1][0].rank) == (0, 0, None) and got[7][0].weight > 0
    assert got[4][0].n_features == len(LONG.split()) and got[7][0].rank is None
    ranks = sorted(r.rank for v in got.values() for r in v if r.rank)
    assert ranks == list(range(1, 7)) and {r.score for r in got[5]} == {got[5][0].score}
    assert importance.importance_ranks(empty(spark), target).count() == 0
    none = importance.importance_ranks(awkward(spark), target.limit(0)).collect()
    assert len(none) == len(ROWS)


def test_resampled_rows_are_those_drawn(spark):
    docs, target = awkward(spark), spark.createDataFrame([(prose(80, 9),)], "text string")
    out = importance.resample(docs, target, percent=50)
    assert out.columns == docs.columns
    ranked = importance.importance_ranks(docs, target, percent=50).filter("rank IS NOT NULL")
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.doc_id) for r in ranked.collect())
