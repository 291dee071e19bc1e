"""The n-gram join against all pairs where sets need one, two, three and more matches, and on templates."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cashcast.llm import ngram_join


def _shingles(words):
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)}


def _all_pairs(texts):
    """(links, least linked id of every id) by comparing all pairs of texts."""
    sets = {k: _shingles(t.split()) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links, ids = 0, sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                links += 1
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return links, {k: top(k) for k in ids}


def _edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = f"n{rng.randrange(10**6)}"
        elif kind == 1:
            out.insert(at, f"n{rng.randrange(10**6)}")
        elif len(out) > 8:
            del out[at]
    return out


def _corpus(rng):
    """Templates of many documents (whole, cut and edited), small groups, chains of edits, texts alone."""
    phrases = [[f"p{k}_{i}" for i in range(12)] for k in range(6)]
    texts = []
    for k, size in enumerate((90, 40, 12, 4, 2)):
        base = [f"t{k}_{i}" for i in range(30 + 17 * k)]
        for _ in range(size):
            cut = rng.randrange(0, 4)
            texts.append(_edited(rng, base[cut:len(base) - rng.randrange(0, 4)], rng.choice((0, 0, 1, 1, 2, 4))))
    for _ in range(6):  # chains: each an edit of the one before
        words = [f"c{rng.randrange(10**6)}" for _ in range(60)]
        for _ in range(5):
            texts.append(words)
            words = _edited(rng, words, 1)
    for _ in range(60):  # own words around shared phrases
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(6, 40))]
        texts.append(own + [w for p in rng.sample(phrases, rng.randrange(0, 5)) for w in p])
    rng.shuffle(texts)
    return {k: " ".join(t) for k, t in enumerate(texts)}


@pytest.mark.parametrize("seed, kind", [(1, "estimated"), (2, "estimated"), (3, "salted"), (4, "mixed")])
def test_components_like_all_pairs(spark, monkeypatch, seed, kind):
    """Salted: lists of five rows go to several tasks and meet salt by salt; mixed: sets ask for one to six matches."""
    if kind == "salted":
        monkeypatch.setattr(ngram_join, "LIST_ROWS", 5)
    if kind == "mixed":
        def mixed(sums, begin, n, others, percent):
            return np.minimum(1 + n * 7 % 6, np.maximum((n * percent + 99) // 100, 1))
        monkeypatch.setattr(ngram_join, "matches", mixed)
    texts = _corpus(random.Random(seed))
    links, expected = _all_pairs(texts)
    assert links > 300
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs).collect()}
    assert got == expected


def _joined(spark, texts):
    docs = spark.createDataFrame([(k, k, t) for k, t in texts.items()], "row long, doc_id long, text string")
    return ngram_join.Join(docs.repartition(4))


def test_matches_grow_with_the_estimate(spark):
    """Rare tokens need one match, more frequent ones more and more, without a most."""
    sums, begin, n = np.arange(0, 41, dtype=float), np.array([0]), np.array([40])
    taken = [int(ngram_join.matches(sums, begin, n, others, 85)[0]) for others in (0.0, 0.035, 0.05, 1.0, 1000.0)]
    assert taken[:3] == [1, 2, 3] and 3 < taken[3] < taken[4] <= 34
    base = [f"g{i}" for i in range(40)]
    rng = random.Random(5)
    texts = _corpus(rng)
    texts |= {len(texts) + k: " ".join(_edited(rng, base, 1)) for k in range(400)}
    taken = {r.l for r in _joined(spark, texts).lists.select("l").distinct().collect()}
    assert 1 in taken and max(taken) > 3


def test_documents_of_a_template_do_not_meet(spark):
    """Common and own words, just under the threshold: of a million pairs, those meet whose own words share
    a counter of the sketch with a common one, if any."""
    base = [f"w{i}" for i in range(39)]
    texts = {k: " ".join([*base, *(f"own{k}_{i}" for i in range(4))]) for k in range(1500)}
    join = _joined(spark, texts)
    assert join.strays(join.lists.withColumn("c", F.col("s"))).count() < len(texts)
    assert join.links().count() == 0
