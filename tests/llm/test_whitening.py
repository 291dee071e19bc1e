"""Operator 13 against numpy's eigenvectors of the covariance."""

import os

import numpy as np
import pytest

import __spark_entry__ as E
from cashcast.llm import whitening
from tests.llm.cases import SF


def plain(vectors, k):
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-e)[:k]
    return n, (n * x.astype(object) - s.astype(object)) ** 2, c @ v[:, order] / np.sqrt(e[order]), e[order] / e.sum()


def as_arrays(rows, k):
    """By id: deviation, whitened values in component order; and the explained shares."""
    out, share = {}, {}
    for r in rows:
        out.setdefault(r.vec_id, {})[r.component] = r.whitened
        share[r.component] = r.explained
    assert all(sorted(v) == list(range(1, k + 1)) for v in out.values())
    return {i: np.array([v[c] for c in range(1, k + 1)]) for i, v in out.items()}, np.array([share[c] for c in range(1, k + 1)])


def check(rows, vectors, ids, k):
    n, dev, white, share = plain(vectors, k)
    got, shares = as_arrays(rows, k)
    assert sorted(got) == sorted(ids) and {r.n for r in rows} == {n}
    assert shares == pytest.approx(share, rel=1e-6)
    mine = np.array([got[i] for i in ids])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-6
    exact = {i: int(d.sum()) for i, d in zip(ids, dev)}
    assert all(int(r.deviation) == exact[r.vec_id] for r in rows)
    error = {r.identity_error for r in rows}
    assert len(error) == 1 and max(error) < 1e-9
    c = mine - mine.mean(axis=0)
    assert np.abs(c.T @ c / n - np.eye(k)).max() < 1e-9


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_query_against_numpy(spark):
    t = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    rows = E.queries()["op13_whitening"](spark, SF).collect()
    check(rows, np.stack(t.embedding), t.vec_id.tolist(), 8)


@pytest.mark.parametrize("kind", ["scaled", "dependent", "few rows", "far"])
def test_hard_dimensions(spark, kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 12))
    k = 8
    if kind == "scaled":  # standard deviations from 0.01 to 10,000
        x *= 10.0 ** np.linspace(-2, 4, 12)
    elif kind == "dependent":  # whole multiples stay dependent on the grid; one dimension is constant
        x = np.floor(1024 * x) / 1024
        x[:, 3], x[:, 7], x[:, 9] = 2 * x[:, 1], x[:, 1] + x[:, 2], 5.0
    elif kind == "few rows":
        x, k = x[:5], 4
    else:  # whole numbers around 2^40 times as large as their spread
        x = x * 50 + 1e9
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    check(whitening.whitened(frame).collect(), x, list(range(len(x))), k)


def test_awkward_rows(spark):
    rng = np.random.default_rng(7)
    good = rng.normal(size=(30, 4)).round(3).tolist()
    rows = [(i, v, "x", 1) for i, v in enumerate(good)]
    rows += [(3, good[3], "x", 1), (None, good[4], "x", 1)]  # repeated, and without an id
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 2.0, 3.0], [1.0, float("inf"), 0.0, 0.0], [1.0, -float("inf"), 0.0, 0.0],
           [1.0, 2.0], [1.0] * 5, [1e300, 0.0, 0.0, 0.0]]
    rows += [(100 + i, v, None, None) for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string, n long").repartition(4)
    got = whitening.whitened(frame).collect()
    assert len(got) == 32 * 4 and {r.vec_id for r in got} == {*range(30), None}
    one = {(r.vec_id, r.component): r for r in got}
    assert one[None, 1].whitened == one[4, 1].whitened and {r.n for r in got} == {32}
    floats = frame.selectExpr("vec_id", "CAST(embedding AS array<float>) AS embedding")
    assert whitening.whitened(floats).count() == len(got)
    assert whitening.whitened(frame.limit(0)).count() == 0
    assert whitening.whitened(frame.filter("vec_id = 100")).count() == 0
    assert whitening.whitened(frame.filter("vec_id = 3")).count() == 0  # equal vectors have no variance
    assert whitening.whitened(frame, components=2).count() == 64


def test_solve():
    rng = np.random.default_rng(8)
    r, y = np.triu(rng.normal(size=(6, 6))) + 3 * np.eye(6), rng.normal(size=(9, 6))
    assert np.allclose(whitening.solve(y, r) @ r, y)
