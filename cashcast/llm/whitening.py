"""Operator 13, embedding whitening: shifted CholeskyQR.

Entries become whole numbers on a grid of 1/1024, so the mean is exact. The centred rows X are
orthogonalised without ever being moved: a pass sums the Gram matrix of the rows, after the
triangular solves of the passes before, in one small matrix per task; the driver factors it,
G (+ shift) = R^T R. The shift keeps the first factorisation positive definite however badly
the dimensions are scaled or correlated; the passes go on until the Gram matrix is the
identity. The product of the factors is the R of X = Q R, and its singular values and right
vectors are those of X: squares over n are the eigenvalues of the covariance, to double
precision, without the squared condition number of the covariance matrix itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcast.session import ship_package, store

COMPONENTS = 8
GRID, OFFSET = 1024, 100_000
#: Passes at most; the Gram matrix's distance from the identity that ends them.
PASSES, NEAR = 6, 1e-13
#: A singular value below this share of the largest one is none.
RANK = 1e-9
#: Entries beyond this, on the grid, are treated as not finite.
WIDEST = float(1 << 52)
_WIDE = Decimal(10) ** 38


def vectors(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, embedding) of the rows whose vector is whole: not null or empty, all entries finite."""
    good = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) * GRID < WIDEST))  # NaN is above any bound
    own = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    return own.filter((F.size("embedding") > 0) & F.coalesce(good, F.lit(False)))


def _matrices(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, entries) of a batch, a matrix for each length that occurs."""
    col = b.column("embedding")
    n = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    begin = np.cumsum(n) - n
    for d in np.unique(n):
        at = np.flatnonzero(n == d)
        yield at, flat[begin[at][:, None] + np.arange(d)]


def on_grid(entries: np.ndarray) -> np.ndarray:
    return np.floor(GRID * entries).astype(np.int64) + OFFSET


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length: rows (at dimension -1) and the sum of each dimension, as exact decimals."""
    n: dict[int, int] = {}
    s: dict[int, np.ndarray] = {}
    for b in batches:
        for at, entries in _matrices(b):
            d = entries.shape[1]
            x = on_grid(entries)
            whole = x.sum(axis=0) if np.abs(x).max() < 2**63 // max(len(at), 1) else x.astype(object).sum(axis=0)
            s[d] = s.get(d, 0) + whole.astype(object)
            n[d] = n.get(d, 0) + len(at)
    rows = [(d, -1, n[d]) for d in n] + [(d, i, v) for d in s for i, v in enumerate(s[d])]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([Decimal(int(r[2])) for r in rows], pa.decimal128(28, 0))], ["d", "dim", "total"])


def fit_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of the vectors and their sum per dimension; vectors are those of the most frequent
    length, of equally frequent ones the longest."""
    got = rows.select("embedding").mapInArrow(_sums, "d int, dim int, total decimal(28,0)")
    got = got.groupBy("d", "dim").agg(F.sum("total").alias("total")).collect()  # lengths x dimensions
    n, d = max(((int(r.total), r.d) for r in got if r.dim < 0), default=(0, 0))
    sums = {r.dim: int(r.total) for r in got if r.d == d}
    return n, [sums[i] for i in range(d)]


def solve(y: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Rows z with z @ factor = y, for an upper triangular factor: columns one after the other."""
    z = np.empty_like(y)
    for j in range(y.shape[1]):
        z[:, j] = (y[:, j] - z[:, :j] @ factor[:j, j]) / factor[j, j]
    return z


def _centred(entries: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, rounded once: n*x - S is a whole number."""
    x = on_grid(entries)
    if n * (np.abs(x).max(initial=0) + 1) < 2**62:
        return (n * x - np.array(sums, np.int64)) / n
    return ((n * x.astype(object) - np.array(sums, object)) / n).astype(float)


def _gram(n: int, sums: list[int], use: np.ndarray, factors: list[np.ndarray]):
    """Upper triangle of the Gram matrix of the dimensions ``use`` after the solves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(use), len(use)))
        for b in batches:
            for _, entries in _matrices(b):
                if entries.shape[1] == len(sums):
                    y = _centred(entries, n, sums)[:, use]
                    for f in factors:
                        y = solve(y, f)
                    total += y.T @ y
        i, j = np.triu_indices(len(use))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])
    return run


def gram(rows: DataFrame, n: int, sums: list[int], use: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    got = rows.select("embedding").mapInArrow(_gram(n, sums, use, factors), "i int, j int, v double")
    out = np.zeros((len(use), len(use)))
    for r in got.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # dimensions squared
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def shifted_qr(rows: DataFrame, n: int, sums: list[int], use: np.ndarray, g: np.ndarray) -> np.ndarray:
    """R of X = Q R for the centred rows X, from their Gram matrix ``g`` and further Gram passes."""
    d, unit = len(use), np.finfo(float).eps / 2
    factors: list[np.ndarray] = []
    whole = np.eye(d)
    for k in range(PASSES):
        g = gram(rows, n, sums, use, factors) if k else g
        if k and np.abs(g - np.eye(d)).max() <= NEAR * d:
            break
        shift = 0.0 if k else 11 * (n * d + d * (d + 1)) * unit * float(np.trace(g))
        shift = min(shift, 1e-6 * float(np.trace(g)))  # n is large: a larger shift costs only a pass
        while True:
            try:
                r = np.linalg.cholesky(g + shift * np.eye(d)).T
                break
            except np.linalg.LinAlgError:  # dimensions depend on each other
                shift = max(10 * shift, unit * d * float(np.trace(g)))
        factors.append(r)
        whole = r @ whole
    return whole


def principal(rows: DataFrame, n: int, sums: list[int], most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(components as columns, eigenvalues, trace) of the covariance, up to ``most`` of them."""
    d = len(sums)
    g = gram(rows, n, sums, np.arange(d), [])
    use = np.flatnonzero(g.diagonal() > 0)  # a constant dimension is part of no component
    if not len(use):
        return np.zeros((d, 0)), np.zeros(0), 0.0
    r = shifted_qr(rows, n, sums, use, g[np.ix_(use, use)])
    _, sigma, vt = np.linalg.svd(r)
    k = min(most, int((sigma > RANK * sigma[0]).sum()))
    v = np.zeros((d, k))
    v[use] = vt[:k].T
    v *= np.sign(v[np.abs(v).argmax(axis=0), np.arange(k)])  # the same sign in every run
    return v, sigma[:k] ** 2 / n, float((sigma ** 2).sum()) / n


def _project(n: int, sums: list[int], v: np.ndarray, e: np.ndarray):
    axes = v / np.sqrt(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.array(sums, object)
        for b in batches:
            for at, entries in _matrices(b):
                if entries.shape[1] != len(sums):
                    continue
                x = on_grid(entries)
                if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums)) < 2**62:
                    off = n * x - s.astype(np.int64)
                else:
                    off = n * x.astype(object) - s
                if int(np.abs(off).max(initial=0)) ** 2 * len(sums) < 2**63:
                    dev = pa.array((off.astype(np.int64) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
                else:
                    exact = (off.astype(object) ** 2).sum(axis=1)
                    dev = pa.array([Decimal(int(t)) if t < _WIDE else None for t in exact], pa.decimal128(38, 0))
                w = _centred(entries, n, sums) @ axes
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(at)), dev,
                     pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * len(e)), pa.array(w.ravel()))],
                    ["vec_id", "deviation", "whitened"])
    return run


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of the array column ``whitened`` minus the identity."""
    at = [F.col("whitened")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    r = white.agg(*[F.covar_pop(at[i], at[j]) for i, j in pairs]).first()  # centred before multiplying
    return max(abs(r[p] - (i == j)) for p, (i, j) in enumerate(pairs))


def whitened(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every vector and component.

    Uses the columns ``vector`` and ``key``; others are ignored, whatever their names. Rows are
    left out whose vector is null, empty, of another length than most, or holds a null or a
    non-finite entry (or one beyond 2^52 on the grid). Equal vectors and rows of one id are rows
    of their own; a null id is kept. Components with no variance are left out, so vectors that
    are all equal, and an empty table, give no rows. ``deviation`` is exact as decimal(38,0),
    null beyond it.
    """
    ship_package(rows.sparkSession)
    own = vectors(rows, vector, key)
    n, sums = fit_sums(own)
    v, e, trace = principal(own, n, sums, components) if n else (np.zeros((0, 0)), np.zeros(0), 0.0)
    if not len(e):
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    white = store(own.mapInArrow(_project(n, sums, v, e), "vec_id long, deviation decimal(38,0), whitened array<double>"), "whitened")
    error = identity_error(white, len(e))
    share = F.element_at(F.array(*[F.lit(float(x)) for x in e / trace]), F.col("component"))
    return (white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .withColumn("component", F.col("at") + 1)
            .select("vec_id", F.col("component").cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", share.alias("explained"), F.lit(error).alias("identity_error")))
