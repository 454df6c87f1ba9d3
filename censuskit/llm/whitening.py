"""Embedding whitening by FEAST contour integration.

Entries c become integers floor(1024 c) + 100000, so that sums are exact and do not depend on
how rows are dealt out. Three passes over the vectors, each with one small result a task:

1. Sums for each dimension (and vector length) give n and S.
2. Vectors are centred by whole numbers near S / n before they are multiplied; the integer
   products are summed exactly, and the covariance V is the exact quotient, rounded once.
3. Vectors are projected on the components.

The spectrum of V is cut into slices by inertia counts: a symmetric L D L' factorisation of
V - s I has as many positive pivots as V has eigenvalues above s. Each slice is one row of a
Spark job. Its task integrates the resolvent along a half circle around the slice: Gauss
points z, a complex solve (z I - V) for a block of vectors at each, and their weighted sum is
nearly the projection onto the slice's eigenvectors. Rayleigh-Ritz takes the components from
the block, which is filtered again until residuals are at rounding level. The number of
eigenvalues found has to be the inertia count, or the slice is done again with a larger block.
A last Rayleigh-Ritz step over all slices makes the components orthonormal.

What the driver and each task hold are d x d numbers for vectors of length d, whatever the
number of rows.

Defined results: rows whose vector is null, or holds a null or a non-finite entry, take no
part; nor do vectors of another length than the most common one (of equally common lengths,
the larger). Rows without an id or with one that others have are rows like all others. An
entry beyond 2 ** 52 / 1024 in magnitude counts as that. Where a component has no variance
(eigenvalue at most 1e-12 of the largest), ``whitened`` is null and the component is left out
of ``identity_error``; where no component has any, ``explained`` and ``identity_error`` are
null. ``deviation`` is null where it has over 38 digits. Vectors of fewer dimensions than
components asked for have one component for each. Repeated rows count each time. An empty
table gives an empty result. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from censuskit.llm.common import stash

SCALE, SHIFT, LIMIT = 1024, 100_000, 1 << 52
#: Quadrature points on the half circle, filter steps at most, and eigenvalues a slice should have.
POINTS, STEPS, SLICE = 8, 30, 8
_DIGITS = pa.decimal128(38, 0)
_ROWS = 4096


def vectors_of(column: pa.Array, scale: int, shift: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors: positions in column, and floor(scale c) + shift of their
    entries. Null vectors and those with null or non-finite entries are left out."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    there = ~np.isnan(lengths) if lengths.dtype.kind == "f" else np.ones(len(column), bool)
    lengths = np.where(there, lengths, 0).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = there & (bad[ends] == bad[ends - lengths])
    for d in np.unique(lengths[good]):
        at = np.flatnonzero(good & (lengths == d))
        entries = flat[(ends[at] - d)[:, None] + np.arange(d)]
        yield at, np.clip(np.floor(scale * entries), -limit, limit).astype(np.int64) + shift


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _longs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    return vectors_of(column, SCALE, SHIFT, LIMIT)


def _whole(x: np.ndarray, terms: int) -> np.ndarray:
    """x as it is where sums of so many entries fit into 64 bits, else as Python numbers."""
    return x if int(np.abs(x).max(initial=0)) * max(1, terms) < 1 << 62 else x.astype(object)


def column_sums(vectors: DataFrame) -> tuple[int, list[int]] | None:
    """n and the sums of each dimension over the vectors (column v); None without any."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, list[int]]] = {}
        for batch in _pieces(batches):
            for _, x in _longs(batch.column("v")):
                n, s = sums.get(x.shape[1], (0, [0] * x.shape[1]))
                sums[x.shape[1]] = n + len(x), [a + int(b) for a, b in zip(s, _whole(x, len(x)).sum(axis=0), strict=True)]
        rows = [(d, i, n, v) for d, (n, s) in sums.items() for i, v in [(-1, 0), *enumerate(s)]]
        yield pa.RecordBatch.from_arrays([*[pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], pa.array([Decimal(r[3]) for r in rows], _DIGITS)], ["d", "i", "n", "s"])

    parts = vectors.mapInArrow(work, "d long, i long, n long, s decimal(38,0)")
    sums = stash(parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")), "whitening-sums")
    top = sums.filter("i = -1").orderBy(F.desc("n"), F.desc("d")).first()
    if top is None or not top.d:
        return None
    found = {r.i: int(r.s) for r in sums.filter((F.col("d") == top.d) & (F.col("i") >= 0)).collect()}
    return top.n, [found[i] for i in range(top.d)]


def _products(z: np.ndarray) -> np.ndarray:
    """Exact z'z: by float64 where every sum stays below 2 ** 53, else by Python numbers."""
    most = int(np.abs(z).max(initial=0))
    if most * most * len(z) < 1 << 53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if most * most < 1 << 52:
        step = max(1, (1 << 52) // max(1, most * most))
        return sum(_products(z[i : i + step]) for i in range(0, len(z), step))
    o = z.astype(object)
    return o.T @ o


def covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the vectors of that length, divisor n, each entry rounded once."""
    d, centre = len(sums), np.array([s // n for s in sums], np.int64)
    i, j = np.triu_indices(d)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in _pieces(batches):
            for _, x in _longs(batch.column("v")):
                if x.shape[1] == d:
                    total = total + _products(x - centre)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array([Decimal(int(v)) for v in total[i, j]], _DIGITS)], ["i", "j", "s"])

    parts = vectors.mapInArrow(work, "i long, j long, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s"))
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    out = np.zeros((d, d))
    for r in parts.collect():
        out[r.i, r.j] = out[r.j, r.i] = (n * int(r.s) - rest[r.i] * rest[r.j]) / (n * n)
    return out


def above(v: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of the symmetric v above shift: positive pivots of L D L', with
    pivots of one or two rows chosen from all that is left."""
    a, n = v - shift * np.eye(len(v)), 0
    while len(a):
        k = int(np.argmax(np.abs(np.diag(a))))
        p, q = np.unravel_index(int(np.argmax(np.abs(np.triu(a, 1)))), a.shape) if len(a) > 1 else (0, 0)
        one = abs(a[k, k]) >= 0.6404 * abs(a[p, q])
        rows = [k] if one or p == q else [p, q]
        block = a[np.ix_(rows, rows)]
        if not block.any():
            return n
        n += int(block[0, 0] > 0) if len(rows) == 1 else 1  # an indefinite pair has one of each sign
        rest = np.setdiff1d(np.arange(len(a)), rows)
        b = a[np.ix_(rest, rows)]
        a = a[np.ix_(rest, rest)] - b @ np.linalg.solve(block, b.T)
        a = (a + a.T) / 2
    return n


def _settled(v: np.ndarray, shift: float, size: float) -> float:
    """shift, lowered until no eigenvalue is so near that rounding could put it on either side."""
    near = 1e-10 * size
    while above(v, shift - near) != above(v, shift + near):
        shift -= 3 * near
    return shift


def slices(v: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """Intervals (lo, hi] that hold the k largest eigenvalues of v, with their counts."""
    size = float(np.abs(v).sum(axis=1).max())
    hi, lo = size * (1 + 1e-9), -size * 1e-6
    few, many = hi, lo  # fewer than k eigenvalues are above few, k or more above many
    for _ in range(50):
        mid = (few + many) / 2
        many, few = (mid, few) if (n := above(v, mid)) >= k else (many, mid)
        if k <= n <= k + 2:
            break
    many = _settled(v, many, size)
    out, todo = [], [(many, hi, above(v, many), 40)]
    while todo:
        a, b, n, left = todo.pop()
        if n > SLICE and left and b - a > 1e-6 * size:
            mid = max(a, _settled(v, (a + b) / 2, size))
            m = above(v, mid) - above(v, b)
            todo += [(a, mid, n - m, left - 1), (mid, b, m, left - 1)] if mid > a else [(a, b, n, 0)]
        elif n:
            out.append((a, b, n))
    return out


def feast(v: np.ndarray, lo: float, hi: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues in (lo, hi], of which there are count, and their vectors as columns."""
    d, size = len(v), float(np.abs(v).sum(axis=1).max())
    x, weights = np.polynomial.legendre.leggauss(POINTS)
    turns = np.exp(1j * np.pi / 2 * (1 - x))
    middle, radius = (lo + hi) / 2, (hi - lo) / 2
    width = min(d, 2 * count + 4)
    while True:
        y, best = np.random.default_rng(width).standard_normal((d, width)), np.inf
        for _ in range(STEPS):
            q = sum(w / 2 * (radius * t * np.linalg.solve((middle + radius * t) * np.eye(d) - v, y)).real for t, w in zip(turns, weights, strict=True))
            q = np.linalg.qr(q)[0] if width < d else np.eye(d)
            values, inner = np.linalg.eigh(q.T @ v @ q)
            y = q @ inner
            inside = (values > lo) & (values <= hi)
            worst = float(np.linalg.norm(v @ y[:, inside] - y[:, inside] * values[inside], axis=0).max(initial=0)) / size
            if inside.sum() == count and (worst < 1e-15 or best <= worst < 1e-12):
                return values[inside], y[:, inside]
            best = worst if inside.sum() == count else np.inf
            if width == d and inside.sum() != count:
                break
        if width == d:
            raise ArithmeticError(f"{count} eigenvalues lie in ({lo}, {hi}], not all of them were found")
        width = min(d, 2 * width)


def components(spark, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of v, falling, and their unit vectors as columns; each slice of
    the spectrum is worked on in a task of its own."""
    k = min(k, len(v))
    if not np.trace(v) > 0:
        return np.zeros(k), np.eye(len(v))[:, :k]
    cuts = slices(v, k)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, count in zip(*[batch.column(c).to_pylist() for c in ("lo", "hi", "count")], strict=True):
                _, vectors = feast(v, lo, hi, count)
                yield pa.RecordBatch.from_arrays([pa.array(list(vectors.T), pa.list_(pa.float64()))], ["vector"])

    rows = spark.createDataFrame(cuts, "lo double, hi double, count int").repartition(len(cuts)).mapInArrow(work, "vector array<double>").collect()
    q = np.linalg.qr(np.array([r.vector for r in rows]).T)[0]
    values, inner = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(values)[::-1][:k]
    return values[order], q @ inner[:, order]


def whiten(vectors: DataFrame, k: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: vec_id, component, n, deviation (decimal),
    whitened, eigenvalue, explained, identity_error."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    found = column_sums(rows.select("v"))
    if found is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, eigenvalue double, explained double, identity_error double")
    n, sums = found
    v = covariance(rows.select("v"), n, sums)
    values, axes = components(spark, v, k)
    alive = values > 1e-12 * max(values[0], 0) if values[0] > 0 else np.zeros(len(values), bool)
    d, centre = len(sums), np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    part = np.array([r / n for r in rest])
    scaled = axes[:, alive] / np.sqrt(values[alive])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            for at, x in _longs(batch.column("v")):
                if x.shape[1] == d:
                    z = x - centre
                    most = n * (int(np.abs(z).max(initial=0)) + 1)
                    t = (z if d * most * most < 1 << 62 else z.astype(object)) * n - (np.array(rest, np.int64) if d * most * most < 1 << 62 else np.array(rest, object))
                    deviation = [Decimal(s) if (s := int(r)) < 10**38 else None for r in (t * t).sum(axis=1)]
                    white = np.full((len(z), len(values)), np.nan)
                    white[:, alive] = (z - part) @ scaled
                    arrays = [batch.column("vec_id").take(pa.array(at)), pa.array(deviation, _DIGITS), pa.array(list(white), pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "deviation", "white"])

    white = stash(rows.mapInArrow(work, "vec_id long, deviation decimal(38,0), white array<double>"), "whitening-rows")
    live = [int(i) for i in np.flatnonzero(alive)]
    error = None
    if live:
        off = [F.abs(F.covar_pop(F.col("white")[a], F.col("white")[b]) - float(a == b)).alias(f"c{a}_{b}") for a in live for b in live if a <= b]
        error = max(white.agg(*off).first())
    explained = [float(e / np.trace(v)) if live else None for e in values]
    each = F.array(*[F.struct(F.lit(i + 1).alias("component"), (F.col("white")[i] if alive[i] else F.lit(None).cast("double")).alias("whitened"), F.lit(float(e)).alias("eigenvalue"), F.lit(x).cast("double").alias("explained")) for i, (e, x) in enumerate(zip(values, explained, strict=True))])
    return white.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", F.inline(each), F.lit(error).cast("double").alias("identity_error"))
