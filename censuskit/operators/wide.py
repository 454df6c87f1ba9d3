"""Statistics of frames with thousands of columns: pairs of columns, exact quantiles, modes.

Columns are read as blocks of doubles from Arrow batches; null and NaN are missing. A task adds
up what it reads and returns one vector for a column (or a block of pairs), and vectors are
summed with a map-side combine: no plan has an expression per column or pair, and no task sees
a whole column. What the driver gets is a few numbers for each column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window as W, functions as F

#: Columns of one block of pairs, bytes of sums that a task holds, and cells read at a time.
BLOCK, HELD, CELLS = 128, 128 << 20, 4 << 20
#: Values of one quantile's range that are counted one by one; wider ranges are narrowed first.
FEW = 100_000
#: Ranges that a range is cut into when it is narrowed: at least and at most, and bytes of their counts.
_FINE, _FINEST, _COUNTS = 64, 1024, 8 << 20


def blocks(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[np.ndarray]:
    """Rows by columns as doubles, NaN where there is no value."""
    k = max(1, len(names))
    for batch in batches:
        for start in range(0, batch.num_rows, max(64, CELLS // k)):
            yield batch.column("x").slice(start, max(64, CELLS // k)).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _plain(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns as one array x, in as many partitions as are worked on at a time or a few times
    that: each task then returns its sums once for many input splits."""
    cells = [F.col(f"`{c}`").cast("double") for c in names]
    return df.select(F.array(*cells).cast("array<double>").alias("x")).coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def _summed(parts: DataFrame, *keys: str) -> DataFrame:
    """The vectors v of each key, added up; up to rounding, so that counts have to be rounded."""
    return parts.withColumn("v", array_to_vector("v")).groupBy(*keys).agg(Summarizer.sum(F.col("v")).alias("v")).withColumn("v", vector_to_array("v"))


def column_sums(df: DataFrame, names: Sequence[str], fn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all rows of fn's result: of a block (rows by columns), some numbers for each column."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in blocks(batches, names):
            total = fn(x) if total is None else total + fn(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    rows = _summed(_plain(df, names).mapInArrow(work, "i int, v array<double>"), "i").collect()
    out = np.zeros((len(names), fn(np.zeros((0, len(names)))).shape[1]))
    for r in rows:
        out[r.i] = r.v
    return out


def _counts_and_means(df: DataFrame, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    n, s = column_sums(df, names, lambda x: np.stack([(~np.isnan(x)).sum(axis=0), np.nansum(x, axis=0)], axis=1)).T[:2] if names else (np.zeros(0), np.zeros(0))
    n = np.rint(n)
    return n, np.divide(s, n, out=np.zeros(len(names)), where=n > 0)


def correlations(df: DataFrame, names: Sequence[str], target: str | None = None) -> DataFrame:
    """a, b, n (rows with both values) and r, Pearson's correlation over these rows: of all pairs
    of columns, or of each column (b) with target (a). r is null without variance.

    Columns are centred by their means first. Each task holds sums of products of column blocks,
    for the pairs of some blocks at a time where all of them would be too large."""
    names = list(dict.fromkeys([target, *names] if target else names))
    k = len(names)
    _, shift = _counts_and_means(df, names)
    starts = [0] if target else list(range(0, k, BLOCK))
    turns = max(1, ceil(6 * 8 * sum(k - s for s in starts) * min(BLOCK, k) / HELD)) if not target else 1

    def part(mine: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wide = {s: 1 if target else min(BLOCK, k - s) for s in mine}
            sums = {s: np.zeros((6, wide[s], k - s)) for s in mine}
            some = False
            for x in blocks(batches, names):
                some, x = True, x - shift
                there = ~np.isnan(x)
                whole = bool(there.all())
                if not whole:
                    x, there = np.where(there, x, 0.0), there.astype(np.float64)
                square, total = x * x, x.sum(axis=0)
                for s in mine:
                    a, b, out = slice(s, s + wide[s]), slice(s, k), sums[s]
                    if whole:
                        out[0] += len(x)
                        out[1] += total[a, None]
                        out[2] += total[b]
                        out[3] += square[:, a].sum(axis=0)[:, None]
                        out[4] += square[:, b].sum(axis=0)
                    else:
                        out[0] += there[:, a].T @ there[:, b]
                        out[1] += x[:, a].T @ there[:, b]
                        out[2] += there[:, a].T @ x[:, b]
                        out[3] += square[:, a].T @ there[:, b]
                        out[4] += there[:, a].T @ square[:, b]
                    out[5] += x[:, a].T @ x[:, b]
            if some:
                for s in mine:
                    vectors = sums[s].transpose(1, 0, 2).reshape(wide[s], -1)
                    yield pa.RecordBatch.from_arrays([pa.array(range(s, s + wide[s]), pa.int32()), pa.array([s] * wide[s], pa.int32()), pa.array(list(vectors), pa.list_(pa.float64()))], ["a", "start", "v"])

        return work

    parts = None
    for turn in range(turns):
        some = _plain(df, names).mapInArrow(part(starts[turn::turns]), "a int, start int, v array<double>")
        parts = some if parts is None else parts.unionByName(some)
    rows = _summed(parts, "a", "start")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, start, v in zip(*[batch.column(c) for c in ("a", "start", "v")], strict=True):
                a, start = a.as_py(), start.as_py()
                m, sx, sy, xx, yy, xy = v.values.to_numpy(zero_copy_only=False).reshape(6, k - start)[:, a - start + 1 :]
                m = np.rint(m)
                with np.errstate(divide="ignore", invalid="ignore"):
                    vx, vy = xx - sx * sx / m, yy - sy * sy / m
                    r = np.where((m > 0) & (vx > 1e-12 * xx) & (vy > 1e-12 * yy), (xy - sx * sy / m) / np.sqrt(vx * vy), np.nan)
                b = np.arange(a + 1, k, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), a, np.int32)), pa.array(b), pa.array(m.astype(np.int64)), pa.array(r, from_pandas=True)], ["a", "b", "n", "r"])

    named = F.array(*map(F.lit, names))
    pairs = rows.mapInArrow(finish, "a int, b int, n long, r double")
    return pairs.select(F.get(named, F.col("a")).alias("a"), F.get(named, F.col("b")).alias("b"), "n", "r")


def _ordered(x: np.ndarray | float) -> np.ndarray:
    """Doubles as integers of the same order."""
    u = (np.asarray(x, np.float64) + 0.0).view(np.int64)
    return np.where(u < 0, np.int64(-(2**63)) - u, u)


def _double(key: int) -> float:
    return float(np.array(key if key >= 0 else -(2**63) - key, np.int64).view(np.float64))


def quantiles(df: DataFrame, names: Sequence[str], shares: Sequence[float], few: int = FEW) -> dict[str, list[float | None]]:
    """Exact quantiles, between two values by linear interpolation; None for empty columns.

    The ranks wanted of each column are looked for in ranges: one pass counts the values below
    and in 64 to 1024 parts of each range, and the part with the rank is the next range, until at most
    ``few`` values or one value are left in it. The last pass counts these one by one."""
    n, _ = _counts_and_means(df, names)
    ranks = lambda p, m: (floor(p * (m - 1)), ceil(p * (m - 1)))
    wanted = [(i, rank) for i in range(len(names)) if n[i] for rank in sorted({r for p in shares for r in ranks(p, n[i])})]
    if not wanted:
        return {c: [None] * len(shares) for c in names}
    column, rank = np.array([w[0] for w in wanted]), np.array([w[1] for w in wanted], np.int64)
    ends = _ends(df, names)
    lo, hi = _ordered(ends[column, 0]), _ordered(ends[column, 1])
    below, inside = np.zeros(len(rank), np.int64), n[column].astype(np.int64)
    while len(turn := np.flatnonzero((inside > few) & (lo < hi))):
        fine = max(_FINE, min(_FINEST, _COUNTS // (8 * len(turn))))
        cuts = [[int(lo[j]) + (int(hi[j]) - int(lo[j])) * k // fine for k in range(1, fine)] for j in turn]
        # ranks of a column that are still in one range are counted once
        ranges = list(dict.fromkeys((int(column[j]), int(lo[j]), int(hi[j])) for j in turn))
        place = {r: k for k, r in enumerate(ranges)}
        edges = {place[int(column[j]), int(lo[j]), int(hi[j])]: np.array(c, np.int64) for j, c in zip(turn, cuts, strict=True)}

        def counted(x: np.ndarray, ranges: list = ranges, edges: dict = edges, fine: int = fine) -> np.ndarray:
            out = np.zeros((len(ranges), fine + 1))
            keys, last = np.zeros(0, np.int64), -1
            for k, (i, a, b) in enumerate(ranges):  # ranges of a column stand together
                if i != last:
                    keys, last = _ordered(x[~np.isnan(x[:, i]), i]), i
                within = keys[(keys >= a) & (keys <= b)]
                out[k, 0] = np.count_nonzero(keys < a)
                out[k, 1:] = np.bincount(np.searchsorted(edges[k], within), minlength=fine)
            return out

        got = np.rint(_target_sums(df, names, counted)).astype(np.int64)
        for j, c in zip(turn, cuts, strict=True):
            counts = got[place[int(column[j]), int(lo[j]), int(hi[j])]]
            upto, bounds = np.cumsum(counts), [int(lo[j]) - 1, *c, int(hi[j])]
            part = int(np.searchsorted(upto[1:], rank[j], side="right"))
            lo[j], hi[j], below[j], inside[j] = bounds[part] + 1, bounds[part + 1], upto[part], counts[part + 1]

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in blocks(batches, names):
            keys, last = np.zeros(0, np.int64), -1
            for j, i in enumerate(column):
                if i != last:
                    keys, last = _ordered(x[~np.isnan(x[:, i]), i]), i
                values, counts = np.unique(keys[(keys >= lo[j]) & (keys <= hi[j])], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), j, np.int32)), pa.array(values), pa.array(counts)], ["j", "key", "n"])

    rows = _plain(df, names).mapInArrow(kept, "j int, key long, n long").groupBy("j", "key").agg(F.sum("n").alias("n"))
    upto = W.partitionBy("j").orderBy("key").rowsBetween(W.unboundedPreceding, 0)
    offsets = df.sparkSession.createDataFrame([(j, int(r - b)) for j, (r, b) in enumerate(zip(rank, below, strict=True))], "j int, place long")
    found = {(int(column[r.j]), int(rank[r.j])): _double(r.key) for r in rows.withColumn("upto", F.sum("n").over(upto)).join(F.broadcast(offsets), "j").filter("place < upto").groupBy("j").agg(F.min("key").alias("key")).collect()}

    def between(i: int, p: float) -> float:
        h = p * (n[i] - 1)
        a, b = found[i, floor(h)], found[i, ceil(h)]
        return float(a + (h - floor(h)) * (b - a))

    return {c: [between(i, p) if n[i] else None for p in shares] for i, c in enumerate(names)}


def _target_sums(df: DataFrame, names: Sequence[str], fn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all rows of fn's matrix, whose rows need not be columns of the frame."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in blocks(batches, names):
            total = fn(x) if total is None else total + fn(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    rows = _summed(_plain(df, names).mapInArrow(work, "i int, v array<double>"), "i").collect()
    return np.array([r.v for r in sorted(rows, key=lambda r: r.i)])


def _ends(df: DataFrame, names: Sequence[str]) -> np.ndarray:
    """The smallest and largest value of each column (NaN for none)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in blocks(batches, names):
            empty = np.isnan(x).all(axis=0)
            low, top = np.where(empty, np.nan, np.nanmin(np.where(empty, 0, x), axis=0)), np.where(empty, np.nan, np.nanmax(np.where(empty, 0, x), axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(~empty), pa.int32()), pa.array(low[~empty]), pa.array(top[~empty])], ["i", "low", "top"])

    out = np.full((len(names), 2), np.nan)
    for r in _plain(df, names).mapInArrow(work, "i int, low double, top double").groupBy("i").agg(F.min("low").alias("low"), F.max("top").alias("top")).collect():
        out[r.i] = r.low, r.top
    return out


def modes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """col, the most common value that is neither missing nor 0 (the smallest of equally common
    ones), and its share of such values in percent. Tasks count the values of each block that they
    read, all columns at once; these counts are added up, and the most common of each column is taken."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in blocks(batches, names):
            for i in range(len(names)):
                values, n = np.unique(x[(x[:, i] != 0) & ~np.isnan(x[:, i]), i], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), i, np.int32)), pa.array(values), pa.array(n)], ["i", "value", "n"])

    counts = _plain(df, names).mapInArrow(counted, "i int, value double, n long").groupBy("i", "value").agg(F.sum("n").alias("n"))
    top = counts.groupBy("i").agg(F.max(F.struct("n", (-F.col("value")).alias("back"))).alias("top"), F.sum("n").alias("total"))
    named = F.get(F.array(*map(F.lit, names)), F.col("i"))
    return top.select(named.alias("col"), (-F.col("top.back")).alias("mode"), (100.0 * F.col("top.n") / F.col("total")).alias("mode_pct"))


def profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per column: percentages of missing, zero and outlying values (beyond 1.5 interquartile
    ranges) of all rows, bias-corrected skewness, the most common non-zero value and its share."""
    quartiles = quantiles(df, names, [0.25, 0.75])
    n, mean = _counts_and_means(df, names)
    edges = [(a - 1.5 * (b - a), b + 1.5 * (b - a)) if a is not None else (0.0, 0.0) for a, b in (quartiles[c] for c in names)]
    low, high = np.array([e[0] for e in edges]), np.array([e[1] for e in edges])

    def moments(x: np.ndarray) -> np.ndarray:
        y = np.nan_to_num(x - mean)
        return np.stack([np.full(x.shape[1], len(x)), (x == 0).sum(axis=0), ((x < low) | (x > high)).sum(axis=0), (y * y).sum(axis=0), (y * y * y).sum(axis=0)], axis=1)

    rows = []
    for c, k, (total, zeros, out, m2, m3) in zip(names, n, column_sums(df, names, moments), strict=True):
        skew = (k * (k - 1)) ** 0.5 / (k - 2) * (m3 / k) / (m2 / k) ** 1.5 if k > 2 and m2 > 0 else None
        total, zeros, out = round(total), round(zeros), round(out)
        share = lambda v, total=total: float(100.0 * v / total) if total else None
        rows.append((c, share(total - k), share(zeros), share(out), None if skew is None else float(skew)))
    told = df.sparkSession.createDataFrame(rows, "col string, null_pct double, zero_pct double, outlier_pct double, skew double")
    return told.join(modes(df, names), "col", "left").select("col", *[F.round(c, 4).alias(c) for c in ("null_pct", "zero_pct", "outlier_pct", "skew")], "mode", F.round("mode_pct", 4).alias("mode_pct"))
