"""Whitening and hard negatives against numpy and plain loops, and on awkward rows."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x string, white int, Rank int, no int"


def frame(spark, rows):
    """Vectors with extra columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, v, label, 1, "x", 2, 3, 4) for i, v, label in rows], SCHEMA)


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)) @ np.diag(0.9 ** np.arange(d)) * 0.2 + rng.standard_normal(d)
    return [(i, [float(np.float32(c)) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(base)]


AWKWARD = [(None, None, 1), (None, [0.5, 0.25, -1.0], 1), (7, [1.0, None, 0.0], 1), (8, [1.0, float("nan"), 0.0], 2), (9, [1.0, float("inf"), 0.0], 2), (10, [], 3), (11, [1.0], None)]


def expected(rows, k):
    """Exact sums by Python numbers, eigenvectors by numpy."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v, _ in rows]
    n, d = len(x), len(x[0])
    s = [sum(col) for col in zip(*x)]
    v = np.array([[sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x) / n**3 for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    centred = np.array([[(n * a - b) / n for a, b in zip(r, s)] for r in x])
    return n, [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x], values, values / np.trace(v), centred @ axes / np.sqrt(values)


@pytest.mark.parametrize(("n", "d", "k"), [(300, 12, 8), (40, 3, 8), (200, 20, 4)])
def test_whitening_against_numpy(spark, n, d, k):
    from censuskit.llm.whitening import whiten

    rows = vectors(n, d) + [vectors(n, d)[5]]
    odd = [r for r in AWKWARD if r[1] is None or len(r[1]) != d or not all(c is not None and math.isfinite(c) for c in r[1])]
    got = whiten(frame(spark, rows + odd).repartition(5), k).collect()
    count, deviations, values, explained, white = expected(rows, k)
    assert len(got) == len(rows) * min(k, d) and {r.n for r in got} == {count}
    by = defaultdict(list)
    for r in got:
        by[r.vec_id, r.component].append(r)
    signs = {c: np.sign(by[0, c][0].whitened * white[0, c - 1]) for c in range(1, min(k, d) + 1)}
    for i, (vec_id, _, _) in enumerate(rows):
        for c, sign in signs.items():
            r = by[vec_id, c][0]
            assert r.deviation == deviations[i]
            assert r.whitened == pytest.approx(sign * white[i, c - 1], abs=1e-8)
            assert r.explained == pytest.approx(explained[c - 1], rel=1e-9) and r.identity_error < 1e-9
    assert len(by[5, 1]) == 2


def test_whitening_defined_results(spark):
    from censuskit.llm.whitening import whiten

    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, AWKWARD[2:6])).count() == 0
    same = whiten(frame(spark, [(1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)])).collect()
    assert len(same) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in same)
    flat = whiten(frame(spark, [(i, [float(i), 1.0, 3.0e38], 0) for i in range(5)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in flat) and {r.n for r in flat} == {5}
    assert max(r.identity_error for r in flat) < 1e-9
    tied = whiten(frame(spark, [(i, [1.0 * (j == i) for j in range(6)], 0) for i in range(6)])).collect()
    assert max(r.identity_error for r in tied) < 1e-9 and sum(r.whitened is None for r in tied) == 6


def test_feast_finds_every_eigenvalue():
    from censuskit.llm.whitening import above, feast, slices

    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    for values in (np.arange(40.0), np.repeat([1.0, 5.0, 9.0, 9.0 + 1e-9], 10), 0.5 ** np.arange(40), np.r_[np.zeros(30), np.full(10, 3.0)], 20 + np.arange(40) ** 0.5):
        v = q @ np.diag(values) @ q.T
        v = (v + v.T) / 2
        true = np.linalg.eigvalsh(v)
        assert above(v, 4.2) == (true > 4.2).sum() and above(v, 0.3) == (true > 0.3).sum()
        for lo, hi, count in slices(v, 8) + slices(v, 30) + slices(v, 40):
            got, x = feast(v, lo, hi, count)
            assert len(got) == count == ((true > lo) & (true <= hi)).sum() and np.abs(v @ x - x * got).max() < 1e-12 * true[-1]
            assert np.abs(x.T @ x - np.eye(count)).max() < 1e-12
        for k in (8, 30, 40):
            found = sorted(e for cut in slices(v, k) for e in feast(v, *cut)[0])[::-1]
            assert np.allclose(found[:k], true[::-1][:k], rtol=0, atol=1e-12 * true[-1])


def test_residue_products_are_exact():
    from censuskit.llm.hard_negatives import Residues

    rng = np.random.default_rng(2)
    for most, d in ((1, 1), (300, 64), (1 << 20, 130), (1 << 24, 200)):
        a, b = rng.integers(-most, most, (5, d), endpoint=True), rng.integers(-most, most, (9, d), endpoint=True)
        a[0], b[0], b[1] = most, most, -most
        gemm = Residues(most * most * d)
        assert (gemm.scores(gemm.of(a), gemm.of(b)) == (a.astype(object) @ b.T.astype(object)).astype(np.int64)).all()
    assert len(Residues(300 * 300 * 64).primes) == 3


def mined(rows, anchor, limit=1 << 28):
    """All pairs, one by one."""
    ok = [(i, [max(-limit, min(limit, math.floor(256 * float(np.float32(c))))) for c in v], label) for i, v, label in rows if label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    big = math.inf
    for a, (i, v, label) in enumerate(ok):
        if i is None or not anchor(i):
            continue
        others = [(-sum(p * q for p, q in zip(v, w)), big if j is None else j, other == label) for b, (j, w, other) in enumerate(ok) if b != a]
        others.sort(key=lambda o: o[:2])
        for s, p, _ in [o for o in others if o[2]][:5]:
            hard = [o for o in others if not o[2] and -30 * s <= -100 * o[0] <= -90 * s][:10]
            out += [(i, None if p == big else p, k, None if j == big else j, -s, -t) for k, (t, j, _) in enumerate(hard, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_block", [16_384, 50])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, rows_per_block):
    from censuskit.llm import hard_negatives as h

    monkeypatch.setattr(h, "ROWS", rows_per_block)
    monkeypatch.setattr(h, "ANCHORS", 7)
    monkeypatch.setattr(h, "AT_ONCE", 3)
    rows = vectors(300, 10, 3)
    rows += [(1000 + i, rows[20][1], rows[20][2]) for i in range(15)] + [(1100 + i, rows[21][1], (rows[20][2] + 1) % 4) for i in range(30)]
    rows += [(20, rows[20][1], rows[20][2]), (None, rows[20][1], rows[20][2]), (None, rows[22][1], 3), *AWKWARD, (400, [1.0], 0)]
    got = h.mine(h.mined_rows(frame(spark, rows).repartition(4)), F.col("vec_id") % 10 == 0).collect()
    want = mined(rows, lambda i: i % 10 == 0)
    assert want and sorted(map(tuple, got), key=str) == want


def test_hard_negatives_defined_results(spark):
    from censuskit.llm import hard_negatives as h

    assert h.mine(h.mined_rows(frame(spark, [])), F.col("vec_id") % 10 == 0).count() == 0
    assert h.mine(h.mined_rows(frame(spark, [(1, [1.0], 0)])), F.col("vec_id") % 10 == 0).count() == 0
    assert h.mine(h.mined_rows(frame(spark, [(10, [], 0), (20, [], 1), (30, [], 0)])), F.col("vec_id") % 10 == 0).count() == 2
    huge = [(i, [3e38 * (-1) ** (i // 3), 1e30, float(i)], i % 2) for i in range(40)]
    limit = int(math.sqrt(float(1 << 56) / 3))
    got = h.mine(h.mined_rows(frame(spark, huge)), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got), key=str) == mined(huge, lambda i: i % 10 == 0, limit)
