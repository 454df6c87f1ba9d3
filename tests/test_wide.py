"""Wide frames against numpy and DuckDB."""

import math
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from censuskit.operators import wide


def columns(rng, n):
    """Ties, gaps, signs, huge and tiny numbers, constants and emptiness."""
    x = {
        "normal": rng.standard_normal(n) * 1e3, "ties": rng.integers(-3, 4, n).astype(float), "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.random(n)),
        "huge": rng.standard_normal(n) * 10.0 ** rng.integers(-200, 200, n), "fixed": np.full(n, 7.25), "none": np.full(n, np.nan), "zeros": np.where(rng.random(n) < 0.8, 0.0, -1.5), "far": 1e9 + rng.random(n),
    }
    x["near"] = x["normal"] + rng.standard_normal(n)
    return x


@pytest.fixture(scope="module")
def made(spark):
    x = columns(np.random.default_rng(0), 4000)
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in zip(*x.values())]
    return x, spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in x)).repartition(5)


@pytest.mark.parametrize("few", [100_000, 20])
def test_quantiles(made, few):
    x, df = made
    shares = [0.0, 0.003, 0.25, 0.5, 0.77, 1.0]
    got = wide.quantiles(df, list(x), shares, few)
    for c, v in x.items():
        v = v[~np.isnan(v)]
        assert got[c] == ([None] * 6 if not len(v) else pytest.approx([float(np.quantile(v, p)) for p in shares], rel=1e-12))


def test_quantiles_of_no_rows(made):
    x, df = made
    assert wide.quantiles(df.limit(0), list(x), [0.5]) == {c: [None] for c in x}


def test_correlations(made):
    x, df = made
    got = {(r.a, r.b): r for r in wide.correlations(df, list(x)).collect()}
    names = list(x)
    assert set(got) == {(a, b) for i, a in enumerate(names) for b in names[i + 1 :]}
    for (a, b), r in got.items():
        both = ~np.isnan(x[a]) & ~np.isnan(x[b])
        assert r.n == both.sum()
        if "fixed" in (a, b) or "none" in (a, b):
            assert r.r is None
        elif "huge" not in (a, b):
            assert r.r == pytest.approx(np.corrcoef(x[a][both], x[b][both])[0, 1], abs=1e-7)
    one = {r.b: r for r in wide.correlations(df, names, target="ties").collect()}
    assert set(one) == set(names) - {"ties"} and one["gaps"].r == pytest.approx(got["ties", "gaps"].r, abs=1e-12)


def test_modes_and_profile(made):
    x, df = made
    got = {r.col: r for r in wide.profile(df, list(x)).collect()}
    assert set(got) == set(x) and got["none"].mode is None and got["none"].skew is None and got["none"].null_pct == 100
    assert got["fixed"].mode == 7.25 and got["fixed"].mode_pct == 100
    values, counts = np.unique(x["ties"][x["ties"] != 0], return_counts=True)
    assert got["ties"].mode == values[counts == counts.max()].min() and got["ties"].mode_pct == pytest.approx(100 * counts.max() / counts.sum(), abs=1e-4)
    assert got["zeros"].mode == -1.5 and got["zeros"].zero_pct == pytest.approx(100 * (x["zeros"] == 0).mean(), abs=1e-4)


def test_all_pairs_of_a_wide_table(spark, tmp_path):
    """All pairs of 3,500 columns with CENSUSKIT_ALL (three minutes), else of 500; a sample of them
    against DuckDB."""
    rng, k, n = np.random.default_rng(1), 3500 if os.environ.get("CENSUSKIT_ALL") else 500, 500
    x = rng.integers(0, 50, (n, k)).astype(np.float64) + rng.standard_normal((n, 1)) * 5
    x[rng.random((n, k)) < 0.01] = np.nan
    path = str(tmp_path / "wide.parquet")
    pq.write_table(pa.table([pa.array(x[:, i], from_pandas=True) for i in range(k)], [f"x{i}" for i in range(k)]), path)
    df = spark.read.parquet(path)
    pick = random.Random(1)
    some = sorted({tuple(sorted(pick.sample(range(k), 2))) for _ in range(60)} | {(0, 1), (0, k - 1), (k - 2, k - 1), (127, 128)})
    pairs = wide.correlations(df, df.columns).cache()
    assert pairs.count() == k * (k - 1) // 2
    got = {(r.a, r.b): (r.n, r.r) for r in pairs.filter(F.concat_ws(",", "a", "b").isin([f"x{a},x{b}" for a, b in some])).collect()}
    want = duckdb.connect().execute(f"SELECT {', '.join(f'count(x{a} + x{b}), corr(x{a}, x{b})' for a, b in some)} FROM '{path}'").fetchone()
    for i, (a, b) in enumerate(some):
        assert got[f"x{a}", f"x{b}"] == (want[2 * i], pytest.approx(want[2 * i + 1], abs=1e-9))
    pairs.unpersist()


def test_quantiles_take_few_passes(spark, monkeypatch):
    passes = []
    whole = wide._target_sums
    monkeypatch.setattr(wide, "_target_sums", lambda *a: passes.append(1) or whole(*a))
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1e6, 3000)
    df = spark.createDataFrame([(float(v), float(round(v / 1e5))) for v in x], "a double, b double")
    got = wide.quantiles(df, ["a", "b"], [0.01, 0.5, 0.9], few=5)
    assert got["a"] == pytest.approx(np.quantile(x, [0.01, 0.5, 0.9])) and got["b"] == pytest.approx(np.quantile(np.round(x / 1e5), [0.01, 0.5, 0.9]))
    assert len(passes) <= 7
