"""Nearest-neighbour information against plain loops; boosting stopped by later dates."""

import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from censuskit.operators import information, models


def psi(n):
    return sum(1 / i for i in range(1, n)) - 0.5772156649015329


def plain(rows, k):
    rows = [(x, y) for x, y in rows if x is not None and y is not None and not math.isnan(x)]
    size = Counter(y for _, y in rows)
    rows = [(x, y) for x, y in rows if size[y] > 1]
    terms = []
    for i, (x, y) in enumerate(rows):
        own = min(k, size[y] - 1)
        gaps = sorted(abs(x - v) for j, (v, c) in enumerate(rows) if c == y and j != i)
        d = gaps[own - 1]
        m = sum(v == x or x - d < v < x + d for v, _ in rows)
        terms.append((psi(own), psi(size[y]), psi(m)))
    if not rows:
        return 0.0
    mean = [sum(t) / len(rows) for t in zip(*terms)]
    return max(0.0, psi(len(rows)) + mean[0] - mean[1] - mean[2])


def test_digamma(spark):
    got = spark.range(1, 3000).select("id", information.digamma(F.col("id")).alias("v")).collect()
    assert all(r.v == pytest.approx(psi(r.id), abs=1e-9) for r in got)


@pytest.mark.parametrize("block", [4096, 5])
def test_mutual_information(spark, monkeypatch, block):
    monkeypatch.setattr(information.neighbour_distances, "__defaults__", (3, block))
    rng = random.Random(block)
    for kind in range(3):
        rows = []
        for _ in range(700):
            y = rng.choice("aaabbc")
            x = {0: rng.gauss(ord(y), 1.0), 1: float(rng.randrange(12)), 2: round(rng.gauss({"a": 0, "b": 3, "c": 9}[y], 1), 1)}[kind]
            rows.append((x, y))
        rows += [(1.0, "single"), (None, "a"), (2.0, None), (float("nan"), "b"), (1.0, "two"), (50.0, "two")]
        df = spark.createDataFrame(rows, "x double, y string").repartition(3)
        assert information.mutual_information(df, "x", "y") == pytest.approx(plain(rows, 3), abs=1e-9)
    assert information.mutual_information(df.limit(0), "x", "y") == 0.0


def made(spark, n, noise):
    rows = spark.range(n).select(F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"), F.expr("date_add(DATE'2024-01-01', cast(id % 100 as int))").alias("day"), F.rand(4).alias("u"))
    rows = rows.withColumn("label", (F.when(F.col("u") < noise, F.col("c")).otherwise((F.col("a") - 0.5) * (F.col("b") - 0.5) * 4 + 0.5) > 0.5).cast("double"))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)


def test_by_date_keeps_days_together(spark):
    got = models.by_date(made(spark, 3000, 0.0), "day", [0.6, 0.8]).groupBy("part").agg(F.min("day").alias("a"), F.max("day").alias("b"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    assert [r.part for r in got] == [0, 1, 2] and got[0].b < got[1].a and got[1].b < got[2].a
    assert [r.n / 3000 for r in got] == pytest.approx([0.6, 0.2, 0.2], abs=0.02)


def test_boosting_stops_by_later_dates(spark):
    late = lambda df: models.by_date(df, "day", [0.75]).withColumn("late", F.col("part") == 1).cache()
    clear = models.boosted(40, step=0.3).fit(late(made(spark, 2000, 0.0)))
    noise = models.boosted(40, step=0.3).fit(late(made(spark, 2000, 1.1).withColumn("label", (F.rand(9) > 0.5).cast("double"))))
    assert noise.getNumTrees < 10 < clear.getNumTrees


def test_search_takes_the_best_on_the_latest_dates(spark):
    rows = made(spark, 1500, 0.2)
    tried, best = models.search(rows, "day", trials=3, rounds=6)
    assert len(tried) == 3 and len({(t["depth"], t["step"]) for t in tried}) == 3
    later = models.by_date(rows, "day", [0.6, 0.8]).filter("part = 2")
    assert models.auc(best.transform(later)) == pytest.approx(max(t["auc"] for t in tried), abs=1e-9)


def test_search_decodes_its_rows_once_for_all_trials(spark, monkeypatch):
    seen, plain = [], models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, rows: seen.append((rows, rows.storageLevel.useMemory)) or plain(self, rows))
    tried, _ = models.search(made(spark, 600, 0.2), "day", trials=2, rounds=2)
    assert len(tried) == 2 and [kept for _, kept in seen] == [True, True]
    assert not any(rows.storageLevel.useMemory for rows, _ in seen), "rows stay in memory after the search"
