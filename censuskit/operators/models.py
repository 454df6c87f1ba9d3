"""Fitting and scoring on all rows: boosting that stops by later dates, search over parameters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from random import Random

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, functions as F

from censuskit.operators.frames import written

#: Boosting rounds at most; the error on later rows ends them before.
ROUNDS = 300


def cross_fitted(rows: DataFrame, key: str, estimator, folds: int = 2) -> DataFrame:
    """All rows, each scored by a model fitted on the other folds; rows of one key share a fold."""
    dealt = rows.withColumn("fold", F.pmod(F.xxhash64(key), F.lit(folds)))
    scored = [estimator.fit(dealt.filter(F.col("fold") != i)).transform(dealt.filter(F.col("fold") == i)) for i in range(folds)]
    return reduce(DataFrame.unionByName, scored)


def by_date(rows: DataFrame, date: str, shares: Sequence[float], name: str = "part") -> DataFrame:
    """rows with the number of their part: earliest days first, cut after the given shares of rows,
    whole days together. Rows without a date are in the first part."""
    day = F.unix_date(F.to_date(date))
    cuts = rows.agg(F.percentile_approx(day, list(shares), 10_000)).first()[0] or []
    return rows.withColumn(name, F.coalesce(reduce(lambda a, c: a + (day > c).cast("int"), cuts, F.lit(0)), F.lit(0)))


def boosted(rounds: int = ROUNDS, depth: int = 3, step: float = 0.1, subsample: float = 1.0, tolerance: float = 0.001, late: str = "late", seed: int = 1) -> GBTClassifier:
    """Boosted trees that learn from rows that are not late, and stop when another round no longer
    lowers the error on late ones by tolerance of it."""
    return GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=subsample, validationIndicatorCol=late, validationTol=tolerance, seed=seed)


def auc(scored: DataFrame) -> float:
    return BinaryClassificationEvaluator().evaluate(scored)


def search(rows: DataFrame, date: str, trials: int, rounds: int = ROUNDS, seed: int = 5) -> tuple[list[dict], GBTClassificationModel]:
    """Boosting parameters drawn at random, with a fixed seed. Each trial learns from the earliest
    60 % of the rows, stops by the next 20 %, and is measured on the last 20 %; the trials and the
    model of the best one. rows: features, label and a date."""
    parts = written(by_date(rows, date, [0.6, 0.8]).withColumn("late", F.col("part") == 1), "search-rows")
    known, later = parts.filter("part < 2"), parts.filter("part = 2")
    # kept decoded for all trials, in memory or on local disk; a lost part is read from the table again
    known = known.select("features", "label", "late").persist()
    draw, tried, best = Random(seed), [], None
    try:
        for _ in range(trials):
            chosen = {"depth": draw.randint(2, 5), "step": round(draw.uniform(0.05, 0.3), 3), "subsample": round(draw.uniform(0.6, 1.0), 3)}
            model = boosted(rounds, **chosen).fit(known)
            tried.append(chosen | {"rounds": model.getNumTrees, "auc": auc(model.transform(later))})
            if best is None or tried[-1]["auc"] > best[0]:
                best = tried[-1]["auc"], model
    finally:
        known.unpersist()
    return tried, best[1]
