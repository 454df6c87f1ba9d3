"""Ranking and classification metrics as plans over distinct scores, and bootstrap intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from censuskit.operators.scale import running_sums


def by_score(df: DataFrame, score: str = "score", label: str = "label", groups: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, falling, with running true and false positives (tp, fp) and
    the totals (pos, neg): every curve below is a window over this, not over single rows."""
    y = F.col(label).cast("long")
    counts = df.groupBy(*groups, F.col(score).alias("s")).agg(F.sum(y).alias("p"), F.sum(1 - y).alias("n"))
    if not groups:  # no partition key: sums run over ranges of the score
        ends = counts.agg(F.sum("p").alias("pos"), F.sum("n").alias("neg"))
        return running_sums(counts, "s", {"tp": "p", "fp": "n"}, descending=True).crossJoin(F.broadcast(ends))  # one row
    down, whole = W.partitionBy(*groups).orderBy(F.desc("s")), W.partitionBy(*groups)
    return counts.select(*groups, "s", "p", "n", F.sum("p").over(down).alias("tp"), F.sum("n").over(down).alias("fp"), F.sum("p").over(whole).alias("pos"), F.sum("n").over(whole).alias("neg"))


def roc_auc(df: DataFrame, score: str = "score", label: str = "label", groups: Sequence[str] = ()) -> DataFrame:
    """Area under the curve with ties at half."""
    c = by_score(df, score, label, groups)
    area = F.sum(F.col("n") * (F.col("tp") - F.col("p") / 2.0)) / (F.first("pos") * F.first("neg"))
    return c.groupBy(*groups).agg(area.alias("auc"))


def average_precision(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    step = F.col("p") / F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return by_score(df, score, label).agg(F.sum(step).alias("ap"))


def roc_points(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return by_score(df, score, label).select(F.col("s").alias("threshold"), (F.col("fp") / F.col("neg")).alias("fpr"), (F.col("tp") / F.col("pos")).alias("tpr"))


def partial_auc(df: DataFrame, most: float, score: str = "score", label: str = "label") -> DataFrame:
    """Standardised area where the false positive rate is at most ``most``, with the last step
    interpolated. The point before a score is the running count less the score's own."""
    c = by_score(df, score, label)
    rows = c.select((F.col("fp") / F.col("neg")).alias("x"), (F.col("tp") / F.col("pos")).alias("y"), ((F.col("fp") - F.col("n")) / F.col("neg")).alias("x0"), ((F.col("tp") - F.col("p")) / F.col("pos")).alias("y0"))
    rows = rows.filter(F.col("x0") < most)
    x1 = F.least("x", F.lit(most))
    y1 = F.when(F.col("x") > F.col("x0"), F.col("y0") + (F.col("y") - F.col("y0")) * (x1 - F.col("x0")) / (F.col("x") - F.col("x0"))).otherwise(F.col("y"))
    area = F.sum((x1 - F.col("x0")) * (F.col("y0") + y1) / 2)
    low, high = most * most / 2, most
    return rows.agg((0.5 * (1 + (area - low) / (high - low))).alias("partial_auc"))


def poisson(key: Column, replicate: Column, salt: int = 0) -> Column:
    """A Poisson(1) weight that depends on key and replicate alone."""
    u = F.pmod(F.xxhash64(key, replicate, F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)
    out, upto, p, n = F.when(F.lit(False), 0), 0.0, 0.36787944117144233, 0
    while n < 8:
        upto += p
        out, n = out.when(u < upto, n), n + 1
        p /= n
    return out.otherwise(8)


def bootstrap(df: DataFrame, key: str, metrics: dict[str, tuple[Column, Column]], replicates: int = 200, level: float = 0.95) -> DataFrame:
    """Percentile intervals of ratios sum(w * a) / sum(w * b), resampling keys.

    Rows are summed per key first, so only one row per key is replicated; replicates are
    aggregated map-side."""
    sums = df.groupBy(key).agg(*[F.sum(x.cast("double")).alias(f"{n}_{i}") for n, ab in metrics.items() for i, x in enumerate(ab)])
    many = sums.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("w", poisson(F.col(key), F.col("replicate")))
    each = many.groupBy("replicate").agg(*[(F.sum(F.col("w") * F.col(f"{n}_0")) / F.sum(F.col("w") * F.col(f"{n}_1"))).alias(n) for n in metrics])
    tails = [(1 - level) / 2, (1 + level) / 2]
    long = each.unpivot("replicate", list(metrics), "metric", "value")
    return long.groupBy("metric").agg(F.percentile("value", tails[0]).alias("low"), F.percentile("value", 0.5).alias("mid"), F.percentile("value", tails[1]).alias("high"))
