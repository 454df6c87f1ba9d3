"""Ranks inside groups and the flags that follow from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def rank_first(df: DataFrame, groups: Sequence[str], score: str, ties: Sequence[str], name: str = "rnk") -> DataFrame:
    """Rank by falling score, ties by the given columns: no two rows of a group are equal."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*groups).orderBy(F.desc(score), *ties)))


def average_rank(groups: Sequence[str], score: str) -> Column:
    """Rank by falling score with ties at their average."""
    return F.rank().over(W.partitionBy(*groups).orderBy(F.desc(score))) + (F.count(F.lit(1)).over(W.partitionBy(*groups, score)) - 1) / 2.0


def relative(groups: Sequence[str], rank: str = "rnk") -> Column:
    return F.col(rank) / F.max(rank).over(W.partitionBy(*groups))


def shown(groups: Sequence[str], cutoff: float, rank: str = "rnk") -> Column:
    """Above 1 a number of rows, else a share of the group of which at least one row is shown."""
    most = F.max(rank).over(W.partitionBy(*groups))
    limit = F.least(F.lit(int(cutoff)), most) if cutoff > 1 else F.greatest(F.lit(1), F.floor(most * cutoff).cast("int"))
    return F.col(rank) <= limit
