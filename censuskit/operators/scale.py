"""Orders over all rows without one task that sees them all.

Ranges of the ordering column are cut at approximate quantiles (as many as there are
shuffle partitions, known to the driver); windows run inside ranges, and a table with one
row per range carries the running totals from range to range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def range_of(df: DataFrame, column: str, ranges: int | None = None) -> Column:
    """The number of a row's range of a numeric column; nulls are in range -1."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n < 2:
        return F.when(F.col(column).isNull(), -1).otherwise(0)
    marks = df.select(F.percentile_approx(F.col(column).cast("double"), [i / n for i in range(1, n)], 10_000)).first()[0] or []
    marks = sorted(set(marks))
    if not marks:
        return F.when(F.col(column).isNull(), -1).otherwise(0)
    fine = F.array(*map(F.lit, marks))
    return F.when(F.col(column).isNull(), -1).otherwise(F.size(F.filter(fine, lambda m: m < F.col(column).cast("double"))))


def running_sums(df: DataFrame, order: str, sums: dict[str, str], descending: bool = False, tie: str | None = None) -> DataFrame:
    """df with running sums (new name -> column) in the order of one numeric column.

    Rows of equal order (and tie, if given) have equal sums, as in a RANGE frame."""
    turn = F.desc if descending else F.asc
    ranged = df.withColumn("range_", range_of(df, order))
    totals = ranged.groupBy("range_").agg(*[F.sum(c).alias(f"t_{n}") for n, c in sums.items()])
    before = W.orderBy(turn("range_")).rowsBetween(W.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("range_", *[F.coalesce(F.sum(f"t_{n}").over(before), F.lit(0)).alias(f"o_{n}") for n in sums])
    keys = [turn(order), *([F.asc(tie)] if tie else [])]
    inside = W.partitionBy("range_").orderBy(*keys).rangeBetween(W.unboundedPreceding, 0)
    both = ranged.withColumns({f"i_{n}": F.sum(c).over(inside) for n, c in sums.items()}).join(F.broadcast(offsets), "range_")
    return both.select(*df.columns, *[(F.col(f"o_{n}") + F.col(f"i_{n}")).alias(n) for n in sums])


def global_rank(df: DataFrame, order: str, tie: str, name: str = "rnk", descending: bool = True) -> DataFrame:
    """Rank 1 for the first row of all; ties broken by a second column."""
    return running_sums(df.withColumn("one_", F.lit(1)), order, {name: "one_"}, descending, tie).drop("one_")
