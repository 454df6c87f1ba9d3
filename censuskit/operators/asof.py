"""As-of joins: one union and one window over both sides, never a range join.

``asked`` has pid and day and any other columns; ``told`` has pid, day and the columns to
find. Ties of told on one day are settled by ``order``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def _united(asked: DataFrame, told: DataFrame, found: Column, shift: int) -> DataFrame:
    a = asked.select("pid", "day", F.struct(*asked.columns).alias("row_"))
    t = told.select("pid", F.date_add("day", shift).alias("day"), found.alias("found_"))
    return a.unionByName(t, allowMissingColumns=True)


def last_before(asked: DataFrame, told: DataFrame, columns: dict[str, str], order: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """asked with the columns (new name -> told column) of the latest told row on or before
    the day (strict: before it); ties by the largest order columns."""
    found = F.struct(F.col("day").alias("d_"), *[F.col(o).alias(f"o{i}_") for i, o in enumerate(order)], *[F.col(c).alias(n) for n, c in columns.items()])
    upto = W.partitionBy("pid").orderBy("day").rangeBetween(W.unboundedPreceding, 0)
    both = _united(asked, told, found, int(strict)).withColumn("found_", F.max("found_").over(upto)).filter("row_ IS NOT NULL")
    return both.select("row_.*", *[F.col(f"found_.{n}").alias(n) for n in columns])


def next_after(asked: DataFrame, told: DataFrame, columns: dict[str, str], order: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """asked with the columns of the earliest told row after the day (not strict: on or after)."""
    found = F.struct(F.col("day").alias("d_"), *[F.col(o).alias(f"o{i}_") for i, o in enumerate(order)], *[F.col(c).alias(n) for n, c in columns.items()])
    ahead = W.partitionBy("pid").orderBy("day").rangeBetween(0, W.unboundedFollowing)
    both = _united(asked, told, found, -int(strict)).withColumn("found_", F.min("found_").over(ahead)).filter("row_ IS NOT NULL")
    return both.select("row_.*", *[F.col(f"found_.{n}").alias(n) for n in columns])


def carried(asked: DataFrame, told: DataFrame, column: str, missing: str, order: Sequence[str] = (), name: str = "what", never: int = 9999) -> DataFrame:
    """pid, day, the last value carried forward (or missing) and the days since it (or never)."""
    got = last_before(asked, told.withColumn("at_", F.col("day")), {name: column, "at_": "at_"}, order)
    return got.select("pid", "day", F.coalesce(name, F.lit(missing)).alias(name), F.coalesce(F.date_diff("day", "at_"), F.lit(never)).alias("since"))
