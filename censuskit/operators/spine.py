"""Patient-day spines: unrolled intervals, stays, and what splits them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def close_intervals(rows: DataFrame, begin: str, order: Sequence[str], last_day: str, action: Column) -> DataFrame:
    """Each row opens an interval that its patient's next row closes (a day before); the last
    one stays open until last_day. A null action is the previous one; rows before any
    action are dropped. Adds b, e and act.

    Patients are dealt to all shuffle partitions, however small the rows are: the days that
    unroll() makes of them are hundreds of times as many, and follow the tasks chosen here."""
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "pid")
    by = W.partitionBy("pid").orderBy(begin, *order)
    end = F.coalesce(F.date_sub(F.lead(begin).over(by), 1), F.to_date(F.lit(last_day)))
    return rows.withColumns({"b": F.col(begin), "e": end, "act": F.last(action, ignorenulls=True).over(by)}).filter("act IS NOT NULL")


def unroll(intervals: DataFrame, known_from: Column | None = None) -> DataFrame:
    """One row per day of each interval (b to e); with known_from, only days from then on."""
    days = intervals.filter("e >= b").withColumn("day", F.explode(F.sequence("b", "e")))
    return days if known_from is None else days.filter(F.col("day") >= known_from)


def cut_at(intervals: DataFrame, cutoffs: DataFrame, key: str) -> DataFrame:
    """Intervals cut at their facility's cutoff day; those that begin later go."""
    return intervals.join(cutoffs, key).filter("b <= cutoff").withColumn("e", F.least("e", "cutoff")).drop("cutoff")


def stays(days: DataFrame) -> DataFrame:
    """pid, b, e, days: runs of consecutive days (pid, day; one row each)."""
    by = W.partitionBy("pid").orderBy("day")
    island = F.date_sub("day", F.row_number().over(by))
    return days.select("pid", "day", island.alias("island")).groupBy("pid", "island").agg(F.min("day").alias("b"), F.max("day").alias("e"), F.count(F.lit(1)).alias("days")).drop("island")


def split_stays(stays_: DataFrame, cuts: DataFrame) -> DataFrame:
    """Stays cut at event days (pid, day) inside (b, e + 1]: pid, b, e of the parts."""
    inside = stays_.join(cuts.distinct(), "pid").filter((F.col("day") > F.col("b")) & (F.col("day") <= F.date_add("e", 1)))
    starts = stays_.select("pid", "b", "e", F.col("b").alias("start")).unionByName(inside.select("pid", "b", "e", F.col("day").alias("start")))
    following = F.lead("start").over(W.partitionBy("pid", "b").orderBy("start"))
    return starts.withColumn("next_", following).filter("start <= e").select("pid", F.col("start").alias("b"), F.coalesce(F.date_sub("next_", 1), F.col("e")).alias("e"))


def streaks(days: DataFrame, state: str) -> DataFrame:
    """Adds streak: days in the same state up to this one, 0 on the first (pid, day, state)."""
    by = W.partitionBy("pid").orderBy("day")
    same = (F.lag(state).over(by) == F.col(state)) & (F.date_diff("day", F.lag("day").over(by)) == 1)
    runs = days.withColumn("run_", F.sum(F.when(same, 0).otherwise(1)).over(by))
    return runs.withColumn("streak", F.row_number().over(W.partitionBy("pid", "run_").orderBy("day")) - 1).drop("run_")
