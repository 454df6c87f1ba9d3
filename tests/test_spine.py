"""Unrolled intervals."""

import datetime

from pyspark.sql import functions as F

from censuskit.operators import spine


def test_small_intervals_are_unrolled_in_all_tasks(spark):
    day = datetime.date(2024, 1, 1)
    rows = spark.createDataFrame([(p, day + datetime.timedelta(days=k), k, "F") for p in range(40) for k in (0, 3)], "pid long, day date, okey int, act string")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        days = spine.unroll(spine.close_intervals(rows, "day", ["okey"], "2024-01-05", F.col("act")))
        used = days.select(F.spark_partition_id().alias("task")).distinct().count()
        got = sorted(map(tuple, days.select("pid", "day", "okey").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert used > 8, "merged into few tasks, though each row becomes many"
    assert got == [(p, day + datetime.timedelta(days=k), 0 if k < 3 else 3) for p in range(40) for k in range(5)]
