"""Frame operators on small literal inputs."""

import pytest
from pyspark.sql import functions as F

from censuskit.operators import frames, metrics


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_new_versions_skips_equal_rows_and_stamps_changed_ones(spark):
    live = spark.createDataFrame([(1, "a", None), (2, "b", None)], "k long, v string, deleted_at date")
    fresh = spark.createDataFrame([(1, "a"), (2, "c")], "k long, v string")
    got = frames.new_versions(live, fresh, ["k"], "2024-01-02").select("k", "v", F.col("deleted_at").cast("string"))
    assert rows(got) == [(1, "a", None), (2, "b", "2024-01-02"), (2, "c", None)]


def test_merge_replace_uses_the_composite_key(spark):
    old = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 3)], "a long, b string, v long")
    new = spark.createDataFrame([(1, "x", 9), (2, "y", 8)], "a long, b string, v long")
    assert rows(frames.merge_replace(old, new, ["a", "b"])) == [(1, "x", 9), (1, "y", 2), (2, "x", 3), (2, "y", 8)]


def test_cache_strategies(spark, tmp_path):
    path = str(tmp_path / "c")
    with pytest.raises(Exception):
        frames.cached(spark, path, lambda: spark.range(3), "only_use_cache")
    assert frames.cached(spark, path, lambda: spark.range(3), "check_cache_first").count() == 3
    assert frames.cached(spark, path, lambda: spark.range(5), "check_cache_first").count() == 3
    assert frames.cached(spark, path, lambda: spark.range(5), "ignore_cache").count() == 5


def test_gate_fails_the_job(spark):
    with pytest.raises(RuntimeError, match="stale"):
        frames.require(spark.sql("SELECT FALSE"), "stale")
    frames.require(spark.sql("SELECT TRUE"), "stale")


def test_auc_with_ties_at_half(spark):
    df = spark.createDataFrame([(1.0, True), (1.0, False), (2.0, True), (0.0, False)], "score double, label boolean")
    assert metrics.roc_auc(df).first()[0] == pytest.approx(0.875)
    assert metrics.average_precision(df).first()[0] == pytest.approx(0.5 + 0.5 * 2 / 3)


def test_bootstrap_is_repeatable_and_brackets_the_ratio(spark):
    df = spark.range(400).select((F.col("id") % 100).alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    run = lambda: rows(metrics.bootstrap(df, "k", {"share": (F.col("y"), F.lit(1))}, 100))
    first = run()
    assert first == run()
    assert first[0][1] < 0.25 < first[0][3]
