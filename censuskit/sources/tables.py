"""Named Parquet tables below a prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, prefix: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{prefix}/{name}.parquet")
