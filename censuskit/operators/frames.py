"""Operators over whole frames: reading, writing, gates, columns and profiles."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from censuskit.operators.scale import running_sums


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that the cluster names; a temporary one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        base = "file://" + tempfile.mkdtemp(prefix="censuskit-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, for plans that read it more than once."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose header and cells may carry quotes of either kind."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.regexp_replace(F.col(f"`{c}`"), "^[\"']|[\"']$", "").alias(c.strip("\"'")) for c in raw.columns])


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], strategy: str) -> DataFrame:
    """only_use_cache, ignore_cache or check_cache_first."""
    if strategy not in ("only_use_cache", "ignore_cache", "check_cache_first"):
        raise ValueError(f"no such strategy: {strategy}")
    if strategy != "ignore_cache":
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            if strategy == "only_use_cache":
                raise
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def replace_slices(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace the partitions that rows have, and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def merge_replace(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows whose composite key is not among the new ones, and the new ones."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def new_versions(live: DataFrame, fresh: DataFrame, keys: Sequence[str], today: str) -> DataFrame:
    """Stamp live rows that get another version as deleted and append it; equal ones are skipped."""
    values = [c for c in fresh.columns if c not in keys]
    changed = fresh.join(live.filter("deleted_at IS NULL").select(*fresh.columns), fresh.columns, "left_anti") if values else fresh
    gone = changed.select(*keys).distinct().withColumn("replaced", F.lit(True))
    stamped = live.join(gone, list(keys), "left").withColumn("deleted_at", F.when(F.col("replaced") & F.col("deleted_at").isNull(), F.to_date(F.lit(today))).otherwise(F.col("deleted_at"))).drop("replaced")
    return stamped.unionByName(changed.withColumn("deleted_at", F.lit(None).cast("date")))


def coerce_dates(df: DataFrame, mark: str = "date") -> DataFrame:
    """Columns whose name contains the mark become timestamps; what cannot be read becomes null."""
    return df.select(*[F.try_to_timestamp(F.col(c).cast("string")).alias(c) if mark in c.lower() else F.col(c) for c in df.columns])


def require(condition: DataFrame, message: str) -> None:
    """Fail the job unless the one-row frame's first column is true."""
    if not condition.first()[0]:
        raise RuntimeError(message)


def union_clients(frames: dict[str, DataFrame], ids: Sequence[str]) -> DataFrame:
    """Frames of several clients as one, with ids prefixed by the client's name."""
    out = None
    for client, df in frames.items():
        df = df.withColumns({i: F.concat_ws("_", F.lit(client), F.col(i).cast("string")) for i in ids} | {"client": F.lit(client)})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def clip_to_ranges(df: DataFrame, ranges: DataFrame, key: str, value: str) -> DataFrame:
    """Values outside their kind's range become null; kinds without a range stay."""
    both = df.join(ranges, key, "left")  # Catalyst broadcasts ranges where they are small
    inside = F.col("low").isNull() | F.col(value).between(F.col("low"), F.col("high"))
    return both.withColumn(value, F.when(inside, F.col(value))).select(*df.columns)


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[c for c in df.columns if not re.search(pattern, c)])


def reindex(df: DataFrame, names: Sequence[str], fills: dict[str, int]) -> DataFrame:
    """Exactly these columns; missing ones, and nulls in others, filled by the first pattern that fits."""

    def one(name: str) -> Column:
        fill = next((v for p, v in fills.items() if re.search(p, name)), None)
        have = F.col(name) if name in df.columns else F.lit(None).cast("int")
        return (have if fill is None else F.coalesce(have, F.lit(fill))).alias(name)

    return df.select(*map(one, names))


def _one_pass(df: DataFrame, test: Callable[[str], Column]) -> dict[str, bool]:
    return df.agg(*[test(c).alias(c) for c in df.columns]).first().asDict()


def drop_all_null(df: DataFrame) -> DataFrame:
    found = _one_pass(df, lambda c: F.count(F.col(c)) > 0)
    return df.select(*[c for c in df.columns if found[c]])


def drop_constant(df: DataFrame) -> DataFrame:
    """Columns that have one value, and it in every row."""
    found = _one_pass(df, lambda c: (F.min(c) == F.max(c)) & (F.count(F.col(c)) == F.count(F.lit(1))))
    return df.select(*[c for c in df.columns if not found[c]])


def drop_sparse(df: DataFrame, share: float) -> DataFrame:
    """Columns of which the larger of the shares of zeros, 9999s and nulls reaches share."""
    part = lambda x: F.avg(F.coalesce(x, F.lit(False)).cast("int"))
    found = _one_pass(df, lambda c: F.greatest(part(F.col(c) == 0), part(F.col(c) == 9999), part(F.col(c).isNull())) >= share)
    return df.select(*[c for c in df.columns if not found[c]])


def group_counts(spark: SparkSession, before: Sequence[str], after: Sequence[str], groups: dict[str, str]) -> DataFrame:
    """Columns per group of names, before and after dropping some, and the percentage dropped."""
    names = spark.createDataFrame([(c, c in set(after)) for c in before], "name string, kept boolean")
    patterns = F.explode(F.array(*[F.struct(F.lit(g).alias("grp"), F.lit(p).alias("pattern")) for g, p in groups.items()])).alias("g")
    hits = names.select("name", "kept", patterns).filter(F.expr("name rlike g.pattern"))
    counts = hits.groupBy("g.grp").agg(F.count(F.lit(1)).cast("int").alias("before"), F.count_if("kept").cast("int").alias("after"))
    return counts.withColumn("percent_dropped", F.round(100.0 * (F.col("before") - F.col("after")) / F.col("before"), 4))


def null_flags(df: DataFrame) -> DataFrame:
    found = _one_pass(df, lambda c: F.count(F.col(c)) < F.count(F.lit(1)))
    return df.withColumns({f"na_indicator_{c}": F.col(c).isNull() for c in df.columns if found[c]})


def plain_names(df: DataFrame) -> DataFrame:
    """ASCII names without brackets, runs of blanks as one underscore."""
    plain = lambda c: re.sub(r"_+", "_", re.sub(r"\s+", "_", re.sub(r"[^\x00-\x7F]|[()]", "", c.strip())))
    return df.toDF(*map(plain, df.columns))


def average_ranks(df: DataFrame, name: str) -> DataFrame:
    """value -> average rank, by distinct values and over ranges of them."""
    counts = df.groupBy(F.col(name).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return running_sums(counts, "v", {"upto": "n"}).select("v", (F.col("upto") - (F.col("n") - 1) / 2.0).alias("rank"))


def spearman(df: DataFrame, names: Sequence[str], target: str) -> DataFrame:
    ranked = df
    for c in [*names, target]:
        r = average_ranks(df, c).withColumnsRenamed({"v": f"v_{c}", "rank": f"r_{c}"})
        ranked = ranked.join(r, F.col(c).cast("double") == F.col(f"v_{c}"))
    one = ranked.agg(*[F.round(F.corr(f"r_{c}", f"r_{target}"), 5).alias(c) for c in names])
    return one.unpivot([], list(names), "col", "rho")


def equal_columns(df: DataFrame) -> DataFrame:
    """Pairs of columns that are equal in every row: candidates by checksum, then exact."""
    sums = df.agg(*[F.sum(F.xxhash64(F.col(c)) % 1_000_003).alias(c) for c in df.columns]).first().asDict()
    pairs = [(a, b) for i, a in enumerate(df.columns) for b in df.columns[i + 1 :] if sums[a] == sums[b]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string")
    same = df.agg(*[F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("same")) for i, (a, b) in enumerate(pairs)])
    return same.select(F.inline(rows)).filter("same").select("a", "b")


def roll_up_rare(df: DataFrame, key: str, code: str, least: int, longest: int) -> DataFrame:
    """Each code's longest prefix that at least so many rows share, else Other."""
    prefixes = df.select(key, F.explode(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda k: F.substring(F.col(code), F.lit(1), k))).alias("prefix"))
    common = prefixes.groupBy("prefix").agg(F.count_distinct(key).alias("n")).filter(F.col("n") >= least).select("prefix")
    best = prefixes.join(common, "prefix").groupBy(key).agg(F.max(F.struct(F.length("prefix").alias("l"), "prefix")).alias("b"))
    return df.join(best, key, "left").select(key, F.coalesce("b.prefix", F.lit("Other")).alias(code))
