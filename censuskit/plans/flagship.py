"""Spine, window, ranking and cutoff in one plan."""

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from censuskit.plans.registry import register
from censuskit.sources.tables import table

SQL = """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1, 2),
d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
s AS (SELECT d.user_id, d.day, coalesce(e.n, 0) AS n FROM d LEFT JOIN e USING (user_id, day)),
w AS (SELECT *, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS n_7,
  max(CASE WHEN n > 0 THEN day END) OVER (PARTITION BY user_id ORDER BY day) AS last_day FROM s),
f AS (SELECT user_id, day, user_id % 5 AS facility, n_7, coalesce(day - last_day, 9999) AS days_since FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY facility, day ORDER BY n_7 DESC, days_since, user_id) AS rnk FROM f)
SELECT user_id, day, facility, n_7, CAST(days_since AS INT) AS days_since, CAST(rnk AS INT) AS rnk,
  rnk <= greatest(1, CAST(floor(0.15 * max(rnk) OVER (PARTITION BY facility, day)) AS INT)) AS shown FROM r
"""


@register("flagship_daily_rank", SQL)
def flagship_daily_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    # one aggregate builds the spine and the counts: no join of the two
    spine = ev.groupBy("user_id", "day").agg(F.count_if(F.col("event_type") == "click").alias("n"))
    by_user = W.partitionBy("user_id").orderBy(F.unix_date("day"))
    feats = spine.select(
        "user_id", "day", (F.col("user_id") % 5).alias("facility"),
        F.sum("n").over(by_user.rangeBetween(-6, 0)).alias("n_7"),
        F.coalesce(F.date_diff("day", F.max(F.when(F.col("n") > 0, F.col("day"))).over(by_user)), F.lit(9999)).alias("days_since"),
    )
    group = W.partitionBy("facility", "day")
    ranked = feats.withColumn("rnk", F.row_number().over(group.orderBy(F.desc("n_7"), "days_since", "user_id")))
    cutoff = F.greatest(F.lit(1), F.floor(F.max("rnk").over(group) * 0.15).cast("int"))
    return ranked.withColumn("shown", F.col("rnk") <= cutoff)
