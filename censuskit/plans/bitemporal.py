"""The bitemporal core and event windows (inventory 2.5)."""

from pyspark.sql import Window as W, functions as F

from censuskit.operators import bitemporal as b
from censuskit.plans.proxies import EV, KINDS, SP, events, running, spine
from censuskit.plans.registry import register

KIND_ROWS = "k AS (SELECT unnest(['" + "', '".join(KINDS) + "']) AS kind)"
WINDOWS = [2, 7, 14, 30]


def _by_day(value: str) -> str:
    wins = ", ".join(f"CAST(sum({value}) OVER (PARTITION BY pid, kind ORDER BY day RANGE BETWEEN INTERVAL {w - 1} DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS n_{w}" for w in WINDOWS)
    return f"""WITH {EV}, {SP}, {KIND_ROWS}, g AS (SELECT sp.pid, sp.day, k.kind, count(ev.event_id) AS n FROM sp CROSS JOIN k LEFT JOIN ev ON ev.pid = sp.pid AND ev.e = sp.day AND ev.kind = k.kind GROUP BY 1, 2, 3)
      SELECT pid, day, kind, {wins}, CAST(sum({value}) OVER (PARTITION BY pid, kind ORDER BY day) AS BIGINT) AS n_all FROM g"""


def _daily(spark, d):
    """Dense rows per patient, kind and day: the spine with its counts, by one union and one aggregate."""
    days = spine(spark, d).select("pid", "day", F.explode(F.array(*map(F.lit, KINDS))).alias("kind"), F.lit(0).alias("n"))
    return days.unionByName(events(spark, d).select("pid", F.col("e").alias("day"), "kind", F.lit(1).alias("n"))).groupBy("pid", "kind", "day").agg(F.sum("n").alias("n"))


def _windows(spark, d, value):
    by = W.partitionBy("pid", "kind").orderBy(F.unix_date("day"))
    return _daily(spark, d).withColumn("v", value).select("pid", "day", "kind", *[F.sum("v").over(by.rangeBetween(-(w - 1), 0)).alias(f"n_{w}") for w in WINDOWS], F.sum("v").over(by.rangeBetween(W.unboundedPreceding, 0)).alias("n_all"))


@register("cumsum_windows", _by_day("n"))
def cumsum_windows(spark, d):
    return _windows(spark, d, F.col("n"))


@register("cumidx_windows", _by_day("CASE WHEN n > 0 THEN 1 ELSE 0 END"))
def cumidx_windows(spark, d):
    return _windows(spark, d, (F.col("n") > 0).cast("long"))


SINCE = f"""WITH {EV}, {SP}, {KIND_ROWS} SELECT sp.pid, sp.day, k.kind, CAST(coalesce(sp.day - (SELECT max(e) FROM ev WHERE ev.pid = sp.pid AND ev.kind = k.kind AND ev.e <= sp.day), 9999) AS INT) AS days_since FROM sp CROSS JOIN k"""


@register("days_since_last_event", SINCE)
def days_since_last_event(spark, d):
    last = F.max(F.when(F.col("n") > 0, F.col("day"))).over(running("pid", "kind"))
    return _daily(spark, d).select("pid", "day", "kind", F.coalesce(F.date_diff("day", last), F.lit(b.NEVER)).alias("days_since"))


@register("days_since_last_event_v2", SINCE)
def days_since_last_event_v2(spark, d):
    return b.days_since(spine(spark, d), events(spark, d).withColumn("r", F.col("e")), KINDS)


@register("bitemporal_days_since", f"""WITH {EV}, {SP}, {KIND_ROWS} SELECT sp.pid, sp.day, k.kind,
  CAST(coalesce(sp.day - (SELECT max(e) FROM ev WHERE ev.pid = sp.pid AND ev.kind = k.kind AND greatest(ev.e, ev.r) <= sp.day), 9999) AS INT) AS days_since FROM sp CROSS JOIN k""")
def bitemporal_days_since(spark, d):
    return b.days_since(spine(spark, d), events(spark, d), KINDS)


def _counted(source: str) -> str:
    wins = ", ".join(f"count(*) FILTER (WHERE t.e > sp.day - {w}) AS n_{w}" for w in WINDOWS)
    return f"""WITH {EV}, {SP}, {KIND_ROWS}, t AS ({source}) SELECT sp.pid, sp.day, k.kind, {wins.replace("count(*)", "count(t.e)")}, count(t.e) AS n_all
      FROM sp CROSS JOIN k LEFT JOIN t ON t.pid = sp.pid AND t.kind = k.kind AND t.v <= sp.day GROUP BY 1, 2, 3"""


@register("bitemporal_cumsum", _counted("SELECT pid, kind, e, greatest(e, r) AS v FROM ev"))
def bitemporal_cumsum(spark, d):
    return b.counts(spine(spark, d), events(spark, d), WINDOWS, KINDS)


@register("bitemporal_cumidx", _counted("SELECT pid, kind, min(e) AS e, greatest(e, r) AS v FROM ev GROUP BY pid, kind, greatest(e, r)"))
def bitemporal_cumidx(spark, d):
    return b.counts(spine(spark, d), events(spark, d), WINDOWS, KINDS, first_only=True)


@register("bitemporal_last_n", f"""WITH {EV}, {SP}, j AS (SELECT sp.pid, sp.day, ev.event_id AS value, row_number() OVER (PARTITION BY sp.pid, sp.day ORDER BY ev.e DESC, ev.r DESC, ev.event_id DESC) AS i
  FROM sp JOIN ev ON ev.pid = sp.pid AND greatest(ev.e, ev.r) <= sp.day AND (ev.x IS NULL OR sp.day < ev.x) AND ev.kind = 'purchase')
  SELECT sp.pid, sp.day, max(CASE WHEN i = 1 THEN value END) AS last_1, max(CASE WHEN i = 2 THEN value END) AS last_2, max(CASE WHEN i = 3 THEN value END) AS last_3
  FROM sp LEFT JOIN j ON j.pid = sp.pid AND j.day = sp.day GROUP BY sp.pid, sp.day""")
def bitemporal_last_n(spark, d):
    told = events(spark, d).filter("kind = 'purchase'").select("pid", "e", "r", "x", F.col("event_id").alias("value"))
    return b.last_n(spine(spark, d), told, 3, order=("e", "r", "value"))


@register("bitemporal_window_agg", f"""WITH {EV}, {SP} SELECT sp.pid, sp.day, round(min(value) + max(value), 4) AS span, min(kind) || max(kind) AS kinds, nullif(count(ev.event_id), 0) AS n
  FROM sp LEFT JOIN ev ON ev.pid = sp.pid AND greatest(ev.e, ev.r) <= sp.day AND ev.e > sp.day - 7 AND (ev.x IS NULL OR sp.day < ev.x) GROUP BY 1, 2""")
def bitemporal_window_agg(spark, d):
    return b.window_agg(spine(spark, d), events(spark, d), 7, {"span": F.round(F.min("value") + F.max("value"), 4), "kinds": F.concat(F.min("kind"), F.max("kind")), "n": F.count(F.lit(1))})


@register("conditional_aggregator", f"""WITH {EV}, {SP}, g AS (SELECT sp.pid, sp.day, count(ev.event_id) AS n, sum(value) AS total, min(value) AS low, max(value) AS top, string_agg(kind, '>' ORDER BY ev.e, ev.r, event_id) AS path
  FROM sp LEFT JOIN ev ON ev.pid = sp.pid AND greatest(ev.e, ev.r) <= sp.day AND ev.e > sp.day - 7 AND (ev.x IS NULL OR sp.day < ev.x) GROUP BY 1, 2)
  SELECT pid, day, CASE WHEN n > 2 THEN round(total - low - top, 2) / (n - 2) WHEN n > 0 THEN round(total, 2) / n END AS trimmed, path FROM g""")
def conditional_aggregator(spark, d):
    """An opaque function of a week's visible events: their mean without the lowest and highest
    value, and their kinds in order."""

    def trimmed(values, kinds):
        v = sorted(values)
        v = v[1:-1] if len(v) > 2 else v
        return round(sum(v), 2) / len(v), ">".join(kinds)

    return b.window_lists(spine(spark, d), events(spark, d), 7, trimmed, "trimmed double, path string", ["value", "kind"], ["e", "r", "event_id"])


@register("conditional_featurizer_all", f"""WITH {EV}, {SP}, g AS (SELECT sp.pid, sp.day, ev.kind, count(*) AS n_all, count(*) FILTER (WHERE ev.e > sp.day - 7) AS n_7, sp.day - max(ev.e) AS since
  FROM sp JOIN ev ON ev.pid = sp.pid AND greatest(ev.e, ev.r) <= sp.day GROUP BY 1, 2, 3)
  SELECT sp.pid, sp.day, {", ".join(f"CAST(coalesce(max(CASE WHEN kind = '{k}' THEN n_all END), 0) AS BIGINT) AS {k}_all, CAST(coalesce(max(CASE WHEN kind = '{k}' THEN n_7 END), 0) AS BIGINT) AS {k}_7, CAST(coalesce(max(CASE WHEN kind = '{k}' THEN since END), 9999) AS INT) AS {k}_since" for k in KINDS)}
  FROM sp LEFT JOIN g ON g.pid = sp.pid AND g.day = sp.day GROUP BY 1, 2""")
def conditional_featurizer_all(spark, d):
    days, told = spine(spark, d), events(spark, d)
    long = b.counts(days, told, [7], KINDS).join(b.days_since(days, told, KINDS), ["pid", "day", "kind"])
    wide = long.groupBy("pid", "day").pivot("kind", KINDS).agg(F.first("n_all").alias("all"), F.first("n_7").alias("7"), F.first("days_since").alias("since"))
    return wide


@register("cumulative_state_flag", f"""WITH {EV}, {SP} SELECT pid, day, EXISTS (SELECT 1 FROM ev WHERE ev.pid = sp.pid AND ev.kind = 'signup' AND ev.e <= sp.day) AS flag FROM sp""")
def cumulative_state_flag(spark, d):
    return _daily(spark, d).filter("kind = 'signup'").select("pid", "day", F.max(F.col("n") > 0).over(running("pid")).alias("flag"))
