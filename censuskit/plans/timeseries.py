"""Stays, rolling statistics, targets, ranks and calendars (inventory 2.5)."""

from pyspark.sql import Window as W, functions as F

from censuskit.functions import codes
from censuskit.operators import asof, ranking, spine as sp_
from censuskit.plans import proxies as p
from censuskit.plans.registry import register
from censuskit.plans.sqlviews import duck_text, sql_query as q
from censuskit.sources.tables import table

q("dedupe_keep_last", """WITH r AS (SELECT pid, e, kind, event_id, row_number() OVER (PARTITION BY pid, e, kind ORDER BY ts DESC, event_id DESC) AS rn FROM ev) SELECT pid, e, kind, event_id FROM r WHERE rn = 1""")

# ---- interval census: an order opens an interval that the customer's next order closes
IV = """iv AS (SELECT pid, fac, okey, day AS b, DADD(lead(day) OVER (PARTITION BY pid ORDER BY day, okey), -1) AS e, CASE WHEN status = 'P' THEN NULL ELSE status END AS action FROM pr)"""
IV = IV.replace("DADD(lead(day) OVER (PARTITION BY pid ORDER BY day, okey), -1)", "lead(day) OVER (PARTITION BY pid ORDER BY day, okey)")
UNROLL_DUCK = f"""WITH {IV}, f AS (SELECT *, last_value(action IGNORE NULLS) OVER (PARTITION BY pid ORDER BY b, okey) AS act FROM iv), g AS (SELECT pid, fac, okey, act, b, coalesce(CAST(e - 1 AS DATE), DATE '2001-08-01') AS e FROM f WHERE act IS NOT NULL)"""


def _intervals(spark, d):
    pr = p.predictions(spark, d).select("pid", "fac", "okey", "day", "status")
    return sp_.close_intervals(pr, "day", ["okey"], "2001-08-01", F.when(F.col("status") != "P", F.col("status")))


@register("census_unroll", f"""{UNROLL_DUCK.replace('FROM pr)', 'FROM pr)')} , u AS (SELECT pid, okey, act, CAST(unnest(generate_series(b, e, INTERVAL 1 DAY)) AS DATE) AS day FROM g WHERE e >= b) SELECT pid, okey, act, day FROM u""".replace("WITH iv", f"WITH {p.PR}, iv"))
def census_unroll(spark, d):
    return sp_.unroll(_intervals(spark, d)).select("pid", "okey", "act", "day")


@register("census_unroll_conditional", f"""{UNROLL_DUCK} , u AS (SELECT pid, okey, act, b, CAST(unnest(generate_series(b, e, INTERVAL 1 DAY)) AS DATE) AS day FROM g WHERE e >= b) SELECT pid, okey, act, day FROM u WHERE day >= b + CAST(okey % 4 AS INT)""".replace("WITH iv", f"WITH {p.PR}, iv"))
def census_unroll_conditional(spark, d):
    known = F.date_add("b", (F.col("okey") % 4).cast("int"))
    return sp_.unroll(_intervals(spark, d), known).select("pid", "okey", "act", "day")


@register("facility_cutoff", f"""{UNROLL_DUCK}, c AS (SELECT fac, CASE WHEN extract(DAY FROM max(day)) <= 3 THEN CAST(date_trunc('month', max(day)) AS DATE) ELSE CAST(date_trunc('month', max(day)) + INTERVAL 1 MONTH AS DATE) END - 1 AS cutoff FROM pr GROUP BY fac)
  SELECT g.okey, g.pid, g.b, least(g.e, CAST(c.cutoff AS DATE)) AS e FROM g JOIN c ON c.fac = g.fac WHERE g.b <= c.cutoff""".replace("WITH iv", f"WITH {p.PR}, iv"))
def facility_cutoff(spark, d):
    last = F.max("day")
    month = F.trunc(last, "MM")
    cut = p.predictions(spark, d).groupBy("fac").agg(F.date_sub(F.when(F.day(last) <= 3, month).otherwise(F.add_months(month, 1)), 1).alias("cutoff"))
    return sp_.cut_at(_intervals(spark, d), cut, "fac").select("okey", "pid", "b", "e")


@register("calendar_spine", f"""WITH {p.EV}, cal AS (SELECT CAST(unnest(generate_series(min(e), max(e), INTERVAL 1 DAY)) AS DATE) AS day FROM ev), c AS (SELECT DISTINCT pid, e AS day FROM ev WHERE kind = 'view'), t AS (SELECT DISTINCT pid, e AS day FROM ev WHERE kind = 'error'),
  f AS (SELECT coalesce(c.pid, t.pid) AS pid, coalesce(c.day, t.day) AS day, t.pid IS NOT NULL AS moved FROM c FULL JOIN t ON c.pid = t.pid AND c.day = t.day) SELECT cal.day, f.pid, f.moved FROM cal LEFT JOIN f ON f.day = cal.day""")
def calendar_spine(spark, d):
    cal = p.events(spark, d).agg(F.explode(F.sequence(F.min("e"), F.max("e"))).alias("day"))
    seen = p.events(spark, d).filter("kind IN ('view', 'error')").groupBy("pid", F.col("e").alias("day")).agg(F.bool_or(F.col("kind") == "error").alias("moved"))
    return cal.join(seen, "day", "left").select("day", "pid", "moved")


@register("consecutive_days", f"WITH {p.EV}, {p.SP} SELECT pid, day FROM sp")
def consecutive_days(spark, d):
    return p.spine(spark, d).select("pid", "day")


# ---- rolling statistics of values
def _rolling(frame: str) -> str:
    return ", ".join(f"count(*) OVER w{k} AS n_{k}, min(value) OVER w{k} AS min_{k}, max(value) OVER w{k} AS max_{k}, round(avg(value) OVER w{k}, 6) AS mean_{k}" for k in (1, 2, 3))


@register("rolling_stats_days", f"""WITH {p.EV}, s AS (SELECT *, row_number() OVER (PARTITION BY pid, kind, e ORDER BY ts DESC, event_id DESC) AS rn, {_rolling('')} FROM ev WINDOW {", ".join(f"w{k} AS (PARTITION BY pid, kind ORDER BY ts RANGE BETWEEN INTERVAL {k * 86_400 * 10**6 - 1} MICROSECOND PRECEDING AND CURRENT ROW)" for k in (1, 2, 3))})
  SELECT pid, kind, e AS day, {", ".join(f"n_{k}, min_{k}, max_{k}, mean_{k}" for k in (1, 2, 3))} FROM s WHERE rn = 1""")
def rolling_stats_days(spark, d):
    # pandas windows are open on the left: a reading exactly k days old is out
    at = W.partitionBy("pid", "kind").orderBy(F.unix_micros("ts"))
    out = {}
    for k in (1, 2, 3):
        w = at.rangeBetween(-(k * 86_400 * 10**6 - 1), 0)
        out |= {f"n_{k}": F.count(F.lit(1)).over(w), f"min_{k}": F.min("value").over(w), f"max_{k}": F.max("value").over(w), f"mean_{k}": F.round(F.avg("value").over(w), 6)}
    last = F.row_number().over(W.partitionBy("pid", "kind", "e").orderBy(F.desc("ts"), F.desc("event_id")))
    return p.events(spark, d).withColumns(out).withColumn("rn", last).filter("rn = 1").select("pid", "kind", F.col("e").alias("day"), *out)


DAILY = "dl AS (SELECT pid, kind, e AS day, avg(value) AS mean, count(*) AS n FROM ev GROUP BY pid, kind, e)"


@register("calendar_lag_diff", duck_text(f"WITH {DAILY} SELECT a.pid, a.kind, a.day, round(a.mean - max(CASE WHEN DD(b.day, a.day) = 1 THEN b.mean END), 6) AS diff_1, round(a.mean - max(CASE WHEN DD(b.day, a.day) = 2 THEN b.mean END), 6) AS diff_2, round(a.mean - max(CASE WHEN DD(b.day, a.day) = 3 THEN b.mean END), 6) AS diff_3 FROM dl a LEFT JOIN dl b ON a.pid = b.pid AND a.kind = b.kind AND b.day < a.day AND b.day >= DADD(a.day, -3) GROUP BY a.pid, a.kind, a.day, a.mean"))
def calendar_lag_diff(spark, d):
    """The mean of exactly k days before, by a range of one day in one window."""
    daily = p.events(spark, d).groupBy("pid", "kind", F.col("e").alias("day")).agg(F.avg("value").alias("mean"))
    by = W.partitionBy("pid", "kind").orderBy(F.unix_date("day"))
    return daily.select("pid", "kind", "day", *[F.round(F.col("mean") - F.max("mean").over(by.rangeBetween(-k, -k)), 6).alias(f"diff_{k}") for k in (1, 2, 3)])


q("row_lag_diff", f"WITH {DAILY} SELECT pid, kind, day, round(mean - lag(mean, 1) OVER (PARTITION BY pid, kind ORDER BY day), 6) AS diff_1, round(mean - lag(mean, 2) OVER (PARTITION BY pid, kind ORDER BY day), 6) AS diff_2, round(mean - lag(mean, 3) OVER (PARTITION BY pid, kind ORDER BY day), 6) AS diff_3 FROM dl")
RANGE = "OVER (PARTITION BY pid, kind ORDER BY day RANGE BETWEEN INTERVAL '{}' DAY PRECEDING AND CURRENT ROW)"
q("rolling_event_count", f"WITH {DAILY} SELECT pid, kind, day, " + ", ".join(f"CAST(sum(n) {RANGE.format(k - 1)} AS BIGINT) AS n_{k}" for k in (2, 3, 4)) + " FROM dl")
q("ffill_by_patient", "WITH w AS (SELECT s.pid, s.day, avg(v.value) AS value FROM sp s LEFT JOIN ev v ON v.pid = s.pid AND v.e = s.day AND v.kind = 'purchase' GROUP BY s.pid, s.day) SELECT pid, day, round(last_value(value) IGNORE NULLS OVER (PARTITION BY pid ORDER BY day), 6) AS value FROM w",
  "WITH w AS (SELECT s.pid, s.day, avg(v.value) AS value FROM sp s LEFT JOIN ev v ON v.pid = s.pid AND v.e = s.day AND v.kind = 'purchase' GROUP BY s.pid, s.day) SELECT pid, day, round(last_value(value IGNORE NULLS) OVER (PARTITION BY pid ORDER BY day), 6) AS value FROM w")
q("diff_rows", f"WITH {DAILY} SELECT pid, kind, day, round(mean - lag(mean, 1) OVER (PARTITION BY pid, kind ORDER BY day), 6) AS diff_1, round(mean - lag(mean, 7) OVER (PARTITION BY pid, kind ORDER BY day), 6) AS diff_7 FROM dl")
q("rolling_mean_std_rows", f"WITH {DAILY} SELECT pid, kind, day, " + ", ".join(f"round(avg(mean) OVER (PARTITION BY pid, kind ORDER BY day ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW), 6) AS mean_{k}, round(stddev_samp(mean) OVER (PARTITION BY pid, kind ORDER BY day ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW), 5) AS std_{k}" for k in (7, 14)) + " FROM dl")

# ---- stays: runs of consecutive days with an event
ISL = "isl AS (SELECT pid, day, DADD(day, -rn) AS grp FROM (SELECT pid, day, CAST(row_number() OVER (PARTITION BY pid ORDER BY day) AS INT) AS rn FROM (SELECT DISTINCT pid, e AS day FROM ev WHERE kind <> 'view') z) y)"
STAYS = ISL + ", st AS (SELECT pid, min(day) AS b, max(day) AS e, count(*) AS days FROM isl GROUP BY pid, grp)"
def _stays(spark, d):
    return sp_.stays(p.events(spark, d).filter("kind <> 'view'").select("pid", F.col("e").alias("day")).distinct())


@register("patient_stays", duck_text(f"WITH {STAYS} SELECT pid, b, e, days FROM st"))
def patient_stays(spark, d):
    return _stays(spark, d)




@register("bed_change_streak", duck_text("""WITH x AS (SELECT pid, e AS day, max(event_id) % 3 AS bed FROM ev GROUP BY pid, e), c AS (SELECT *, CASE WHEN lag(bed) OVER (PARTITION BY pid ORDER BY day) = bed AND DD(prev, day) = 1 THEN 0 ELSE 1 END AS fresh FROM (SELECT *, lag(day) OVER (PARTITION BY pid ORDER BY day) AS prev FROM x) z),
  g AS (SELECT *, sum(fresh) OVER (PARTITION BY pid ORDER BY day) AS grp FROM c) SELECT pid, day, bed, CAST(row_number() OVER (PARTITION BY pid, grp ORDER BY day) - 1 AS INT) AS streak FROM g"""))
def bed_change_streak(spark, d):
    beds = p.events(spark, d).groupBy("pid", F.col("e").alias("day")).agg((F.max("event_id") % 3).alias("bed"))
    return sp_.streaks(beds, "bed")



@register("split_stays_by_event", duck_text(f"""WITH {STAYS}, t AS (SELECT DISTINCT pid, e AS day FROM ev WHERE kind = 'error'), cuts AS (SELECT st.pid, st.b, st.e, st.b AS moment FROM st UNION SELECT st.pid, st.b, st.e, t.day FROM st JOIN t ON t.pid = st.pid AND t.day > st.b AND t.day <= DADD(st.e, 1)),
  n AS (SELECT *, lead(moment) OVER (PARTITION BY pid, b ORDER BY moment) AS nxt FROM cuts) SELECT pid, moment AS b, coalesce(DADD(nxt, -1), e) AS e FROM n WHERE moment <= e"""))
def split_stays_by_event(spark, d):
    cuts = p.events(spark, d).filter("kind = 'error'").select("pid", F.col("e").alias("day"))
    return sp_.split_stays(_stays(spark, d), cuts)


q("prior_stay_features", f"""WITH {STAYS}, j AS (SELECT a.pid, a.b, count(o.b) AS prior_stays, CAST(sum(CASE WHEN o.days <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS prior_short FROM st a LEFT JOIN st o ON o.pid = a.pid AND o.b < a.b AND o.e >= DADD(a.b, -90) GROUP BY a.pid, a.b),
  l AS (SELECT pid, b, lag(days) OVER (PARTITION BY pid ORDER BY b) AS prev_days, lag(e) OVER (PARTITION BY pid ORDER BY b) AS prev_end FROM st) SELECT j.pid, j.b, prior_stays, prior_short, prev_days, DD(prev_end, l.b) AS gap FROM j JOIN l ON j.pid = l.pid AND j.b = l.b""")
q("prediction_timestamps", f"WITH {STAYS} SELECT i.pid, st.b, i.day, CAST(CAST(i.day AS VARCHAR(10)) || ' 07:00:00' AS TIMESTAMP) AS moment FROM isl i JOIN st ON st.pid = i.pid AND i.day > st.b AND i.day <= st.e")
q("cumsum_within_stay", f"WITH {STAYS}, c AS (SELECT pid, e AS day, count(*) AS n FROM ev GROUP BY pid, e) SELECT st.pid, st.b, c.day, CAST(sum(c.n) OVER (PARTITION BY st.pid, st.b ORDER BY c.day) AS BIGINT) AS total FROM st JOIN c ON c.pid = st.pid AND c.day BETWEEN st.b AND st.e")
q("stay_target", f"WITH {STAYS}, t AS (SELECT pid, e AS day FROM ev WHERE kind = 'error'), x AS (SELECT st.pid, st.b, min(t.day) AS moved FROM st LEFT JOIN t ON t.pid = st.pid AND t.day BETWEEN st.b AND DADD(st.e, 1) GROUP BY st.pid, st.b) SELECT i.pid, i.day, coalesce(DD(i.day, x.moved) <= 3, FALSE) AS target FROM isl i JOIN st ON st.pid = i.pid AND i.day BETWEEN st.b AND st.e JOIN x ON x.pid = st.pid AND x.b = st.b")


@register("relative_time_bins", f"""WITH {p.EV}, {p.SP}, j AS (SELECT sp.pid, sp.day, v.value, floor((epoch_us(v.ts) - epoch_us(CAST(sp.day AS TIMESTAMP)) + 5 * 3600000000) / 43200000000.0) AS bin FROM sp JOIN ev v ON v.pid = sp.pid AND v.ts >= CAST(sp.day AS TIMESTAMP) - INTERVAL 17 HOUR AND v.ts < CAST(sp.day AS TIMESTAMP) + INTERVAL 7 HOUR)
  SELECT pid, day, count(*) FILTER (WHERE bin = 0) AS n_0, max(value) FILTER (WHERE bin = 0) AS max_0, round(avg(value) FILTER (WHERE bin = 0), 6) AS mean_0, count(*) FILTER (WHERE bin = -1) AS n_1, max(value) FILTER (WHERE bin = -1) AS max_1, round(avg(value) FILTER (WHERE bin = -1), 6) AS mean_1 FROM j GROUP BY pid, day""")
def relative_time_bins(spark, d):
    # a reading belongs to at most two midnights: no range join is needed
    ev = p.events(spark, d).withColumn("day", F.explode(F.array("e", F.date_add("e", 1))))
    hours = (F.unix_micros("ts") - F.unix_micros(F.col("day").cast("timestamp"))) / 3.6e9
    b = F.floor((hours + 5) / 12)
    pick = lambda k: F.when(F.col("bin") == k, F.col("value"))
    rows = ev.withColumn("bin", b).filter("bin IN (0, -1)").join(p.spine(spark, d).select("pid", "day"), ["pid", "day"])
    return rows.groupBy("pid", "day").agg(F.count(pick(0)).alias("n_0"), F.max(pick(0)).alias("max_0"), F.round(F.avg(pick(0)), 6).alias("mean_0"), F.count(pick(-1)).alias("n_1"), F.max(pick(-1)).alias("max_1"), F.round(F.avg(pick(-1)), 6).alias("mean_1"))


# ---- targets
NEXT = """SELECT s.pid, s.day, (SELECT min(t.e) FROM ev t WHERE t.pid = s.pid AND t.kind = 'error' AND t.e {} s.day) AS incident FROM sp s"""


def _next(spark, d, same_day):
    """The next incident on each spine day: one union, one window."""
    days = p.spine(spark, d).select("pid", "day", F.lit(None).cast("date").alias("at"), F.lit(True).alias("asked"))
    told = p.events(spark, d).filter("kind = 'error'").select("pid", (F.col("e") if same_day else F.date_sub("e", 1)).alias("day"), F.col("e").alias("at"), F.lit(False).alias("asked"))
    ahead = W.partitionBy("pid").orderBy("day").rangeBetween(0, W.unboundedFollowing)
    return days.unionByName(told).withColumn("incident", F.min("at").over(ahead)).filter("asked").select("pid", "day", "incident")


@register("forward_target", f"WITH {p.EV}, {p.SP}, n AS ({NEXT.format('>')}) SELECT pid, day, coalesce(incident - day <= 4, FALSE) AS target, CASE WHEN incident - day <= 4 THEN incident END AS incident FROM n")
def forward_target(spark, d):
    near = F.date_diff("incident", "day") <= 4
    return _next(spark, d, False).select("pid", "day", F.coalesce(near, F.lit(False)).alias("target"), F.when(near, F.col("incident")).alias("incident"))


@register("next_event_target", f"WITH {p.EV}, {p.SP}, n AS ({NEXT.format('>=')}) SELECT pid, day, incident, coalesce(incident - day <= 3, FALSE) AS in_3, coalesce(incident - day <= 7, FALSE) AS in_7 FROM n")
def next_event_target(spark, d):
    gap = F.date_diff("incident", "day")
    return _next(spark, d, True).select("pid", "day", "incident", F.coalesce(gap <= 3, F.lit(False)).alias("in_3"), F.coalesce(gap <= 7, F.lit(False)).alias("in_7"))


q("first_of_consecutive", "WITH a AS (SELECT p.pid, p.okey, p.day, max(t.day) AS moved FROM pr p LEFT JOIN tr t ON t.okey = p.okey AND t.planned GROUP BY p.pid, p.okey, p.day), l AS (SELECT *, lag(moved) OVER (PARTITION BY pid ORDER BY day, okey) AS before FROM a) SELECT pid, okey, day, moved FROM l WHERE moved IS NOT NULL AND before IS NULL")
q("prior_event_count", """WITH x AS (SELECT s.pid, s.day, count(v.event_id) AS n FROM sp s LEFT JOIN ev v ON v.pid = s.pid AND v.e = s.day AND v.kind = 'error' GROUP BY s.pid, s.day), w AS (SELECT pid, day, CAST(sum(n) OVER (PARTITION BY pid ORDER BY day) AS BIGINT) AS prior, max(CASE WHEN n > 0 THEN day END) OVER (PARTITION BY pid ORDER BY day) AS last_day FROM x)
  SELECT pid, day, prior, coalesce(DD(last_day, day), 9999) AS since FROM w""")
STRICT = """WITH u AS (SELECT pid, day, TRUE AS asked, CAST(NULL AS DATE) AS moment FROM sp UNION ALL SELECT pid, DADD(e, 1), FALSE, e FROM ev WHERE kind = '{kind}'), w AS (SELECT *, max(moment) OVER (PARTITION BY pid ORDER BY day) AS last_day, min(moment) OVER (PARTITION BY pid ORDER BY day) AS first_day, count(moment) OVER (PARTITION BY pid ORDER BY day) AS n FROM u)"""
q("strict_prior_asof", STRICT.format(kind="error") + " SELECT pid, day, last_day, n, coalesce(DD(last_day, day), 9999) AS since FROM w WHERE asked")
q("first_last_admission", STRICT.format(kind="signup") + " SELECT pid, day, first_day, last_day FROM w WHERE asked")
q("days_since_admission", STRICT.format(kind="signup").replace("DADD(e, 1)", "e") + " SELECT pid, day, coalesce(DD(first_day, day), 9999) AS since_first, coalesce(DD(last_day, day), 9999) AS since_last FROM w WHERE asked")
q("upt_incidents", "WITH a AS (SELECT DISTINCT pid, e AS day FROM ev WHERE kind = 'error' AND event_id % 2 = 0), b AS (SELECT DISTINCT pid, e AS day FROM ev WHERE kind = 'signup') SELECT coalesce(a.pid, b.pid) AS pid, coalesce(a.day, b.day) AS day, a.pid IS NOT NULL AS transfer, b.pid IS NOT NULL AS death FROM a FULL OUTER JOIN b ON a.pid = b.pid AND a.day = b.day")
q("admission_v2_same_day", "SELECT a.pid, a.event_id, a.ts FROM ev a LEFT ANTI JOIN ev b ON a.pid = b.pid AND a.e = b.e AND b.kind = 'error' AND b.ts < a.ts WHERE a.kind = 'signup'",
  "SELECT a.pid, a.event_id, a.ts FROM ev a WHERE a.kind = 'signup' AND NOT EXISTS (SELECT 1 FROM ev b WHERE a.pid = b.pid AND a.e = b.e AND b.kind = 'error' AND b.ts < a.ts)")
ASOF = """WITH t AS (SELECT pid, e AS day, {what} AS what, CAST(row_number() OVER (PARTITION BY pid, e ORDER BY {order}) AS INT) AS rn FROM ev WHERE kind IN ({kinds})), u AS (SELECT pid, day, CAST(NULL AS VARCHAR(20)) AS what, 1 AS asked FROM sp UNION ALL SELECT pid, day, what, 0 FROM t WHERE rn = 1),
  w AS (SELECT pid, day, asked, {last} AS what, max(CASE WHEN asked = 0 THEN day END) OVER (PARTITION BY pid ORDER BY day) AS moment FROM u)
  SELECT pid, day, coalesce(what, 'Unknown') AS what, coalesce(DD(moment, day), 9999) AS since FROM w WHERE asked = 1"""
for key, what, order, kinds in (
    ("arrival_type", "CASE kind WHEN 'signup' THEN 'Initial' WHEN 'purchase' THEN 'Readmission' ELSE 'Return' END", "CASE kind WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END, event_id", "'signup', 'purchase', 'click'"),
    ("arrival_from", "CASE event_id % 3 WHEN 0 THEN 'Hospital' WHEN 1 THEN 'Home' ELSE 'Other' END", "ts DESC, event_id DESC", "'signup'"),
    ("transfer_reason_asof", "CASE event_id % 4 WHEN 0 THEN 'Fall' WHEN 1 THEN 'Fever' ELSE 'Pain' END", "ts DESC, event_id DESC", "'error'"),
    ("asof_ffill_attribute", "CASE WHEN value > 100 THEN 'high' ELSE 'low' END", "ts DESC, event_id DESC", "'view'"),
):
    def _carry(spark, d, what=what, order=order, kinds=kinds):
        rank = F.expr(f"row_number() OVER (PARTITION BY pid, e ORDER BY {order})")
        told = p.events(spark, d).filter(f"kind IN ({kinds})").withColumns({"what": F.expr(what), "rn": rank}).filter("rn = 1")
        return asof.carried(p.spine(spark, d).select("pid", "day"), told.select("pid", F.col("e").alias("day"), "what"), "what", "Unknown")

    _carry.__name__ = key
    register(key, duck_text(ASOF.format(what=what, order=order, kinds=kinds, last="last_value(what IGNORE NULLS) OVER (PARTITION BY pid ORDER BY day, asked)")))(_carry)


#: Rows of a block of running weights.
BLOCK = 700


@register("ewm_halflife", f"""WITH {p.EV}, r AS (SELECT pid, event_id, value, row_number() OVER (PARTITION BY pid ORDER BY ts, event_id) AS i FROM ev WHERE kind = 'view')
  SELECT a.pid, a.event_id, round(sum(b.value * power(2.0, (b.i - a.i) / 7.0)) / sum(power(2.0, (b.i - a.i) / 7.0)), 6) AS ewm FROM r a JOIN r b ON a.pid = b.pid AND b.i <= a.i GROUP BY 1, 2""")
def ewm_halflife(spark, d):
    """Running sums in blocks of rows: weights are relative to the block's first row, so that they
    stay below 2 ** 100. Of earlier rows only the block before counts; what is older than that
    weighs less than 2 ** -100."""
    by = W.partitionBy("pid").orderBy("ts", "event_id")
    rows = p.events(spark, d).filter("kind = 'view'").withColumn("at", F.row_number().over(by) - 1)
    rows = rows.withColumns({"block": F.floor(F.col("at") / BLOCK), "at": F.col("at") % BLOCK})
    grown, inside = F.pow(F.lit(2.0), F.col("at") / 7.0), W.partitionBy("pid", "block").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"top": F.sum(F.col("value") * grown).over(inside) / grown, "weight": F.sum(grown).over(inside) / grown})
    ends = F.when(F.col("at") == BLOCK - 1, F.struct("top", "weight"))
    last = F.last(ends, ignorenulls=True).over(W.partitionBy("pid").orderBy("block", "at").rowsBetween(W.unboundedPreceding, -1))
    shrunk = F.pow(F.lit(2.0), -(F.col("at") + 1) / 7.0)
    carry = lambda c: F.coalesce(F.col(f"last.{c}") * shrunk, F.lit(0.0))
    ewm = (F.coalesce("top", F.when(F.col("last.top").isNotNull(), 0.0)) + carry("top")) / (F.col("weight") + carry("weight"))
    return rows.withColumn("last", last).select("pid", "event_id", F.round(ewm, 6).alias("ewm"))


# ---- ranks

@register("rank_first", duck_text("SELECT okey, client, day, CAST(row_number() OVER (PARTITION BY client, day ORDER BY score DESC, pid, okey) AS INT) AS rnk FROM pr"))
def rank_first(spark, d):
    return ranking.rank_first(p.predictions(spark, d), ["client", "day"], "score", ["pid", "okey"]).select("okey", "client", "day", "rnk")


q("group_rank", "SELECT okey, CAST(row_number() OVER (PARTITION BY fac, day ORDER BY score DESC, okey) AS INT) AS facility_rank, CAST(row_number() OVER (PARTITION BY client, fac, day ORDER BY score DESC, okey) AS INT) AS unit_rank FROM pr")
RK = "WITH r AS (SELECT okey, client, fac, pid, day, score, status, CAST(row_number() OVER (PARTITION BY client, day ORDER BY score DESC, okey) AS INT) AS rnk FROM pr)"

@register("relative_group_rank", duck_text(RK + " SELECT okey, round(CAST(rnk AS DOUBLE) / max(rnk) OVER (PARTITION BY client, day), 6) AS relative FROM r"))
def relative_group_rank(spark, d):
    ranked = ranking.rank_first(p.predictions(spark, d), ["client", "day"], "score", ["okey"])
    return ranked.select("okey", F.round(ranking.relative(["client", "day"]), 6).alias("relative"))



@register("rank_average_ties", duck_text("SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) + (count(*) OVER (PARTITION BY l_orderkey, l_quantity) - 1) / CAST(2 AS DOUBLE) AS avg_rank FROM lineitem"))
def rank_average_ties(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ranking.average_rank(["l_orderkey"], "l_quantity").alias("avg_rank"))



@register("topk_cutoff_flag", duck_text(RK + " SELECT okey, rnk, rnk <= least(2, max(rnk) OVER (PARTITION BY client, day)) AS by_number, rnk <= greatest(1, CAST(floor(max(rnk) OVER (PARTITION BY client, day) * CAST(0.15 AS DOUBLE)) AS INT)) AS by_share FROM r"))
def topk_cutoff_flag(spark, d):
    ranked = ranking.rank_first(p.predictions(spark, d), ["client", "day"], "score", ["okey"])
    return ranked.select("okey", "rnk", ranking.shown(["client", "day"], 2).alias("by_number"), ranking.shown(["client", "day"], 0.15).alias("by_share"))


q("threshold_per_group", "SELECT DISTINCT client, day, CAST(floor(count(*) OVER (PARTITION BY client, day) * CAST(0.5 AS DOUBLE)) AS INT) AS threshold FROM pr")
q("reverse_cumsum", "WITH g AS (SELECT fac, count(*) AS n FROM pr GROUP BY fac) SELECT fac, CAST(sum(n) OVER (ORDER BY fac) AS BIGINT) AS forward_sum, CAST(sum(n) OVER (ORDER BY fac DESC) AS BIGINT) AS reverse_sum FROM g")


@register("rank_series_label", f"""WITH {p.EV}, c AS (SELECT pid, pid % 5 AS fac, e AS day, count(*) AS n FROM ev GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY fac, day ORDER BY n DESC, pid) AS rnk FROM c), s AS (SELECT a.pid, a.day, {", ".join(f"max(CASE WHEN a.day - b.day = {k} THEN b.rnk END) AS r{k}" for k in range(4))} FROM r a JOIN r b ON a.pid = b.pid AND b.day BETWEEN a.day - 3 AND a.day GROUP BY 1, 2)
  SELECT pid, day, {"|| '-' ||".join(f"CASE WHEN r{k} IS NULL THEN 'none' WHEN r{k} <= 5 THEN 'top' ELSE 'rest' END" for k in (3, 2, 1, 0))} AS series FROM s""")
def rank_series_label(spark, d):
    counts = p.events(spark, d).groupBy("pid", "fac", F.col("e").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("rnk", F.row_number().over(W.partitionBy("fac", "day").orderBy(F.desc("n"), "pid")))
    by = W.partitionBy("pid").orderBy(F.unix_date("day"))
    at = lambda k: F.max("rnk").over(by.rangeBetween(-k, -k))
    label = lambda r: F.when(r.isNull(), "none").when(r <= 5, "top").otherwise("rest")
    return ranked.select("pid", "day", F.concat_ws("-", *[label(at(k)) for k in (3, 2, 1, 0)]).alias("series"))


NTH = "(month(day) = {m} AND isodow(day) = {w} AND day(day) BETWEEN {a} AND {b})"
HOLIDAYS = " OR ".join(["(month(day) = 1 AND day(day) = 1)", "(month(day) = 6 AND day(day) = 19 AND year(day) >= 2021)", "(month(day) = 7 AND day(day) = 4)", "(month(day) = 11 AND day(day) = 11)", "(month(day) = 12 AND day(day) = 25)", *[NTH.format(m=m, w=w, a=a, b=b) for m, w, a, b in ((1, 1, 15, 21), (2, 1, 15, 21), (5, 1, 25, 31), (9, 1, 1, 7), (10, 1, 8, 14), (11, 4, 22, 28))]])


@register("holiday_distance", f"""WITH e AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events UNION SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders), c AS (SELECT CAST(unnest(generate_series(min(day) - 400, max(day) + 400, INTERVAL 1 DAY)) AS DATE) AS day FROM e), f AS (SELECT day FROM c WHERE {HOLIDAYS}), h AS (SELECT day FROM f UNION SELECT day FROM c WHERE isodow(day) IN (6, 7))
  SELECT e.day, CAST(e.day - (SELECT max(h.day) FROM h WHERE h.day <= e.day) AS INT) AS since, CAST((SELECT min(h.day) FROM h WHERE h.day >= e.day) - e.day AS INT) AS until, CAST((SELECT min(f.day) FROM f WHERE f.day >= e.day) - e.day AS INT) AS until_holiday FROM e""")
def holiday_distance(spark, d):
    """Days to the last and next day off (weekends and federal holidays), and to the next federal
    holiday, for all days of events and orders; the calendar spans them and a year around."""
    days = table(spark, d, "events").select(F.to_date("ts").alias("day")).unionByName(table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))).distinct()
    cal = days.agg(F.explode(F.sequence(F.date_sub(F.min("day"), 400), F.date_add(F.max("day"), 400))).alias("day"))
    holiday = codes.us_federal_holiday(F.col("day"))
    year = W.partitionBy(F.lit(1)).orderBy("day")  # a row for each day of the calendar
    ahead = year.rowsBetween(0, W.unboundedFollowing)
    off, named = F.when(holiday | (F.weekday("day") >= 5), F.col("day")), F.when(holiday, F.col("day"))
    cal = cal.select("day", F.date_diff("day", F.last(off, True).over(year)).alias("since"), F.date_diff(F.first(off, True).over(ahead), "day").alias("until"), F.date_diff(F.first(named, True).over(ahead), "day").alias("until_holiday"))
    return days.join(cal, "day")
