"""Joins (inventory 2.3), set operations (2.7) and sorts and limits (2.6)."""

from pyspark.sql import Window as W, functions as F

from censuskit.operators import asof
from censuskit.plans import proxies as p
from censuskit.plans.registry import register
from censuskit.plans.sqlviews import duck_text, sql_query as q
from censuskit.sources.tables import table

# ---- joins
q("crosswalk_join", "SELECT o.o_orderkey, o.o_custkey, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
q("spine_left_join", """WITH a AS (SELECT pid, e AS day, count(*) AS n_views FROM ev WHERE kind = 'view' GROUP BY pid, e), b AS (SELECT pid, e AS day, round(max(value), 4) AS top FROM ev WHERE kind = 'purchase' GROUP BY pid, e)
  SELECT s.pid, s.fac, s.day, coalesce(a.n_views, 0) AS n_views, b.top FROM sp s LEFT JOIN a ON a.pid = s.pid AND a.day = s.day LEFT JOIN b ON b.pid = s.pid AND b.day = s.day""")
q("spine_full_outer", """WITH c AS (SELECT pid, day FROM sp WHERE pid % 3 <> 0), x AS (SELECT pid, e AS day, count(*) AS n FROM ev WHERE kind = 'error' GROUP BY pid, e)
  SELECT coalesce(c.pid, x.pid) AS pid, coalesce(c.day, x.day) AS day, coalesce(x.n, 0) AS n, c.pid IS NULL AS added FROM c FULL OUTER JOIN x ON c.pid = x.pid AND c.day = x.day""")
q("code_lookup_join", """WITH codes AS (SELECT replace(p_name || '.' || p_brand, '.', '') AS code, max(p_type) AS category FROM part GROUP BY 1)
  SELECT p.p_partkey, codes.category FROM part p LEFT JOIN codes ON replace(p.p_name || '.' || p.p_brand, '.', '') = codes.code""")
q("dim_left_join_chain", """SELECT l.l_orderkey, l.l_linenumber, p.p_brand, s.s_name, n.n_name, r.r_name FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
q("inner_theta_lookback", "SELECT p.okey, p.pid, p.day, t.day AS event_day, t.line FROM pr p JOIN tr t ON p.pid = t.pid AND t.day < p.day AND t.day >= DADD(p.day, -180)")
q("interval_overlap_join", "SELECT t.okey, t.line, t.day, p.okey AS prediction, p.score FROM tr t LEFT JOIN pr p ON p.pid = t.pid AND DD(p.day, t.day) BETWEEN 0 AND 3")
q("interval_exclude_same_day", "SELECT t.okey, t.line, t.day, p.okey AS prediction FROM tr t LEFT JOIN pr p ON p.pid = t.pid AND DD(p.day, t.day) BETWEEN 0 AND 3 AND DD(p.day, t.day) <> 0")
q("interval_exact_offset", """WITH j AS (SELECT p.client, DD(p.day, t.day) AS days FROM pr p JOIN tr t ON p.pid = t.pid AND t.day >= p.day AND t.day <= DADD(p.day, 3))
  SELECT client, days, count(*) AS n FROM j GROUP BY client, days""")
@register("asof_last_before", duck_text("SELECT p.okey, p.pid, p.day, (SELECT max(t.day) FROM tr t WHERE t.pid = p.pid AND t.day <= p.day) AS last_day FROM pr p"))
def asof_last_before(spark, d):
    told = p.transfers(spark, d).select("pid", "day", F.col("day").alias("moved"))
    return asof.last_before(p.predictions(spark, d).select("okey", "pid", "day"), told, {"last_day": "moved"})


@register("asof_next_after", duck_text("SELECT p.okey, p.pid, p.day, (SELECT min(t.day) FROM tr t WHERE t.pid = p.pid AND t.day > p.day) AS next_day FROM pr p"))
def asof_next_after(spark, d):
    told = p.transfers(spark, d).select("pid", "day", F.col("day").alias("moved"))
    return asof.next_after(p.predictions(spark, d).select("okey", "pid", "day"), told, {"next_day": "moved"})


q("stab_point_in_interval", """WITH i AS (SELECT pid, okey, day AS b, lead(day) OVER (PARTITION BY pid ORDER BY day, okey) AS e FROM pr)
  SELECT pid, okey, b, e FROM i WHERE b < DATE '1998-07-01' AND (e IS NULL OR e >= DATE '1998-07-01')""")
q("semi_join_in_subquery", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT pid FROM tr WHERE planned)")
q("anti_join_not_exists", "SELECT p.okey, p.pid, p.day FROM pr p WHERE NOT EXISTS (SELECT 1 FROM tr t WHERE t.pid = p.pid AND t.day = p.day)")
q("max_per_key_subquery", """WITH m AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY day DESC, okey DESC) AS rn FROM pr) SELECT pid, okey, day, score FROM m WHERE rn = 1""")
q("reduce_outer_merge", """SELECT pid, e AS day, count(*) FILTER (WHERE kind = 'click') AS clicks, count(*) FILTER (WHERE kind = 'error') AS errors, count(*) FILTER (WHERE kind = 'signup') AS signups
  FROM ev WHERE kind IN ('click', 'error', 'signup') GROUP BY pid, e""",
  """WITH a AS (SELECT pid, e AS day, count(*) AS clicks FROM ev WHERE kind = 'click' GROUP BY 1, 2), b AS (SELECT pid, e AS day, count(*) AS errors FROM ev WHERE kind = 'error' GROUP BY 1, 2),
  c AS (SELECT pid, e AS day, count(*) AS signups FROM ev WHERE kind = 'signup' GROUP BY 1, 2), ab AS (SELECT pid, day, clicks, errors FROM a FULL JOIN b USING (pid, day))
  SELECT pid, day, coalesce(clicks, 0) AS clicks, coalesce(errors, 0) AS errors, coalesce(signups, 0) AS signups FROM ab FULL JOIN c USING (pid, day)""")
RANKED = """WITH r AS (SELECT *, CAST(row_number() OVER (PARTITION BY client, day ORDER BY score DESC, okey) AS INT) AS rnk, CAST(row_number() OVER (PARTITION BY client, day ORDER BY okey) AS INT) AS rnk_b FROM pr),
  best AS (SELECT t.okey, t.line, min(r.rnk) AS a, min(r.rnk_b) AS b FROM tr t LEFT JOIN r ON r.pid = t.pid AND DD(r.day, t.day) BETWEEN 0 AND 120 GROUP BY t.okey, t.line)"""
q("self_compare_join", RANKED + """ SELECT count(*) FILTER (WHERE a <= 1 AND b <= 1) AS caught_both, count(*) FILTER (WHERE a <= 1 AND NOT coalesce(b <= 1, FALSE)) AS caught_a, count(*) FILTER (WHERE b <= 1 AND NOT coalesce(a <= 1, FALSE)) AS caught_b, count(*) AS n FROM best""")
q("caught_missed_matrix", RANKED + " SELECT coalesce(a <= 1, FALSE) AS caught_a, coalesce(b <= 1, FALSE) AS caught_b, count(*) AS n FROM best GROUP BY 1, 2")


@register("lookback_count_last", duck_text("""SELECT s.pid, s.day, count(v.event_id) AS n, max(v.e) AS last_day FROM sp s LEFT JOIN ev v ON v.pid = s.pid AND v.kind = 'error' AND v.e < s.day AND v.e >= DADD(s.day, -5) GROUP BY s.pid, s.day"""))
def lookback_count_last(spark, d):
    """Number and last day of the events of five days before: one union and one window."""
    days = p.spine(spark, d).select("pid", "day", F.lit(None).cast("date").alias("at"), F.lit(True).alias("asked"))
    told = p.events(spark, d).filter("kind = 'error'").select("pid", F.col("e").alias("day"), F.col("e").alias("at"), F.lit(False).alias("asked"))
    before = W.partitionBy("pid").orderBy(F.unix_date("day")).rangeBetween(-5, -1)
    return days.unionByName(told).withColumns({"n": F.count("at").over(before), "last_day": F.max("at").over(before)}).filter("asked").select("pid", "day", "n", "last_day")



# ---- set operations
q("union_distinct_events", "SELECT pid, day FROM tr UNION SELECT pid, day FROM pr WHERE status = 'F'")
q("union_all_events", "SELECT pid, day, 'transfer' AS what FROM tr UNION ALL SELECT pid, day, 'admission' AS what FROM pr")
q("select_distinct", "SELECT DISTINCT p.client, p.fac, p.status, t.reason, t.planned FROM tr t JOIN pr p ON t.okey = p.okey")
q("symmetric_difference", """WITH a AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 2 = 1)
  SELECT k, s, 'a' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) x UNION ALL SELECT k, s, 'b' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) y""")
q("set_intersection", "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
@register("table_diff", """WITH a AS (SELECT o_orderkey AS k, o_totalprice AS price, o_orderstatus AS status FROM orders), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 WHEN o_orderkey % 10 = 1 THEN o_totalprice + 0.0001 ELSE o_totalprice END AS price,
    CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 20 <> 7),
  j AS (SELECT coalesce(a.k, b.k) AS k, a.k IS NULL AS no_a, b.k IS NULL AS no_b, a.price AS pa, b.price AS pb, a.status AS sa, b.status AS sb FROM a FULL OUTER JOIN b ON a.k = b.k)
  SELECT k, 'price' AS col FROM j WHERE NOT no_a AND NOT no_b AND (abs(pa - pb) > 0.001 OR (pa IS NULL) <> (pb IS NULL)) UNION ALL SELECT k, 'status' AS col FROM j WHERE NOT no_a AND NOT no_b AND sa IS DISTINCT FROM sb
  UNION ALL SELECT k, CASE WHEN no_a THEN 'only in b' ELSE 'only in a' END AS col FROM j WHERE no_a OR no_b""")
def table_diff(spark, d):
    """Keys in one table only, and columns that differ: one join, each row told once for each difference."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    price = F.when(k % 10 == 0, F.col("o_totalprice") + 1).when(k % 10 == 1, F.col("o_totalprice") + 0.0001).otherwise(F.col("o_totalprice"))
    a = o.select(k.alias("ka"), F.col("o_totalprice").alias("pa"), F.col("o_orderstatus").alias("sa"))
    b = o.filter(k % 20 != 7).select(k.alias("kb"), price.alias("pb"), F.when(k % 15 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("sb"))
    no_a, no_b = F.col("ka").isNull(), F.col("kb").isNull()
    moved = (F.abs(F.col("pa") - F.col("pb")) > 0.001) | (F.col("pa").isNull() != F.col("pb").isNull())
    told = F.array(
        F.when(~no_a & ~no_b & moved, "price"), F.when(~no_a & ~no_b & ~F.col("sa").eqNullSafe(F.col("sb")), "status"), F.when(no_a, "only in b").when(no_b, "only in a")
    )
    return a.join(b, F.col("ka") == F.col("kb"), "full").select(F.coalesce("ka", "kb").alias("k"), F.explode(F.array_compact(told)).alias("col"))

# ---- top-k, sorts
q("topk_per_group_metric", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY fac, day ORDER BY score DESC, okey) AS rn FROM pr) SELECT fac, day, okey, score FROM r WHERE rn <= 3")
q("latest_version_pick", """WITH v AS (SELECT kind || '_count_' || CAST(event_id % 4 * 7 + 2 AS VARCHAR(3)) || '_day' AS feature, kind AS mapped, event_id % 4 * 7 + 2 AS days, pid FROM ev), d AS (SELECT DISTINCT pid, mapped, feature, days FROM v),
  r AS (SELECT *, row_number() OVER (PARTITION BY pid, mapped ORDER BY days) AS rn FROM d) SELECT pid, mapped, feature, days FROM r WHERE rn = 1""",
  """WITH v AS (SELECT DISTINCT user_id AS pid, event_type AS mapped, event_id % 4 * 7 + 2 AS days FROM events) SELECT pid, mapped, mapped || '_count_' || min(days) || '_day' AS feature, min(days) AS days FROM v GROUP BY pid, mapped""")
q("top5_attributions", "WITH r AS (SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS INT) AS rnk FROM lineitem) SELECT p.okey, p.client, r.l_linenumber, r.rnk FROM pr p LEFT JOIN r ON r.l_orderkey = p.okey AND r.rnk <= 5")
q("nlargest_group", "SELECT fac, max(extract(YEAR FROM day) * 100 + extract(MONTH FROM day)) AS last_month FROM pr GROUP BY fac", "SELECT fac, CAST(max(extract(YEAR FROM day) * 100 + extract(MONTH FROM day)) AS INT) AS last_month FROM pr GROUP BY fac")
q("sort_report", "SELECT client, fac, count(*) AS n, round(sum(score), 2) AS total FROM pr GROUP BY client, fac ORDER BY client, n DESC, fac")
