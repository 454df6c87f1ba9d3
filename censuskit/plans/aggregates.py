"""Aggregations (inventory 2.4) that are plain rollups."""

from pyspark.sql import functions as F

from censuskit.operators import information
from censuskit.operators.asof import next_after
from censuskit.operators.scale import global_rank
from censuskit.plans import proxies as p
from censuskit.plans.registry import register
from censuskit.plans.sqlviews import duck_text, sql_query as q
from censuskit.sources.tables import table

KINDS = ["click", "error", "purchase", "signup", "view"]
q("pivot_event_count", "SELECT pid, e AS day, " + ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS cnt_{k}, CAST(max(CASE WHEN kind = '{k}' THEN 1 ELSE 0 END) AS INT) AS any_{k}" for k in KINDS) + " FROM ev GROUP BY pid, e")
q("group_min_max_mean", "SELECT pid, e AS day, kind, max(value) AS top, min(value) AS low, round(avg(value), 6) AS mean, round(max(value) - min(value), 6) AS span FROM ev GROUP BY pid, e, kind")
q("count_distinct_weekly", "SELECT fac, CAST(date_trunc('week', day) AS DATE) AS week, count(DISTINCT pid) AS patients FROM pr GROUP BY fac, CAST(date_trunc('week', day) AS DATE)")
for unit in ("week", "month"):
    q(f"transfer_rate_{unit}ly", f"""WITH p AS (SELECT fac, CAST(date_trunc('{unit}', day) AS DATE) AS span, count(DISTINCT pid) AS patients FROM pr GROUP BY fac, CAST(date_trunc('{unit}', day) AS DATE)),
      t AS (SELECT p.fac, CAST(date_trunc('{unit}', t.day) AS DATE) AS span, count(*) AS transfers FROM tr t JOIN pr p ON p.okey = t.okey GROUP BY p.fac, CAST(date_trunc('{unit}', t.day) AS DATE))
      SELECT p.fac, p.span, t.transfers, p.patients, round(CAST(t.transfers AS DOUBLE) / p.patients, 6) AS rate FROM p JOIN t ON p.fac = t.fac AND p.span = t.span""")
q("best_rank_rollup", """WITH r AS (SELECT *, CAST(row_number() OVER (PARTITION BY client, day ORDER BY score DESC, okey) AS INT) AS rnk FROM pr)
  SELECT t.okey, t.line, min(r.rnk) AS best, coalesce(bool_or(r.rnk <= 2), FALSE) AS shown, count(r.okey) AS n FROM tr t LEFT JOIN r ON r.pid = t.pid AND DD(r.day, t.day) BETWEEN 0 AND 60 GROUP BY t.okey, t.line""")
q("bool_and_group", "SELECT pid, bool_and(status = 'F') AS all_f, bool_and(score > 1000) AS all_large FROM pr GROUP BY pid")


@register("conditional_min", duck_text("SELECT p.okey, p.day, min(CASE WHEN t.day >= p.day THEN t.day END) AS first_transfer FROM pr p LEFT JOIN tr t ON t.pid = p.pid GROUP BY p.okey, p.day"))
def conditional_min(spark, d):
    """The first transfer on or after each prediction: one union and one window per patient."""
    asked = p.predictions(spark, d).select("pid", "day", "okey")
    told = p.transfers(spark, d).select("pid", "day", F.col("day").alias("at"))
    return next_after(asked, told, {"first_transfer": "at"}, strict=False).select("okey", "day", "first_transfer")


@register("having_filter", duck_text("WITH r AS (SELECT pid, row_number() OVER (ORDER BY score DESC, okey) AS rnk FROM pr) SELECT pid, CAST(min(rnk) AS INT) AS best FROM r GROUP BY pid HAVING min(rnk) <= 1000"))
def having_filter(spark, d):
    """Best rank of all predictions; the global order runs over ranges of the score."""
    ranked = global_rank(p.predictions(spark, d), "score", "okey")
    return ranked.groupBy("pid").agg(F.min("rnk").cast("int").alias("best")).filter("best <= 1000")


q("monthly_density", """WITH a AS (SELECT fac, CAST(date_trunc('month', day) AS DATE) AS mon, count(*) AS n FROM pr GROUP BY fac, CAST(date_trunc('month', day) AS DATE)),
  b AS (SELECT p.fac, CAST(date_trunc('month', t.day) AS DATE) AS mon, count(*) AS m FROM tr t JOIN pr p ON p.okey = t.okey GROUP BY p.fac, CAST(date_trunc('month', t.day) AS DATE))
  SELECT coalesce(a.fac, b.fac) AS fac, coalesce(a.mon, b.mon) AS mon, a.n, b.m, round(CAST(b.m AS DOUBLE) / a.n, 3) AS density FROM a FULL OUTER JOIN b ON a.fac = b.fac AND a.mon = b.mon""")
q("unit_census_pivot", """WITH u AS (SELECT day, count(*) FILTER (WHERE pid % 4 = 0) AS unit_0, count(*) FILTER (WHERE pid % 4 = 1) AS unit_1, count(*) FILTER (WHERE pid % 4 = 2) AS unit_2, count(*) FILTER (WHERE pid % 4 = 3) AS unit_3 FROM sp GROUP BY day),
  f AS (SELECT day, count(*) FILTER (WHERE fac = 0) AS floor_0, count(*) FILTER (WHERE fac = 1) AS floor_1 FROM sp GROUP BY day) SELECT u.day, unit_0, unit_1, unit_2, unit_3, floor_0, floor_1 FROM u JOIN f ON u.day = f.day""")
q("code_frequency", "SELECT p_type AS code, p_brand AS description, count(*) AS n FROM part GROUP BY p_type, p_brand ORDER BY n DESC, code, description")
q("top_n_categories", """WITH c AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY p_type, p_brand), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_type, p_brand) AS rn, greatest(least(count(CASE WHEN n >= 5 THEN 1 END) OVER (), 15), 10) AS most FROM c)
  SELECT p_type, p_brand, n FROM r WHERE rn <= most""",
  """WITH c AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY p_type, p_brand), m AS (SELECT greatest(least(count(*) FILTER (WHERE n >= 5), 15), 10) AS most FROM c), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_type, p_brand) AS rn FROM c)
  SELECT p_type, p_brand, n FROM r, m WHERE rn <= most""")
q("last_operational_month", "SELECT fac, CAST(date_trunc('month', max(day)) AS DATE) AS last_month FROM pr GROUP BY fac")
q("los_histogram", """WITH s AS (SELECT p.okey, least(DD(lag(p.day) OVER (PARTITION BY p.pid ORDER BY p.day, p.okey), p.day), 120) AS los, p.status = 'F' AS pos FROM pr p),
  g AS (SELECT los, count(*) FILTER (WHERE pos) AS n_pos, count(*) FILTER (WHERE NOT pos) AS n_neg FROM s WHERE los IS NOT NULL GROUP BY los), t AS (SELECT sum(n_pos) AS a, sum(n_neg) AS b FROM g)
  SELECT los, n_pos, n_neg, round(100.0 * CAST(n_pos AS DOUBLE) / CAST(a AS DOUBLE), 4) AS pct_pos, round(100.0 * CAST(n_neg AS DOUBLE) / CAST(b AS DOUBLE), 4) AS pct_neg FROM g CROSS JOIN t""".replace("DD(lag(p.day) OVER (PARTITION BY p.pid ORDER BY p.day, p.okey), p.day)", "DD(p.was, p.day)").replace("FROM pr p),\n  g", "FROM (SELECT *, lag(day) OVER (PARTITION BY pid ORDER BY day, okey) AS was FROM pr) p),\n  g"))
q("minmax_scale", "WITH m AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo) * 100, 4) AS scaled FROM orders CROSS JOIN m")
q("class_balance", """SELECT CASE WHEN day < DATE '1998-01-01' THEN 'train' WHEN day < DATE '2000-01-01' THEN 'valid' ELSE 'test' END AS split, count(*) AS n, count(*) FILTER (WHERE status = 'F') AS pos, count(*) FILTER (WHERE status <> 'F') AS neg,
  round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE status = 'F') / count(*), 4) AS pct_pos, round(CAST(count(*) FILTER (WHERE status <> 'F') AS DOUBLE) / count(*) FILTER (WHERE status = 'F'), 4) AS ratio FROM pr GROUP BY 1""",
  """SELECT CASE WHEN day < DATE '1998-01-01' THEN 'train' WHEN day < DATE '2000-01-01' THEN 'valid' ELSE 'test' END AS split, count(*) AS n, count(*) FILTER (WHERE status = 'F') AS pos, count(*) FILTER (WHERE status <> 'F') AS neg,
  round(100.0 * pos / n, 4) AS pct_pos, round(CAST(neg AS DOUBLE) / pos, 4) AS ratio FROM pr GROUP BY 1""")
q("facility_rank_stats", """WITH r AS (SELECT okey, pid, fac, day, CAST(row_number() OVER (PARTITION BY client, day ORDER BY score DESC, okey) AS INT) AS rnk FROM pr), b AS (SELECT t.okey, t.line, p.fac, min(r.rnk) AS best FROM tr t JOIN pr p ON p.okey = t.okey LEFT JOIN r ON r.pid = t.pid AND DD(r.day, t.day) BETWEEN 0 AND 90 GROUP BY t.okey, t.line, p.fac)
  SELECT fac, count(best) AS n, round(avg(best), 6) AS mean_rank, percentile_cont(0.5) WITHIN GROUP (ORDER BY CAST(best AS DOUBLE)) AS median_rank, round(stddev_samp(best), 6) AS std_rank, round(CAST(count(best) AS DOUBLE) / count(*), 6) AS recall FROM b GROUP BY fac""")
q("distinct_string_agg", "SELECT fac, array_join(array_sort(collect_set(client)), ',') AS clients FROM pr GROUP BY fac", "SELECT fac, string_agg(DISTINCT client, ',' ORDER BY client) AS clients FROM pr GROUP BY fac")
q("argmax_row", "WITH g AS (SELECT fac, client, count(*) AS n FROM pr GROUP BY fac, client) SELECT fac, max_by(client, struct(n, client)) AS client, max(n) AS n FROM g GROUP BY fac",
  "WITH g AS (SELECT fac, client, count(*) AS n FROM pr GROUP BY fac, client), r AS (SELECT *, row_number() OVER (PARTITION BY fac ORDER BY n DESC, client DESC) AS i FROM g) SELECT fac, client, n FROM r WHERE i = 1")
q("distinct_entities", "SELECT count(DISTINCT fac) AS facilities, count(DISTINCT pid) AS patients FROM pr")
q("median_of_daily_max", """WITH r AS (SELECT fac, day, row_number() OVER (PARTITION BY fac, day ORDER BY score DESC, okey) AS rnk FROM pr), m AS (SELECT fac, day, CAST(max(rnk) AS DOUBLE) AS top FROM r GROUP BY fac, day)
  SELECT fac, percentile_cont(0.5) WITHIN GROUP (ORDER BY top) AS median_top FROM m GROUP BY fac""")
q("label_agreement", """WITH t AS (SELECT okey, min(day) AS first_day FROM tr GROUP BY okey) SELECT p.client, count(*) AS n, round(avg(CASE WHEN (p.status = 'F') = (t.first_day IS NOT NULL) THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS share FROM pr p LEFT JOIN t ON t.okey = p.okey GROUP BY p.client""",
  """WITH t AS (SELECT okey, min(day) AS first_day FROM tr GROUP BY okey) SELECT p.client, count(*) AS n, round(avg(CASE WHEN (p.status = 'F') = (t.first_day IS NOT NULL) THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS share FROM pr p LEFT JOIN t ON t.okey = p.okey GROUP BY p.client""")
q("distinct_event_count_los", """WITH j AS (SELECT p.client, t.day, t.pid, DD(p.day, t.day) AS los FROM tr t JOIN pr p ON p.okey = t.okey)
  SELECT client, count(DISTINCT CASE WHEN los > 0 AND los <= 30 THEN CAST(pid AS VARCHAR(20)) || CAST(day AS VARCHAR(10)) END) AS short_stay, count(DISTINCT CASE WHEN los > 30 THEN CAST(pid AS VARCHAR(20)) || CAST(day AS VARCHAR(10)) END) AS long_stay FROM j GROUP BY client""")
q("row_sum_score", "SELECT o_orderkey, CAST(o_orderkey % 7 + o_custkey % 5 + CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 0 END + length(o_orderpriority) AS BIGINT) AS total FROM orders")
q("points_from_count", """WITH c AS (SELECT pid, e AS day, count(*) AS n FROM ev GROUP BY pid, e) SELECT pid, day, n, CASE WHEN n >= 7 THEN 4 WHEN n >= 5 THEN 3 WHEN n >= 3 THEN 2 WHEN n >= 1 THEN 1 ELSE 0 END AS points FROM c""")
q("share_by_group", """WITH g AS (SELECT client, count(*) AS n, count(*) FILTER (WHERE status = 'F') AS f FROM pr GROUP BY client) SELECT client, n, round(100.0 * CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE), 4) AS pct, round(100.0 * CAST(f AS DOUBLE) / n, 4) AS pct_f FROM g""")
q("rare_name_fallback", """WITH c AS (SELECT p_partkey, p_name, p_type, count(*) OVER (PARTITION BY p_brand, p_type, p_size) AS n FROM part) SELECT p_partkey, CASE WHEN n < 2 THEN p_type ELSE p_name END AS label FROM c""")
q("text_to_number_max", """WITH v AS (SELECT pid, e AS day, CASE WHEN event_id % 9 = 0 THEN 'Height required' ELSE CAST(CAST(value AS INT) AS VARCHAR(12)) END AS msg FROM ev) SELECT pid, day, max(TRY_CAST(msg AS INT)) AS top FROM v GROUP BY pid, day""",
  """WITH v AS (SELECT pid, e AS day, CASE WHEN event_id % 9 = 0 THEN 'Height required' ELSE CAST(CAST(trunc(value) AS INT) AS VARCHAR) END AS msg FROM ev) SELECT pid, day, max(TRY_CAST(msg AS INT)) AS top FROM v GROUP BY pid, day""")
q("daily_multi_agg_pivot", "SELECT pid, e AS day, " + ", ".join(f"round(percentile_cont(0.5) WITHIN GROUP (ORDER BY CASE WHEN kind = '{k}' THEN value END), 6) AS {k}_median, round(stddev_samp(CASE WHEN kind = '{k}' THEN value END), 6) AS {k}_std, max(CASE WHEN kind = '{k}' THEN value END) AS {k}_max, min(CASE WHEN kind = '{k}' THEN value END) AS {k}_min" for k in ("click", "purchase")) + " FROM ev GROUP BY pid, e")
q("binary_correlation", """WITH b AS (SELECT CAST(count(*) FILTER (WHERE x AND y) AS DOUBLE) AS a, CAST(count(*) FILTER (WHERE x AND NOT y) AS DOUBLE) AS b, CAST(count(*) FILTER (WHERE NOT x AND y) AS DOUBLE) AS c, CAST(count(*) FILTER (WHERE NOT x AND NOT y) AS DOUBLE) AS d
  FROM (SELECT status = 'F' AS x, score > 100000 AS y FROM pr) z) SELECT round((a * d - b * c) / sqrt((a + b) * (a + c) * (d + b) * (d + c)), 6) AS phi FROM b""")
q("fold_text_by_rest", """SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN count(CASE WHEN event_id % 11 = 0 THEN 1 END) > 0 THEN NULL ELSE array_join(transform(array_sort(collect_list(struct(event_id, event_type))), x -> x.event_type), '') END AS warnings FROM events GROUP BY user_id, CAST(ts AS DATE)""",
  """SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN count(CASE WHEN event_id % 11 = 0 THEN 1 END) > 0 THEN NULL ELSE string_agg(event_type, '' ORDER BY event_id) END AS warnings FROM events GROUP BY user_id, CAST(ts AS DATE)""")
#: Digamma of whole numbers by harmonic sums; at and near the third neighbour of a class.
NEAR = """WITH r AS (SELECT event_id AS id, value AS x, event_type AS y FROM events WHERE value IS NOT NULL), z AS (SELECT y, count(*) AS size FROM r GROUP BY y HAVING count(*) > 1),
  g AS (SELECT a.id, a.x, z.size, least(3, z.size - 1) AS k, abs(a.x - b.x) AS gap, row_number() OVER (PARTITION BY a.id ORDER BY abs(a.x - b.x)) AS i FROM r a JOIN r b ON a.y = b.y AND a.id <> b.id JOIN z ON z.y = a.y),
  d AS (SELECT id, x, size, k, gap AS dist FROM g WHERE i = k), m AS (SELECT d.id, any_value(d.size) AS size, any_value(d.k) AS k, count(*) AS m FROM d JOIN d p ON p.x = d.x OR (p.x > d.x - d.dist AND p.x < d.x + d.dist) GROUP BY d.id),
  h AS (SELECT n, sum(1.0::DOUBLE / greatest(n - 1, 1) * CASE WHEN n > 1 THEN 1 ELSE 0 END) OVER (ORDER BY n) - 0.5772156649015329 AS psi FROM range(1, (SELECT count(*) + 1 FROM r)) t(n))
  SELECT round(greatest(0, (SELECT psi FROM h WHERE n = (SELECT count(*) FROM m)) + avg(a.psi) - avg(b.psi) - avg(c.psi)), 6) AS mi FROM m JOIN h a ON a.n = m.k JOIN h b ON b.n = m.size JOIN h c ON c.n = m.m"""


@register("mutual_information", NEAR)
def mutual_information(spark, d):
    """Between the value and the type of events, from the third neighbours of each type."""
    mi = information.mutual_information(table(spark, d, "events"), "value", "event_type")
    return spark.createDataFrame([(round(mi, 6),)], "mi double")


q("chi2_score", """WITH f AS (SELECT l_returnflag AS y, sum(l_quantity) AS a, sum(l_tax) AS b, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY l_returnflag), e AS (SELECT *, sum(a) OVER () * n / sum(n) OVER () AS ea, sum(b) OVER () * n / sum(n) OVER () AS eb FROM f)
  SELECT round(sum((a - ea) * (a - ea) / ea), 4) AS quantity, round(sum((b - eb) * (b - eb) / eb), 4) AS tax FROM e""")
q("cramers_v", """WITH j AS (SELECT l_returnflag AS a, l_linestatus AS b, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1, 2), r AS (SELECT a, sum(n) AS na FROM j GROUP BY a), c AS (SELECT b, sum(n) AS nb FROM j GROUP BY b), t AS (SELECT sum(n) AS n FROM j),
  g AS (SELECT r.a, c.b, na * nb / t.n AS e, t.n AS total FROM r CROSS JOIN c CROSS JOIN t), x AS (SELECT sum((coalesce(j.n, 0) - e) * (coalesce(j.n, 0) - e) / e) AS chi2, max(total) AS n, CAST(count(DISTINCT g.a) AS DOUBLE) AS k, CAST(count(DISTINCT g.b) AS DOUBLE) AS m FROM g LEFT JOIN j ON j.a = g.a AND j.b = g.b)
  SELECT round(sqrt(greatest(0, chi2 / n - (k - 1) * (m - 1) / (n - 1)) / least(k - (k - 1) * (k - 1) / (n - 1) - 1, m - (m - 1) * (m - 1) / (n - 1) - 1)), 6) AS v FROM x""")
