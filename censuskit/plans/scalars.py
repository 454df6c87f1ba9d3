"""Scalar functions (inventory 2.8)."""

from pyspark.sql import functions as F

from censuskit.functions import codes
from censuskit.plans.registry import register
from censuskit.plans.sqlviews import sql_query as q
from censuskit.sources.tables import table


@register("date_parts", """SELECT o_orderkey, CAST(year(d) AS INT) AS y, CAST(month(d) AS INT) AS m, CAST(weekofyear(d) AS INT) AS w, CAST(day(d) AS INT) AS dd, CAST(isodow(d) - 1 AS INT) AS wd, day(d) = 1 AS month_start, d = last_day(d) AS month_end, d = CAST(date_trunc('quarter', d) AS DATE) AS quarter_start,
  d = CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE) - 1 AS quarter_end, month(d) = 1 AND day(d) = 1 AS year_start, month(d) = 12 AND day(d) = 31 AS year_end FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_parts(spark, d):
    c = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", *[x.alias(n) for n, x in codes.calendar_parts(c).items()])


q("season_and_names", """SELECT pid, day, CASE WHEN extract(MONTH FROM day) IN (12, 1, 2) THEN 'winter' WHEN extract(MONTH FROM day) IN (3, 4, 5) THEN 'spring' WHEN extract(MONTH FROM day) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season, date_format(day, 'EEEE') AS day_name, date_format(day, 'MMMM') AS month_name, weekday(day) < 5 AS is_weekday FROM sp""",
  """SELECT pid, day, CASE WHEN extract(MONTH FROM day) IN (12, 1, 2) THEN 'winter' WHEN extract(MONTH FROM day) IN (3, 4, 5) THEN 'spring' WHEN extract(MONTH FROM day) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season, dayname(day) AS day_name, monthname(day) AS month_name, isodow(day) < 6 AS is_weekday FROM sp""")
HOLIDAY = """(m = 1 AND dd = 1) OR (m = 7 AND dd = 4) OR (m = 12 AND dd = 25) OR (m = 11 AND dd = 11) OR (m = 6 AND dd = 19 AND y >= 2021) OR (m = 1 AND wd = 1 AND dd BETWEEN 15 AND 21) OR (m = 2 AND wd = 1 AND dd BETWEEN 15 AND 21) OR (m = 5 AND wd = 1 AND dd >= 25) OR (m = 9 AND wd = 1 AND dd <= 7) OR (m = 10 AND wd = 1 AND dd BETWEEN 8 AND 14) OR (m = 11 AND wd = 4 AND dd BETWEEN 22 AND 28)"""


@register("business_day_flags", f"WITH d AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS dd, isodow(o_orderdate) AS wd FROM orders) SELECT o_orderkey, {HOLIDAY} AS holiday, wd < 6 AND NOT ({HOLIDAY}) AS business_day FROM d")
def business_day_flags(spark, d):
    c = F.to_date("o_orderdate")
    holiday = codes.us_federal_holiday(c)
    return table(spark, d, "orders").select("o_orderkey", holiday.alias("holiday"), ((F.weekday(c) < 5) & ~holiday).alias("business_day"))


q("hour_bucket", "SELECT event_id, CASE WHEN extract(HOUR FROM ts) BETWEEN 8 AND 15 THEN 'morning' WHEN extract(HOUR FROM ts) >= 16 THEN 'afternoon' ELSE 'night' END AS shift FROM ev")
q("age_in_days", "SELECT okey, DD(born, day) AS age FROM (SELECT okey, day, DADD(DATE '1930-01-01', pid % 9000) AS born FROM pr) z".replace("DADD(DATE '1930-01-01', pid % 9000)", "DADD(start, off)").replace("FROM pr) z", "FROM (SELECT *, DATE '1930-01-01' AS start, pid % 9000 AS off FROM pr) y) z"))
q("regex_contains", "SELECT doc_id, text RLIKE 'license|moron|token' AS hit FROM documents", "SELECT doc_id, regexp_matches(text, 'license|moron|token') AS hit FROM documents")
W = "(SELECT pid, e, CASE event_id % 5 WHEN 0 THEN '[High of 100 exceeded]' WHEN 1 THEN '[Low of 5] ; [change +]' WHEN 2 THEN '[10% change -]' WHEN 3 THEN '' END AS warning FROM ev) w"
q("warning_flags", f"""SELECT pid, e AS day, CAST(max(CASE WHEN lower(warning) LIKE '%high%' THEN 1 ELSE 0 END) AS INT) AS high, CAST(max(CASE WHEN lower(warning) LIKE '%low%' THEN 1 ELSE 0 END) AS INT) AS low, CAST(max(CASE WHEN warning LIKE '%+%' THEN 1 ELSE 0 END) AS INT) AS plus, CAST(max(CASE WHEN warning LIKE '%-%' THEN 1 ELSE 0 END) AS INT) AS minus FROM {W} GROUP BY pid, e""")
q("warning_vocabulary", f"SELECT pid, e AS day, word, count(*) AS n FROM (SELECT pid, e, explode(split(regexp_replace(warning, '[\\\\[\\\\]]', ''), ' ; ')) AS word FROM {W}) x WHERE word LIKE '%change%' GROUP BY pid, e, word",
  f"SELECT pid, e AS day, word, count(*) AS n FROM (SELECT pid, e, unnest(string_split(regexp_replace(warning, '[\\[\\]]', '', 'g'), ' ; ')) AS word FROM {W}) x WHERE word LIKE '%change%' GROUP BY pid, e, word")
q("text_normalize_name", "SELECT p_partkey, concat_ws('__', trim(regexp_replace(p_name, '[_ ]+', ' ')), trim(regexp_replace(p_type || '_' || p_brand, '[_ ]+', ' '))) AS name FROM part", "SELECT p_partkey, concat_ws('__', trim(regexp_replace(p_name, '[_ ]+', ' ', 'g')), trim(regexp_replace(p_type || '_' || p_brand, '[_ ]+', ' ', 'g'))) AS name FROM part")
q("prefix_before_colon", "SELECT event_id, split_part(event_type || ':' || CAST(event_id AS VARCHAR(20)) || ':x', ':', 1) AS prefix FROM events")

RULES = [("^click_.*", "web", "Clicks"), ("^.*_sum_2_day$", "recent", "Recent sums"), ("^(error|purchase)_.*", "care", "Care"), (".*", "other", "Other")]
FEATURE = "(SELECT event_id, event_type || CASE WHEN event_id % 3 = 0 THEN '_sum_2_day' WHEN event_id % 3 = 1 THEN '_count_' || CAST(event_id % 30 AS VARCHAR(4)) || '_day' ELSE '_all' END AS feature FROM events) f"


@register("feature_regex_map", f"SELECT event_id, feature, CASE {' '.join(f'''WHEN regexp_matches(feature, '{r}') THEN '{t}' ''' for r, t, _ in RULES)} END AS kind, CASE {' '.join(f'''WHEN regexp_matches(feature, '{r}') THEN '{g}' ''' for r, _, g in RULES)} END AS grp FROM {FEATURE}")
def feature_regex_map(spark, d):
    """The first rule that fits, by order; distinct features are matched once and joined back."""
    e = table(spark, d, "events")
    tail = F.when(F.col("event_id") % 3 == 0, "_sum_2_day").when(F.col("event_id") % 3 == 1, F.concat(F.lit("_count_"), (F.col("event_id") % 30).cast("string"), F.lit("_day"))).otherwise("_all")
    rows = e.select("event_id", F.concat("event_type", tail).alias("feature"))
    return rows.join(codes.first_rule(rows.select("feature").distinct(), "feature", RULES), "feature").select("event_id", "feature", "kind", "grp")


q("regex_extract_int", f"SELECT event_id, coalesce(TRY_CAST(nullif(regexp_extract(feature, '_([0-9]+)_day', 1), '') AS INT), 100) AS days FROM {FEATURE}")


@register("rug_decode", """WITH r AS (SELECT p_partkey, substr('RUXCLPBSHE', CAST(p_partkey % 10 AS INT) + 1, 1) || substr('ABCDE12', CAST(p_partkey % 7 AS INT) + 1, 1) || CAST(p_partkey % 3 AS VARCHAR) AS rug FROM part)
  SELECT p_partkey, rug, CASE substr(rug, 1, 1) WHEN 'R' THEN 'Rehabilitation' WHEN 'E' THEN 'Extensive Services' WHEN 'H' THEN 'Special Care High' WHEN 'L' THEN 'Special Care Low' WHEN 'C' THEN 'Clinically Complex' WHEN 'B' THEN 'Behavioral' WHEN 'P' THEN 'Reduced Physical' ELSE 'Unknown' END AS category,
  CASE WHEN substr(rug, 1, 1) IN ('H', 'L', 'C') THEN substr(rug, 3, 1) = '2' END AS depression, CASE WHEN substr(rug, 1, 1) IN ('B', 'P') THEN CAST(substr(rug, 3, 1) AS INT) END AS nursing FROM r""")
def rug_decode(spark, d):
    k = F.col("p_partkey")
    rug = F.concat(F.substring(F.lit("RUXCLPBSHE"), (k % 10).cast("int") + 1, F.lit(1)), F.substring(F.lit("ABCDE12"), (k % 7).cast("int") + 1, F.lit(1)), (k % 3).cast("string"))
    return table(spark, d, "part").select("p_partkey", rug.alias("rug")).select("p_partkey", "rug", *[c.alias(n) for n, c in codes.rug_parts(F.col("rug")).items()])


q("ordinal_suffix", "SELECT p_partkey, CAST(p_partkey AS VARCHAR(12)) || CASE WHEN p_partkey % 100 BETWEEN 11 AND 13 THEN 'th' WHEN p_partkey % 10 = 1 THEN 'st' WHEN p_partkey % 10 = 2 THEN 'nd' WHEN p_partkey % 10 = 3 THEN 'rd' ELSE 'th' END AS ordinal FROM part")
q("sigmoid_platt", "SELECT event_id, round(1 / (1 + exp(-(CAST(0.8 AS DOUBLE) * ln(s / (1 - s)) - CAST(0.3 AS DOUBLE)))), 8) AS score FROM (SELECT event_id, (value + 1) / 600 AS s FROM events) z")
q("f_beta", "SELECT client, round(5 * p * r / nullif(4 * p + r, 0), 6) AS f2 FROM (SELECT client, avg(CASE WHEN score > 100000 THEN CASE WHEN status = 'F' THEN CAST(1 AS DOUBLE) ELSE 0 END END) AS p, avg(CASE WHEN status = 'F' THEN CASE WHEN score > 100000 THEN CAST(1 AS DOUBLE) ELSE 0 END END) AS r FROM pr GROUP BY client) z")
q("label_string_build", "SELECT okey, CASE WHEN status = 'F' THEN 'Fell' WHEN status = 'O' THEN 'Ordered' ELSE 'Pending' END || ' on ' || date_format(day, 'MM/dd/yyyy') || ' (patient ' || CAST(pid AS VARCHAR(12)) || ')' AS reason FROM pr",
  "SELECT okey, CASE WHEN status = 'F' THEN 'Fell' WHEN status = 'O' THEN 'Ordered' ELSE 'Pending' END || ' on ' || strftime(day, '%m/%d/%Y') || ' (patient ' || pid || ')' AS reason FROM pr")


@register("one_hot", "SELECT c_custkey, " + ", ".join(f"CAST(c_mktsegment = '{s}' AS INT) AS segment_{s.lower()}" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM customer")
def one_hot(spark, d):
    return table(spark, d, "customer").select("c_custkey", *[(F.col("c_mktsegment") == s).cast("int").alias(f"segment_{s.lower()}") for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")])


q("category_codes", "WITH d AS (SELECT client, CAST(dense_rank() OVER (ORDER BY client) - 1 AS INT) AS code FROM (SELECT DISTINCT client FROM pr WHERE day < DATE '1999-01-01' AND client <> 'BUILDING') z) SELECT p.okey, p.client, d.code FROM pr p LEFT JOIN d ON d.client = p.client WHERE p.day >= DATE '1999-01-01'")


@register("vector_unit", "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 4) AS norm, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * y))))), 4) AS unit_sum FROM embeddings")
def vector_unit(spark, d):
    unit = codes.unit_vector(F.col("v"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return v.select("vec_id", F.round(F.sqrt(total(F.transform("v", lambda x: x * x))), 4).alias("norm"), F.round(total(unit), 4).alias("unit_sum"))
