"""Sources, sinks and gates (inventory 2.1), projection and cleaning (2.2), set-wise profiles (2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from censuskit.operators import frames, wide
from censuskit.plans.registry import register
from censuskit.plans.sqlviews import run, sql_query as q
from censuskit.sources import database
from censuskit.sources.tables import table


# ---- sources and sinks
q("src_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
q("src_sql_dataset", "SELECT o.o_orderkey, c.c_mktsegment, o.o_totalprice FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND c.c_nationkey IN (1, 2, 3)")


@register("src_jdbc_dataset", "SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'P'")
def src_jdbc_dataset(spark, d):
    """Orders written to a database and read back in eight parts; the database applies the filters."""
    connection = database.database_url(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    database.write_table(orders, "orders_copy", connection, types="o_orderstatus VARCHAR(32)")
    read = database.read_table(spark, "orders_copy", connection, key="o_orderkey")
    return read.filter("o_totalprice > 100000 AND o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice", "day")


@register("src_csv_lookup", "SELECT p_partkey AS code, p_name AS label, p_type AS category FROM part")
def src_csv_lookup(spark, d):
    """Codes written with quotes in header and cells come back without them."""
    path = frames.new_folder(spark, "lookup")
    quoted = lambda c: F.concat(F.lit("'"), F.col(c).cast("string"), F.lit("'"))
    table(spark, d, "part").select(quoted("p_partkey").alias("'code'"), quoted("p_name").alias("'label'"), quoted("p_type").alias("'category'")).write.option("header", True).csv(path)
    return frames.read_quoted_csv(spark, path).withColumn("code", F.col("code").cast("bigint"))


@register("src_cache_strategy", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def src_cache_strategy(spark, d):
    path = frames.new_folder(spark, "cache")
    build = lambda: table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    frames.cached(spark, path, build, "check_cache_first")
    return frames.cached(spark, path, build, "only_use_cache")


@register("sink_parquet", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def sink_parquet(spark, d):
    path = frames.new_folder(spark, "sink")
    table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    return spark.read.schema("o_orderkey long, o_totalprice double, o_orderstatus string").parquet(path)


@register("sink_csv", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def sink_csv(spark, d):
    path = frames.new_folder(spark, "csv")
    table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.option("header", True).csv(path)
    return spark.read.option("header", True).schema("o_orderkey long, o_totalprice double, o_orderstatus string").csv(path)


@register("sink_replace_slice", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS price, o_orderstatus FROM orders""")
def sink_replace_slice(spark, d):
    path = frames.new_folder(spark, "slices")
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    rows.write.partitionBy("o_orderstatus").parquet(path)
    for _ in range(2):  # writing a slice again changes nothing
        frames.replace_slices(rows.filter("o_orderstatus = 'F'").withColumn("price", F.col("price") * 2), path, ["o_orderstatus"])
    return spark.read.schema("o_orderkey long, price double, o_orderstatus string").parquet(path)


NEWS = "o_orderkey % 3 = 0 AND o_orderstatus <> 'P'"


@register("sink_merge_replace", f"SELECT o_orderkey, o_orderstatus, CASE WHEN {NEWS} THEN 0 ELSE o_totalprice END AS price FROM orders")
def sink_merge_replace(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    return frames.merge_replace(rows, rows.filter(NEWS).withColumn("price", F.lit(0.0)), ["o_orderkey", "o_orderstatus"])


@register("sink_soft_delete_version", """SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 5 = 0 THEN DATE '2024-06-01' END AS deleted_at FROM customer UNION ALL SELECT c_custkey, c_acctbal + 1, NULL FROM customer WHERE c_custkey % 5 = 0""")
def sink_soft_delete_version(spark, d):
    live = table(spark, d, "customer").select("c_custkey", "c_acctbal").withColumn("deleted_at", F.lit(None).cast("date"))
    fresh = live.filter("c_custkey % 10 IN (0, 5)").withColumn("c_acctbal", F.col("c_acctbal") + 1).drop("deleted_at")
    same = live.filter("c_custkey % 10 = 3").drop("deleted_at")  # no new version where nothing changed
    return frames.new_versions(live, fresh.unionByName(same), ["c_custkey"], "2024-06-01")


@register("coerce_date_columns", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) END AS eventdate, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date_added, event_type FROM events")
def coerce_date_columns(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, "unknown").otherwise(text).alias("eventdate"), F.date_format("ts", "yyyy-MM-dd").alias("date_added"), "event_type")
    return frames.coerce_dates(raw)


# ---- gates: one row that says what was found; failing raises in frames.require
q("freshness_gate", "WITH a AS (SELECT max(e) AS last_event FROM ev), b AS (SELECT max(day) AS last_order FROM pr) SELECT last_event, last_order, last_event >= DATE '2024-01-29' OR last_order >= DATE '2024-01-29' AS fresh FROM a CROSS JOIN b")
q("volume_gate", "SELECT count(*) AS n, CASE WHEN count(*) < 1000 THEN 'too few' WHEN count(*) < 4000 THEN 'below average' WHEN count(*) <= 6000 THEN 'above average' ELSE 'too many' END AS verdict FROM sp")
q("required_dataset_gate", "SELECT 'events' AS name, TRUE AS required, count(*) AS n, count(*) > 0 AS ok FROM events UNION ALL SELECT 'notes' AS name, FALSE AS required, count(*) AS n, TRUE AS ok FROM conversations WHERE role = 'nobody'")


@register("union_sources", "SELECT 'a_' || o_custkey AS patient, 'a' AS client, o_totalprice AS price, NULL AS segment FROM orders UNION ALL SELECT 'b_' || c_custkey, 'b', NULL, c_mktsegment FROM customer")
def union_sources(spark, d):
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("patient"), F.col("o_totalprice").alias("price"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("patient"), F.col("c_mktsegment").alias("segment"))
    return frames.union_clients({"a": a, "b": b}, ["patient"])


# ---- projection, filters, cleaning
RANGES = [("click", 10.0, 200.0), ("error", 5.0, 300.0), ("purchase", 0.0, 100.0)]


@register("clip_to_null_ranges", "SELECT event_id, event_type, value FROM events WHERE (event_type = 'click' AND value BETWEEN 10 AND 200) OR (event_type = 'error' AND value BETWEEN 5 AND 300) OR (event_type = 'purchase' AND value BETWEEN 0 AND 100) OR event_type NOT IN ('click', 'error', 'purchase')")
def clip_to_null_ranges(spark, d):
    ranges = spark.createDataFrame(RANGES, "event_type string, low double, high double")
    return frames.clip_to_ranges(table(spark, d, "events").select("event_id", "event_type", "value"), ranges, "event_type", "value").filter("value IS NOT NULL")


q("split_measure_column", "SELECT l_orderkey, l_linenumber, 'quantity' AS measure, l_quantity AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'price' AS measure, l_extendedprice AS value FROM lineitem WHERE l_returnflag = 'R'")
q("hospice_filter", "SELECT p_partkey, coalesce(position('steel' IN lower(CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type || ' Steel ' || p_name END)) > 0, FALSE) AND p_partkey % 2 = 0 AS hospice FROM part")
q("null_or_not_equal", "SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END IS DISTINCT FROM 'F'")
q("like_filter", "SELECT p_partkey, p_name FROM part WHERE CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_name END IS NULL OR lower(p_name) NOT LIKE '%1%'")
q("in_list_filter", "SELECT event_id FROM events WHERE event_type IN ('click', 'view') AND user_id NOT IN (1, 2, 3)")


@register("drop_columns_regex", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def drop_columns_regex(spark, d):
    return frames.drop_matching(table(spark, d, "lineitem"), r"price|disc|tax|date|status|part|supp")


@register("reindex_fill_by_pattern", "SELECT o_orderkey, o_totalprice, CAST(9999 AS INT) AS days_since_fall, CAST(0 AS INT) AS count_falls, CAST(NULL AS INT) AS weight FROM orders")
def reindex_fill_by_pattern(spark, d):
    return frames.reindex(table(spark, d, "orders"), ["o_orderkey", "o_totalprice", "days_since_fall", "count_falls", "weight"], {r"^days_since": 9999, r"^count_": 0})


q_wide = "SELECT o_orderkey, o_custkey, CAST(NULL AS INT) AS empty, 1 AS fixed, CASE WHEN o_orderkey % 2000 = 0 THEN 1 ELSE 0 END AS rare, CASE WHEN o_orderkey % 2 = 0 THEN 9999 ELSE 5 END AS days FROM orders"


def _wide(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", "o_custkey", F.lit(None).cast("int").alias("empty"), F.lit(1).alias("fixed"), F.when(F.col("o_orderkey") % 2000 == 0, 1).otherwise(0).alias("rare"), F.when(F.col("o_orderkey") % 2 == 0, 9999).otherwise(5).alias("days"))


@register("drop_all_null_columns", f"SELECT * EXCLUDE (empty) FROM ({q_wide})")
def drop_all_null_columns(spark, d):
    return frames.drop_all_null(_wide(spark, d))


@register("drop_constant_columns", f"SELECT * EXCLUDE (fixed) FROM ({q_wide})")
def drop_constant_columns(spark, d):
    return frames.drop_constant(_wide(spark, d))


@register("drop_sparse_columns", f"SELECT * EXCLUDE (empty, rare) FROM ({q_wide})")
def drop_sparse_columns(spark, d):
    return frames.drop_sparse(_wide(spark, d), 0.999)


WIDE_GROUPS = {"orders": "^o_", "made": "^(empty|fixed|rare|days)$"}
SPARSE = " UNION ALL ".join(
    f"SELECT '{'orders' if c.startswith('o_') else 'made'}' AS grp, greatest(avg(CASE WHEN {c} = 0 THEN 1 ELSE 0 END), avg(CASE WHEN {c} = 9999 THEN 1 ELSE 0 END), avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)) AS top FROM w"
    for c in ("o_orderkey", "o_custkey", "empty", "fixed", "rare", "days")
)


@register("feature_group_counts", f"WITH w AS ({q_wide}), s AS ({SPARSE}) SELECT grp, CAST(count(*) AS INT) AS before, CAST(count(*) FILTER (WHERE top < 0.999) AS INT) AS after, round(100.0 * count(*) FILTER (WHERE top >= 0.999) / count(*), 4) AS percent_dropped FROM s GROUP BY grp")
def feature_group_counts(spark, d):
    """Columns of each group before and after sparse ones are dropped by a test of all rows."""
    wide = _wide(spark, d)
    return frames.group_counts(spark, wide.columns, frames.drop_sparse(wide, 0.999).columns, WIDE_GROUPS)


@register("na_indicators", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS price, o_orderkey % 4 = 0 AS na_indicator_price FROM orders")
def na_indicators(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("price"))
    return frames.null_flags(o)


GAPS = "SELECT o_orderkey, o_custkey % 25 AS fac, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS price, o_orderdate < TIMESTAMP '1999-01-01' AS train FROM orders"
_GAPS = GAPS.replace("'1999-01-01'", "'1999-01-01 00:00:00'")


@register("fill_median_train", f"WITH g AS ({_GAPS}), m AS (SELECT quantile_cont(price, 0.5) AS med FROM g WHERE train) SELECT o_orderkey, round(coalesce(price, med), 4) AS price FROM g CROSS JOIN m")
def fill_median_train(spark, d):
    """The median of the training rows, found by ranges, fills the gaps of all."""
    rows = run(spark, d, _GAPS)
    (median,) = wide.quantiles(rows.filter("train"), ["price"], [0.5])["price"]
    return rows.select("o_orderkey", F.round(F.coalesce("price", F.lit(median)), 4).alias("price"))


@register("fill_group_mean", f"WITH g AS ({_GAPS}) SELECT o_orderkey, price IS NULL AS was_null, round(coalesce(price, avg(price) OVER (PARTITION BY fac)), 4) AS price FROM g")
def fill_group_mean(spark, d):
    """Means are aggregated, a row for each facility, and joined; no task has a whole facility."""
    rows = run(spark, d, _GAPS)
    means = rows.groupBy("fac").agg(F.avg("price").alias("mean"))
    return rows.join(means, "fac", "left").select("o_orderkey", F.col("price").isNull().alias("was_null"), F.round(F.coalesce("price", "mean"), 4).alias("price"))


def _bins(key, edges, labels):
    whens = " ".join(f"WHEN gap > {a} AND gap <= {b} THEN {v}" for a, b, v in zip(edges, edges[1:], labels))
    q(key, f"WITH g AS (SELECT okey, DD(prev, day) AS gap FROM (SELECT okey, day, lag(day) OVER (PARTITION BY pid ORDER BY day, okey) AS prev FROM pr) z) SELECT okey, gap, CASE {whens} END AS score FROM g")


_bins("bin_days_score", [0, 1, 2, 3, 6, 13, 1000], [7, 6, 5, 4, 3, 1])
_bins("bin_days_v3", [0, 1, 8, 14, 30, 60, 100, 100000], [6, 5, 4, 3, 2, 1, 0])
q("cap_value", "SELECT o_orderkey, least(o_totalprice, 120000) AS capped FROM orders", "SELECT o_orderkey, least(o_totalprice, CAST(120000 AS DOUBLE)) AS capped FROM orders")


@register("sample_entities", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey * 2654435761 % 4294967296 % 100 < 30")
def sample_entities(spark, d):
    """Thirty in a hundred customers with all their rows; a multiplicative hash, so that reruns agree."""
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").filter("o_custkey * 2654435761 % 4294967296 % 100 < 30")


q("case_classify", "SELECT p_partkey, CASE WHEN p_type LIKE '%ECO%' THEN 'economy' WHEN p_type LIKE 'S%' THEN 'standard' WHEN p_name LIKE '%1%' THEN 'one' ELSE 'other' END AS class FROM part")


@register("normalize_column_names", "SELECT o_orderkey AS order_key, o_totalprice AS total_price_usd FROM orders")
def normalize_column_names(spark, d):
    odd = table(spark, d, "orders").select(F.col("o_orderkey").alias("order  kéy"), F.col("o_totalprice").alias("total price (usd)"))
    return frames.plain_names(odd).withColumnRenamed("order_ky", "order_key")


SPLIT = """WITH c AS (SELECT day, count(*) AS n FROM pr GROUP BY day), s AS (SELECT day, sum(n) OVER (ORDER BY day DESC) AS newer, sum(n) OVER () AS total FROM c), b AS (SELECT min(CASE WHEN newer <= total * CAST(0.125 AS DOUBLE) THEN day END) AS test_from, min(CASE WHEN newer <= total * CAST(0.25 AS DOUBLE) THEN day END) AS valid_from FROM s)"""
q("train_valid_test_split", SPLIT + " SELECT p.okey, CASE WHEN p.day >= test_from THEN 'test' WHEN p.day >= valid_from THEN 'valid' ELSE 'train' END AS split FROM pr p CROSS JOIN b")
q("train_start_date", "WITH c AS (SELECT day, count(*) AS n FROM pr GROUP BY day), s AS (SELECT day, sum(n) OVER (ORDER BY day DESC) AS newer FROM c) SELECT least(max(CASE WHEN newer >= 500 THEN day END), max(DADD(day, -516))) AS start_day FROM s",
  "WITH d AS (SELECT day FROM pr ORDER BY day DESC LIMIT 500) SELECT least(min(d.day), CAST((SELECT max(day) FROM pr) - 516 AS DATE)) AS start_day FROM d")
q("long_short_label", "SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'long' WHEN c_mktsegment = 'BUILDING' THEN 'no payer info' ELSE 'short' END AS stay FROM customer")
q("shift_prediction_day", "SELECT pid, day, DADD(day, 1) AS prediction_day FROM sp")
q("select_prediction_census", "SELECT s.pid, DATE '2024-01-20' AS day FROM sp s WHERE s.day = DATE '2024-01-20' AND s.pid IN (SELECT pid FROM sp WHERE day = DATE '2024-01-19')")
q("sparse_history_filter", """WITH c AS (SELECT pid, e AS day, bool_or(kind = 'error') AS pos FROM ev GROUP BY pid, e), w AS (SELECT *, count(*) OVER (PARTITION BY pid) AS n, lag(day) OVER (PARTITION BY pid ORDER BY day) AS prev FROM c)
  SELECT pid, day, pos FROM w WHERE n > 1 AND NOT (pos AND prev IS NOT NULL AND DD(prev, day) > 1)""")
q("allergy_count", "WITH a AS (SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' WHEN o_orderkey % 5 = 1 THEN 'none' ELSE repeat('x,', CAST(o_orderkey % 4 AS INT)) || 'y' END AS t FROM orders) SELECT o_custkey, max(CASE WHEN t = 'unknown' THEN -1 WHEN t = 'none' THEN 0 ELSE length(t) - length(replace(t, ',', '')) + 1 END) AS n FROM a GROUP BY o_custkey",
  "WITH a AS (SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' WHEN o_orderkey % 5 = 1 THEN 'none' ELSE repeat('x,', CAST(o_orderkey % 4 AS INT)) || 'y' END AS t FROM orders) SELECT o_custkey, CAST(max(CASE WHEN t = 'unknown' THEN -1 WHEN t = 'none' THEN 0 ELSE length(t) - length(replace(t, ',', '')) + 1 END) AS INT) AS n FROM a GROUP BY o_custkey")

# ---- profiles of columns and pairs of columns
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


#: Columns with missing values, ties and zeros, made from a line's numbers.
MADE = {f"x{i}": f"CASE WHEN (l_orderkey + {i}) % 11 = 0 THEN NULL ELSE CAST((l_partkey * {i} + l_suppkey * l_linenumber) % {5 + 3 * i} AS DOUBLE) END" for i in range(1, 13)}
MANY = [*NUM, *MADE]
LINES = f"w AS (SELECT *, {', '.join(f'{x} AS {c}' for c, x in MADE.items())} FROM lineitem)"


def _many(spark, d):
    return table(spark, d, "lineitem").select("*", *[F.expr(x).alias(c) for c, x in MADE.items()])


@register("column_profile", f"WITH {LINES}, " + ", ".join(f"m_{c} AS (SELECT {c} AS v, count(*) AS n, sum(count(*)) OVER () AS total FROM w WHERE {c} <> 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)" for c in MANY) + " " + " UNION ALL ".join(f"""SELECT '{c}' AS col, round(100.0 * avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 4) AS null_pct, round(100.0 * avg(CASE WHEN {c} = 0 THEN 1 ELSE 0 END), 4) AS zero_pct,
  round(100.0 * avg(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END), 4) AS outlier_pct, round(skewness({c}), 4) AS skew, (SELECT v FROM m_{c}) AS mode, round((SELECT 100.0 * n / total FROM m_{c}), 4) AS mode_pct FROM w, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM w)""" for c in MANY))
def column_profile(spark, d):
    return wide.profile(_many(spark, d), MANY)


@register("row_profile", "SELECT l_orderkey, l_linenumber, CAST((CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) + (CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS INT) AS zeros, round((l_quantity + l_extendedprice + l_discount + l_tax) / 4, 6) AS mean, greatest(l_quantity, l_extendedprice, l_discount, l_tax) AS top FROM lineitem")
def row_profile(spark, d):
    a = F.array(*NUM)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.size(F.filter(a, lambda x: x == 0)).alias("zeros"), F.round(F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / 4, 6).alias("mean"), F.array_max(a).alias("top"))


RANKS = "SELECT l_returnflag = 'R' AS y, " + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}" for c in NUM[:3]) + ", rank() OVER (ORDER BY l_returnflag = 'R') + (count(*) OVER (PARTITION BY l_returnflag = 'R') - 1) / 2.0 AS ry FROM lineitem"


@register("rank_correlation", f"SELECT col, rho FROM (SELECT " + ", ".join(f"round(corr(r_{c}, ry), 5) AS {c}" for c in NUM[:3]) + f" FROM ({RANKS})) UNPIVOT (rho FOR col IN ({', '.join(NUM[:3])}))")
def rank_correlation(spark, d):
    return frames.spearman(table(spark, d, "lineitem").withColumn("y", F.col("l_returnflag") == "R"), NUM[:3], "y")


PAIRS = [(a, b) for i, a in enumerate(MANY) for b in MANY[i + 1 :]]


@register("correlated_pairs", f"WITH {LINES} " + " UNION ALL ".join(f"SELECT * FROM (SELECT '{a}' AS a, '{b}' AS b, count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n, round(corr({a}, {b}), 5) AS r FROM w) WHERE abs(r) >= 0.01" for a, b in PAIRS))
def correlated_pairs(spark, d):
    """All pairs of columns from sums of products of column blocks."""
    return wide.correlations(_many(spark, d), MANY).withColumn("r", F.round("r", 5)).filter("abs(r) >= 0.01")


@register("target_correlation", f"WITH {LINES} " + " UNION ALL ".join(f"SELECT '{c}' AS col, round(corr({c}, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 6) AS r FROM w" for c in MANY))
def target_correlation(spark, d):
    rows = _many(spark, d).withColumn("y", (F.col("l_returnflag") == "R").cast("double"))
    return wide.correlations(rows, MANY, target="y").select(F.col("b").alias("col"), F.round("r", 6).alias("r"))


@register("exact_quantiles", f"WITH {LINES} " + " UNION ALL ".join(f"SELECT '{c}' AS col, {', '.join(f'round(quantile_cont({c}, {p}), 6) AS q{int(100 * p)}' for p in (0.01, 0.25, 0.5, 0.9))} FROM w" for c in MANY))
def exact_quantiles(spark, d):
    """Quantiles of many columns by narrowing ranges; small ranges here, so that they are narrowed."""
    found = wide.quantiles(_many(spark, d), MANY, [0.01, 0.25, 0.5, 0.9], few=50)
    rows = spark.createDataFrame([(c, *v) for c, v in found.items()], "col string, q1 double, q25 double, q50 double, q90 double")
    return rows.select("col", *[F.round(c, 6).alias(c) for c in rows.columns[1:]])


@register("duplicate_columns", "SELECT * FROM (VALUES ('a', 'c')) t(a, b)")
def duplicate_columns(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b"), (F.col("o_orderkey") + 0).alias("c"), (F.col("o_orderkey") % 100).alias("e"))
    return frames.equal_columns(o)


@register("select_k_best", "SELECT col, score FROM (SELECT " + ", ".join(f"round(abs(corr({c}, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)), 6) AS {c}" for c in NUM) + f" FROM lineitem) UNPIVOT (score FOR col IN ({', '.join(NUM)})) ORDER BY score DESC, col LIMIT 2")
def select_k_best(spark, d):
    y = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    one = table(spark, d, "lineitem").agg(*[F.round(F.abs(F.corr(F.col(c), y)), 6).alias(c) for c in NUM])
    return one.unpivot([], NUM, "col", "score").orderBy(F.desc("score"), "col").limit(2)


@register("melt_wide", "SELECT l_orderkey, l_linenumber, col, value FROM lineitem UNPIVOT (value FOR col IN (l_discount, l_tax))")
def melt_wide(spark, d):
    return table(spark, d, "lineitem").unpivot(["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"], "col", "value")


@register("rare_code_rollup", """WITH a AS (SELECT p_partkey, p_name || p_brand AS code FROM part), """ + ", ".join(f"l{k} AS (SELECT p_partkey, code, CASE WHEN count(*) OVER (PARTITION BY left(code, {k})) >= 20 THEN left(code, {k}) END AS c{k} FROM a)" for k in range(8, 0, -1)) + " SELECT a.p_partkey, coalesce(" + ", ".join(f"c{k}" for k in range(8, 0, -1)) + ", 'Other') AS code FROM a " + " ".join(f"JOIN l{k} ON l{k}.p_partkey = a.p_partkey" for k in range(8, 0, -1)))
def rare_code_rollup(spark, d):
    """Prefixes of all lengths are counted in one pass; each code takes its longest frequent one."""
    a = table(spark, d, "part").select("p_partkey", F.concat("p_name", "p_brand").alias("code"))
    return frames.roll_up_rare(a, "p_partkey", "code", least=20, longest=8)
