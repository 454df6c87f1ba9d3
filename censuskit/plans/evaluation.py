"""Evaluation, scoring, attribution and privacy (inventory 2.10)."""

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W, functions as F

from censuskit.operators import metrics as m, privacy
from censuskit.operators.attribution import event_reasons, parse_features
from censuskit.operators.models import boosted, by_date, cross_fitted, search
from censuskit.operators.scale import global_rank
from censuskit.plans import proxies as p
from censuskit.plans.registry import register
from censuskit.plans.sqlviews import duck_text, run, sql_query as q
from censuskit.sources.tables import table

#: Predictions ranked per client and day; the label says whether a transfer follows in 1 to 60 days.
BASE = """WITH lab AS (SELECT p.okey, min(t.day) AS incident FROM pr p JOIN tr t ON t.pid = p.pid AND t.day > p.day AND t.day <= DADD(p.day, 60) GROUP BY p.okey),
  b AS (SELECT p.okey, p.pid, p.fac, p.client, p.day, p.score, lab.incident, lab.okey IS NOT NULL AS label, p.status, CAST(row_number() OVER (PARTITION BY p.client, p.day ORDER BY p.score DESC, p.okey) AS INT) AS rnk, count(*) OVER (PARTITION BY p.client, p.day) AS n FROM pr p LEFT JOIN lab ON lab.okey = p.okey),
  f AS (SELECT *, rnk <= greatest(1, CAST(floor(n * CAST(0.5 AS DOUBLE)) AS INT)) AS shown FROM b)"""
INC = BASE + ", i AS (SELECT pid, incident, min(rnk) AS best, bool_or(shown) AS caught, max(day) AS last_day FROM f WHERE label GROUP BY pid, incident)"
q("performance_base", BASE + " SELECT okey, pid, client, day, rnk, label, shown FROM f")
q("convert_to_events", INC + " SELECT pid, incident, best, caught, last_day FROM i")
R = "round(avg(CASE WHEN {w} THEN CASE WHEN caught THEN CAST(1 AS DOUBLE) ELSE 0 END END), 6)"
q("incident_recall", INC + f""" SELECT {R.format(w='TRUE')} AS recall, {R.format(w='DD(last_day, incident) <= 30')} AS recall_short, {R.format(w='DD(last_day, incident) > 30')} AS recall_long, {R.format(w="stay = 'long'")} AS recall_long_stay, {R.format(w="stay = 'short'")} AS recall_short_stay, {R.format(w="stay = 'no payer info'")} AS recall_no_payer, count(*) AS incidents
  FROM (SELECT i.*, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'long' WHEN c_mktsegment = 'BUILDING' OR c_mktsegment IS NULL THEN 'no payer info' ELSE 'short' END AS stay FROM i LEFT JOIN customer ON c_custkey = i.pid) z""")
q("precision_at_cutoff", BASE + " SELECT client, round(avg(CASE WHEN shown THEN CASE WHEN label THEN CAST(1 AS DOUBLE) ELSE 0 END END), 6) AS precision_shown, count(*) AS n FROM f GROUP BY client")
GRID = "generate_series(1, 20)"
HITS = BASE + ", h AS (SELECT client, rnk, count(*) AS n, count(CASE WHEN label THEN 1 END) AS hits FROM f GROUP BY client, rnk), g AS (SELECT c.client, r.rnk FROM (SELECT DISTINCT client FROM pr) c CROSS JOIN (SELECT explode(sequence(1, 20)) AS rnk) r), w AS (SELECT g.client, g.rnk, coalesce(h.n, 0) AS n, coalesce(h.hits, 0) AS hits FROM g LEFT JOIN h ON h.client = g.client AND h.rnk = g.rnk), t AS (SELECT client, count(CASE WHEN label THEN 1 END) AS total FROM f GROUP BY client)"
DUCK = HITS.replace("explode(sequence(1, 20))", "unnest(range(1, 21))")
for key, tail in (
    ("cross_rank_grid", " SELECT client, CAST(rnk AS INT) AS rnk, n, hits FROM w"),
    ("recall_at_each_rank", " SELECT w.client, CAST(w.rnk AS INT) AS rnk, round(CAST(sum(w.hits) OVER (PARTITION BY w.client ORDER BY w.rnk) AS DOUBLE) / t.total, 6) AS recall FROM w JOIN t ON t.client = w.client"),
    ("precision_at_each_rank", " SELECT client, CAST(rnk AS INT) AS rnk, round(CAST(sum(hits) OVER (PARTITION BY client ORDER BY rnk) AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY client ORDER BY rnk) AS DOUBLE), 6) AS precision_upto FROM w"),
    ("pline_recall_precision", " SELECT client, recall, precision_upto FROM (SELECT w.client, w.rnk, round(CAST(sum(w.hits) OVER (PARTITION BY w.client ORDER BY w.rnk) AS DOUBLE) / t.total, 6) AS recall, round(CAST(sum(w.hits) OVER (PARTITION BY w.client ORDER BY w.rnk) AS DOUBLE) / CAST(sum(w.n) OVER (PARTITION BY w.client ORDER BY w.rnk) AS DOUBLE), 6) AS precision_upto FROM w JOIN t ON t.client = w.client) z WHERE rnk = 15"),
):
    q(key, HITS + tail, DUCK + tail)
q("lookback_incident_recall", BASE + ", x AS (SELECT t.okey, t.line, min(f.rnk) AS best FROM tr t JOIN f ON f.pid = t.pid AND f.day < t.day AND f.day >= DADD(t.day, -30) GROUP BY t.okey, t.line) SELECT count(*) AS n, round(avg(CASE WHEN best <= 2 THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS recall FROM x")
q("best_run_pick", BASE + ", r AS (SELECT client, round(avg(CASE WHEN shown THEN CASE WHEN label THEN CAST(1 AS DOUBLE) ELSE 0 END END), 6) AS metric FROM f GROUP BY client) SELECT client, metric FROM (SELECT *, row_number() OVER (ORDER BY metric DESC, client) AS i FROM r) z WHERE i = 1")
DAILY = BASE + ", k AS (SELECT fac, day, count(CASE WHEN label THEN 1 END) AS cases, count(CASE WHEN label AND rnk <= 2 THEN 1 END) AS hits, count(CASE WHEN rnk <= 2 THEN 1 END) AS flagged FROM f GROUP BY fac, day)"
q("recall_precision_at_k_daily", DAILY + " SELECT fac, round(avg(CASE WHEN cases > 0 THEN CAST(hits AS DOUBLE) / cases END), 6) AS recall, round(avg(CASE WHEN flagged > 0 THEN CAST(hits AS DOUBLE) / flagged END), 6) AS ppv FROM k GROUP BY fac")
q("stay_recall_at_k", BASE + " SELECT client, count(DISTINCT CASE WHEN label THEN pid END) AS stays, round(CAST(count(DISTINCT CASE WHEN label AND rnk <= 2 THEN pid END) AS DOUBLE) / count(DISTINCT CASE WHEN label THEN pid END), 6) AS recall FROM f GROUP BY client")
PCT = BASE + ", c AS (SELECT f.client, f.day, p.pct, CAST(floor(f.n * p.pct / CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS INT) AS cutoff, f.rnk, f.label FROM f CROSS JOIN ({grid}) p), d AS (SELECT client, pct, day, max(cutoff) AS cutoff, count(CASE WHEN label AND rnk <= cutoff THEN 1 END) AS hits FROM c GROUP BY client, pct, day) SELECT client, pct, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(cutoff) AS BIGINT) AS flagged, round(CAST(sum(hits) AS DOUBLE) / CAST(nullif(sum(cutoff), 0) AS DOUBLE), 6) AS precision_at FROM d GROUP BY client, pct"
q("percentwise_precision", PCT.format(grid="SELECT explode(array(25, 50, 75, 100)) AS pct"), PCT.format(grid="SELECT unnest([25, 50, 75, 100]) AS pct"))
q("monthly_recall_by_cutoff", BASE + ", x AS (SELECT t.pid, CAST(date_trunc('month', t.day) AS DATE) AS mon, f.rnk FROM tr t LEFT JOIN f ON f.pid = t.pid AND DD(f.day, t.day) BETWEEN 0 AND 30) SELECT mon, count(DISTINCT pid) AS patients, count(DISTINCT CASE WHEN rnk <= 1 THEN pid END) AS at_1, count(DISTINCT CASE WHEN rnk <= 3 THEN pid END) AS at_3 FROM x GROUP BY mon")
q("days_before_incident", BASE + " SELECT shown, DD(f.day, t.day) AS days, count(*) AS n FROM f JOIN tr t ON t.pid = f.pid AND DD(f.day, t.day) BETWEEN 0 AND 10 GROUP BY shown, DD(f.day, t.day)")
q("duplicate_score_check", "SELECT fac, day, score, count(*) AS n FROM (SELECT fac, day, round(score, -3) AS score FROM pr) z GROUP BY fac, day, score HAVING count(*) > 1")
q("logloss", "SELECT round(avg(-ln(CASE WHEN y THEN s ELSE 1 - s END)), 6) AS logloss FROM (SELECT l.quality = 1 AS y, greatest(CAST(1e-7 AS DOUBLE), least(1 - CAST(1e-7 AS DOUBLE), 1 / (1 + exp(-(CAST(d.n_chars AS DOUBLE) - 2000) / 1000)))) AS s FROM documents d JOIN labels l ON l.doc_id = d.doc_id) z")


def _labelled(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("doc_id", "source", F.col("n_chars").cast("double").alias("score"), (F.col("quality") == 1).alias("label"))


LAB = "l AS (SELECT CAST(n_chars AS DOUBLE) AS s, quality = 1 AS y, source FROM documents JOIN labels USING (doc_id)), n AS (SELECT count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg FROM l)"
STEPS = LAB + ", g AS (SELECT s, count(*) FILTER (WHERE y) AS p, count(*) FILTER (WHERE NOT y) AS n FROM l GROUP BY s), c AS (SELECT s, p, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM g WINDOW w AS (ORDER BY s DESC))"


@register("roc_auc", f"WITH {LAB}, r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM l) SELECT round((sum(r) FILTER (WHERE y) - max(pos) * (max(pos) + 1) / 2.0) / (max(pos) * max(neg)), 6) AS auc FROM r, n")
def roc_auc(spark, d):
    return m.roc_auc(_labelled(spark, d)).select(F.round("auc", 6).alias("auc"))


@register("per_facility_model_table", f"""WITH {LAB}, c AS (SELECT source, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg FROM l GROUP BY source), a AS (SELECT a.source, sum(CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0 END) AS u FROM l a JOIN l b ON a.source = b.source AND a.y AND NOT b.y GROUP BY a.source),
  d AS (SELECT doc_id, source, doc_id % 7 AS day, CAST(n_chars AS DOUBLE) AS s, quality = 1 AS y FROM documents JOIN labels USING (doc_id)), k AS (SELECT source, greatest(1, floor(0.15 * median(n))) AS cutoff FROM (SELECT source, day, count(*) AS n FROM d GROUP BY 1, 2) GROUP BY source),
  t AS (SELECT source, y, row_number() OVER (PARTITION BY source, day ORDER BY s DESC, doc_id) AS i FROM d), r AS (SELECT source, sum(CASE WHEN y AND i <= cutoff THEN 1.0 ELSE 0 END) / nullif(sum(CASE WHEN y THEN 1 ELSE 0 END), 0) AS recall FROM t JOIN k USING (source) GROUP BY source)
  SELECT c.source, 'length' AS model, round(a.u / (pos * neg), 6) AS auc, round(r.recall, 6) AS recall FROM c LEFT JOIN a USING (source) LEFT JOIN r USING (source)""")
def per_facility_model_table(spark, d):
    """AUC, and recall of the first 15 % of the median daily census, per facility and model."""
    labelled = _labelled(spark, d)
    auc = m.by_score(labelled, groups=["source"]).groupBy("source").agg((F.sum(F.col("n") * (F.col("tp") - F.col("p") / 2.0)) / F.nullif(F.first("pos") * F.first("neg"), F.lit(0))).alias("auc"))
    days = labelled.withColumn("day", F.col("doc_id") % 7)
    median = days.groupBy("source", "day").agg(F.count(F.lit(1)).alias("n")).groupBy("source").agg(F.percentile("n", 0.5).alias("m"))
    cutoffs = median.select("source", F.greatest(F.lit(1), F.floor(0.15 * F.col("m"))).alias("cutoff"))
    ranked = days.withColumn("i", F.row_number().over(W.partitionBy("source", "day").orderBy(F.desc("score"), "doc_id"))).join(cutoffs, "source")
    recall = ranked.groupBy("source").agg((F.count_if(F.col("label") & (F.col("i") <= F.col("cutoff"))) / F.nullif(F.count_if("label"), F.lit(0))).alias("recall"))
    return auc.join(recall, "source", "left").select("source", F.lit("length").alias("model"), F.round("auc", 6).alias("auc"), F.round("recall", 6).alias("recall"))


@register("average_precision", f"WITH {STEPS} SELECT round(sum(p * tp / (CAST(pos AS DOUBLE) * (tp + fp))), 6) AS ap FROM c, n")
def average_precision(spark, d):
    return m.average_precision(_labelled(spark, d)).select(F.round("ap", 6).alias("ap"))


@register("roc_points", f"WITH {STEPS} SELECT s AS threshold, round(CAST(fp AS DOUBLE) / neg, 6) AS fpr, round(CAST(tp AS DOUBLE) / pos, 6) AS tpr FROM c, n")
def roc_points(spark, d):
    return m.roc_points(_labelled(spark, d)).select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@register("partial_auc_fpr25", f"""WITH {STEPS}, x AS (SELECT CAST(fp AS DOUBLE) / neg AS x, CAST(tp AS DOUBLE) / pos AS y, s FROM c, n), l0 AS (SELECT *, coalesce(lag(x) OVER (ORDER BY s DESC), 0) AS x0, coalesce(lag(y) OVER (ORDER BY s DESC), 0) AS y0 FROM x), k AS (SELECT *, least(x, 0.25) AS x1 FROM l0 WHERE x0 < 0.25),
  a AS (SELECT sum((x1 - x0) * (y0 + CASE WHEN x > x0 THEN y0 + (y - y0) * (x1 - x0) / (x - x0) ELSE y END) / 2) AS area FROM k) SELECT round(0.5 * (1 + (area - 0.03125) / (0.25 - 0.03125)), 6) AS partial_auc FROM a""")
def partial_auc_fpr25(spark, d):
    return m.partial_auc(_labelled(spark, d), 0.25).select(F.round("partial_auc", 6).alias("partial_auc"))


def _boot(spark, d):
    """Patients are resampled with all their predictions; the second model shows only rank 1."""
    y, s, b = F.col("label").cast("int"), F.col("shown").cast("int"), (F.col("rnk") <= 1).cast("int")
    return m.bootstrap(run(spark, d, BASE + " SELECT pid, rnk, label, shown FROM f"), "pid", {"recall": (y * s, y), "precision": (y * s, s), "recall_b": (y * b, y), "gain": (y * (s - b), y)})


@register("bootstrap_ci")
def bootstrap_ci(spark, d):
    return _boot(spark, d).filter("metric IN ('recall', 'precision')")


@register("paired_bootstrap")
def paired_bootstrap(spark, d):
    """The difference of two models' recall on the same resamples."""
    return _boot(spark, d).filter("metric IN ('recall', 'recall_b', 'gain')")


# ---- models
def _vectors(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", (F.col("l_returnflag") == "R").cast("double").alias("label"))
    return VectorAssembler(inputCols=["l_quantity", "l_extendedprice", "l_discount", "l_tax"], outputCol="features").transform(li)


@register("train_classifier")
def train_classifier(spark, d):
    """Boosted trees that stop by the error on the last quarter of the dates; each order is scored
    by the model that has not seen it."""
    rows = by_date(_vectors(spark, d), "l_shipdate", [0.75]).withColumn("late", F.col("part") == 1)
    scored = cross_fitted(rows, "l_orderkey", boosted())
    return scored.select("l_orderkey", "l_linenumber", vector_to_array("probability")[1].alias("score"))


@register("batch_score")
def batch_score(spark, d):
    """All lines, each scored by a model fitted on other orders."""
    return cross_fitted(_vectors(spark, d), "l_orderkey", LogisticRegression(maxIter=5)).select("l_orderkey", "l_linenumber", vector_to_array("probability")[1].alias("score"))


@register("platt_fit")
def platt_fit(spark, d):
    rows = VectorAssembler(inputCols=["score"], outputCol="features").transform(_labelled(spark, d).withColumn("label", F.col("label").cast("double")))
    model = LogisticRegression(regParam=0.0, maxIter=25).fit(rows)
    return spark.range(1).select(F.lit(float(model.coefficients[0])).alias("a"), F.lit(float(model.intercept)).alias("b"))


@register("hyperparameter_search")
def hyperparameter_search(spark, d):
    """Boosting parameters drawn at random; the best trial is the one that ranks the latest dates best."""
    tried, _ = search(_vectors(spark, d), "l_shipdate", trials=6)
    top = max(t["auc"] for t in tried)
    return spark.createDataFrame([(*t.values(), t["auc"] == top) for t in tried], "depth int, step double, subsample double, rounds int, auc double, best boolean")


# ---- attribution: lines of an order are the features' contributions
WIDE = "(SELECT l_orderkey AS okey, l_linenumber AS line, l_quantity AS attr_count_falls_7_day, l_tax * 1000 AS attr_days_since_fever, l_discount * 500 AS attr_vtl_pulse_max FROM lineitem) w"


@register("attribution_longform", f"SELECT okey, line, feature, round(value, 4) AS value, 'NOT_MAPPED' AS status FROM (SELECT * FROM {WIDE}) UNPIVOT (value FOR feature IN (attr_count_falls_7_day, attr_days_since_fever, attr_vtl_pulse_max))")
def attribution_longform(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("attr_count_falls_7_day"), (F.col("l_tax") * 1000).alias("attr_days_since_fever"), (F.col("l_discount") * 500).alias("attr_vtl_pulse_max"))
    return li.unpivot(["okey", "line"], li.columns[2:], "feature", "value").select("okey", "line", "feature", F.round("value", 4).alias("value"), F.lit("NOT_MAPPED").alias("status"))


q("attribution_relevance", "SELECT l_orderkey, l_linenumber, CASE WHEN v IS NULL OR v = 9999 OR (v = 0 AND NOT feature LIKE 'days_since%') THEN 'NOT_RELEVANT' ELSE 'NOT_MAPPED' END AS status FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 = 1 THEN 9999 WHEN l_partkey % 5 IN (2, 3) THEN 0 ELSE 3 END AS v, CASE WHEN l_partkey % 3 = 0 THEN 'days_since_x' ELSE 'count_x' END AS feature FROM lineitem) z")
q("attribution_group_max", "SELECT l_orderkey, l_linenumber, max(l_extendedprice) OVER (PARTITION BY l_orderkey, l_suppkey % 3) AS top, l_extendedprice = max(l_extendedprice) OVER (PARTITION BY l_orderkey, l_suppkey % 3) AS is_top FROM lineitem")


FEATURES = ["cumsum_error_7_day", "cumsum_error_14_day", "days_since_last_purchase", "cumsum_purchase_2_day", "view_count_30_day", "view_count_90_day", "cumsum_click_1_day", "signup_indicator_3_day", "census_bed", "age"]
PATTERNS = {"error": "error", "purchase": "purchase", "^view_count": "view", "click": "click", "signup": "signup"}
VITALS = ["vtl_view_max_9_day", "vtl_view_min_2_day", "vtl_click_max_14_day"]
USUAL = {"view": (20.0, 300.0), "error": (0.0, 100.0), "click": (0.0, 100.0), "purchase": (10.0, 100.0)}
RULES = parse_features(FEATURES, PATTERNS, USUAL)
VITAL_RULES = parse_features(VITALS, {"view": "view", "click": "click"}, USUAL)


def _reasons_sql(rules) -> str:
    cell = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    values = ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rules)
    return f"""WITH {p.EV}, {p.SP}, r AS (SELECT feature, CAST(kind AS VARCHAR) AS kind, win, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high FROM (VALUES {values}) t(feature, kind, win, low, high)),
      j AS (SELECT sp.pid, sp.day, r.*, v.e, v.event_id, v.value, row_number() OVER (PARTITION BY sp.pid, sp.day, r.feature ORDER BY v.e DESC NULLS LAST, v.ts DESC, v.event_id DESC) AS i FROM sp CROSS JOIN r LEFT JOIN ev v ON v.pid = sp.pid AND v.kind = r.kind AND v.e <= sp.day AND v.e > sp.day - r.win)
      SELECT pid, day, feature, kind, event_id, CAST(day - e AS INT) AS days, CASE WHEN kind IS NULL THEN 'NOT_MAPPED' WHEN event_id IS NULL THEN 'DATA_NOT_FOUND' WHEN value < low OR value > high THEN 'MAPPED' ELSE 'DATA_FOUND' END AS status FROM j WHERE i = 1"""


def _told(spark, d):
    return p.events(spark, d).select("pid", F.col("e").alias("day"), "kind", "ts", "event_id", "value")


@register("attribution_event_asof", _reasons_sql(RULES))
def attribution_event_asof(spark, d):
    """Features of five kinds of events with windows of a day to all time, read from their names."""
    return event_reasons(p.spine(spark, d), _told(spark, d), RULES)


@register("attribution_vitals_map", _reasons_sql(VITAL_RULES))
def attribution_vitals_map(spark, d):
    """Vitals: the last value in the feature's window, mapped if it is outside the usual bounds."""
    return event_reasons(p.spine(spark, d), _told(spark, d), VITAL_RULES)


q("attribution_transfer_map", """WITH u AS (SELECT pid, day, CAST(NULL AS DATE) AS moved, 1 AS asked FROM sp UNION ALL SELECT pid, e, e, 0 FROM ev WHERE kind = 'error'), w AS (SELECT pid, day, asked, max(moved) OVER (PARTITION BY pid ORDER BY day) AS last_day FROM u)
  SELECT pid, day, CASE WHEN last_day IS NULL THEN 'no transfer known' ELSE 'Transferred ' || CAST(DD(last_day, day) AS VARCHAR(10)) || ' days ago' END AS reason FROM w WHERE asked = 1""")

# ---- privacy
DEID = "SELECT s_suppkey, 'Facility #' || CAST(row_number() OVER (ORDER BY s_suppkey) AS VARCHAR(12)) AS name, CASE s_suppkey % 4 WHEN 0 THEN 'North' WHEN 1 THEN 'East' WHEN 2 THEN 'South' ELSE 'West' END AS unit FROM supplier"


@register("deid_sequence_mask", DEID)
def deid_sequence_mask(spark, d):
    ranked = global_rank(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey", "s_suppkey", "i", descending=False)
    unit = F.element_at(F.array(*map(F.lit, ("North", "East", "South", "West"))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return ranked.select("s_suppkey", F.concat(F.lit("Facility #"), F.col("i").cast("string")).alias("name"), unit.alias("unit"))


#: The tables of a customer: orders by key, their lines by the order, events by another name.
ALIASES = {"user_id": "custkey"}
SHOWN = {
    "customer": ("c_custkey", "c_nationkey", None), "orders": ("o_orderkey", "o_custkey", "o_orderdate"),
    "lineitem": ("l_orderkey", "l_partkey", "l_shipdate"), "events": ("event_id", "user_id", "ts"),
}


def _tables(spark, d):
    return {t: table(spark, d, t) for t in SHOWN}


def _shown(tables):
    """One frame of all tables: name, two keys and a date."""
    rows = [tables[t].select(F.lit(t).alias("name"), F.col(a).cast("long").alias("k1"), F.col(b).cast("long").alias("k2"), (F.col(day) if day else F.lit(None)).cast("timestamp_ntz").alias("moment")) for t, (a, b, day) in SHOWN.items()]
    return reduce(lambda x, y: x.unionByName(y), rows)


@register("deid_date_shift", """SELECT 'customer' AS name, c_custkey AS k1, c_nationkey AS k2, CAST(NULL AS TIMESTAMP) AS moment FROM customer UNION ALL SELECT 'orders', o_orderkey, o_custkey, CAST(o_orderdate AS TIMESTAMP) - to_days(CAST(o_custkey % 90 AS INT)) FROM orders
  UNION ALL SELECT 'lineitem', l_orderkey, l_partkey, CAST(l_shipdate AS TIMESTAMP) - to_days(CAST(coalesce(o_custkey, 0) % 90 AS INT)) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey UNION ALL SELECT 'events', event_id, user_id, CAST(ts AS TIMESTAMP) - to_days(CAST(user_id % 90 AS INT)) FROM events""")
def deid_date_shift(spark, d):
    """Every date column of the tables of a customer is moved by the customer's number of days."""
    return _shown(privacy.shift_dates(_tables(spark, d), "custkey", lambda pid: -(pid % 90), ALIASES))


COPY = 1_000_000_000


@register("duplicate_entity", f"""WITH c AS (SELECT * FROM (VALUES (1), (2), (4)) t(pid)), a AS (SELECT 'customer' AS name, c_custkey AS k1, c_nationkey AS k2, CAST(NULL AS TIMESTAMP) AS moment, c_custkey AS pid, {COPY} AS o1, 0 AS o2 FROM customer
  UNION ALL SELECT 'orders', o_orderkey, o_custkey, CAST(o_orderdate AS TIMESTAMP), o_custkey, {COPY}, {COPY} FROM orders UNION ALL SELECT 'lineitem', l_orderkey, l_partkey, CAST(l_shipdate AS TIMESTAMP), o_custkey, {COPY}, 0 FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'events', event_id, user_id, CAST(ts AS TIMESTAMP), user_id, {COPY}, {COPY} FROM events)
  SELECT name, CAST(k1 AS BIGINT) AS k1, CAST(k2 AS BIGINT) AS k2, moment FROM a UNION ALL SELECT name, CAST(k1 + o1 AS BIGINT), CAST(k2 + o2 AS BIGINT), moment FROM a WHERE pid IN (SELECT pid FROM c)""")
def duplicate_entity(spark, d):
    """The rows of three customers in four tables once more, under new ids that match each other."""
    return _shown(privacy.duplicate_entities(_tables(spark, d), "custkey", lambda pid: pid.isin(1, 2, 4), COPY, ALIASES))


@register("deid_shuffle_names", "WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey * 2654435761 % 4294967296, c_custkey) AS i FROM customer), b AS (SELECT c_name, row_number() OVER (ORDER BY c_custkey * 40503 % 65536, c_custkey) AS i FROM customer) SELECT c_custkey, c_name FROM a JOIN b USING (i)")
def deid_shuffle_names(spark, d):
    """Two pseudo-random orders of the same dimension, joined by place."""
    c = table(spark, d, "customer")
    a = global_rank(c.select("c_custkey", F.expr("c_custkey * 2654435761 % 4294967296").alias("h")), "h", "c_custkey", "i", descending=False)
    b = global_rank(c.select("c_name", "c_custkey", F.expr("c_custkey * 40503 % 65536").alias("h")), "h", "c_custkey", "i", descending=False).select("c_name", "i")
    return a.join(b, "i").select("c_custkey", "c_name")
