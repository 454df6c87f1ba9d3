"""Databases, entities across tables, running vectors and reasons, against plain loops."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from censuskit.operators import attribution, privacy, vectors
from censuskit.sources import database

ZERO = datetime.date(2024, 1, 1)


def day(i):
    return ZERO + datetime.timedelta(days=i)


def test_database_reads_in_parts_with_pushed_filters(spark):
    connection = database.database_url(spark)
    rows = [(i, f"c{i % 3}", float(i), day(i % 50)) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, c string, x double, d date")
    database.write_table(df, "pushed", connection, types="c VARCHAR(9)")
    read = database.read_table(spark, "pushed", connection, key="k", parts=4)
    assert read.rdd.getNumPartitions() == 4
    found = read.filter("c = 'c1' AND x > 500").select("k")
    assert sorted(r[0] for r in found.collect()) == [i for i in range(501, 1000) if i % 3 == 1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(C,c1)" in plan.replace("c,c1", "C,c1") and "GreaterThan" in plan and "PushedFilters" in plan
    # parts together are the table, by a date as well, and an empty table is read too
    assert database.read_table(spark, "pushed", connection, key="d", parts=7).count() == 1000
    database.write_table(df.limit(0), "empty", connection)
    assert database.read_table(spark, "empty", connection, key="k").count() == 0


def tables(spark):
    return {
        "customer": spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "c_custkey long, c_nationkey int"),
        "orders": spark.createDataFrame([(10, 1, day(0)), (11, 1, day(9)), (12, 2, day(5)), (13, None, day(5))], "o_orderkey long, o_custkey long, o_orderdate date"),
        "lineitem": spark.createDataFrame([(10, 5, day(1), datetime.datetime(2024, 1, 2, 3)), (10, 6, day(2), None), (12, 5, None, None), (99, 5, day(3), None)], "l_orderkey long, l_partkey long, l_shipdate date, l_ts timestamp"),
        "events": spark.createDataFrame([(100, 1, "x"), (101, 3, "y")], "event_id long, user_id long, kind string"),
        "part": spark.createDataFrame([(5, "bolt"), (6, "nut")], "p_partkey long, p_name string"),
    }


def test_key_graph(spark):
    graph = {m.table: m for m in privacy.key_graph(tables(spark), "custkey", {"user_id": "custkey"})}
    assert set(graph) == {"customer", "orders", "events", "lineitem"}
    assert graph["lineitem"].through == "orders" and graph["lineitem"].column == "l_orderkey" and set(graph["lineitem"].keys) == {"l_orderkey"}
    assert set(graph["orders"].keys) == {"o_orderkey", "o_custkey"} and graph["lineitem"].dates == ("l_shipdate", "l_ts")


def test_duplicate_entities(spark):
    out = privacy.duplicate_entities(tables(spark), "custkey", lambda pid: pid.isin(1), 1000, {"user_id": "custkey"})
    rows = {t: sorted((tuple(r) for r in df.collect()), key=str) for t, df in out.items()}
    assert len(rows["customer"]) == 4 and (1001, 7) in rows["customer"]
    assert {r[:2] for r in rows["orders"]} == {(10, 1), (11, 1), (12, 2), (13, None), (1010, 1001), (1011, 1001)}
    assert [r[:2] for r in rows["lineitem"] if r[0] > 1000] == [(1010, 5), (1010, 6)]
    assert (1100, 1001, "x") in rows["events"] and len(rows["events"]) == 3 and len(rows["part"]) == 2
    # each copied line finds a copied order, and each copied order a copied customer
    joined = out["lineitem"].join(out["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(out["customer"], F.col("o_custkey") == F.col("c_custkey"))
    assert joined.filter("l_orderkey > 1000").count() == 2


def test_shift_dates(spark):
    out = privacy.shift_dates(tables(spark), "custkey", lambda pid: -pid, {"user_id": "custkey"})
    assert {(r.o_orderkey, r.o_orderdate) for r in out["orders"].collect()} == {(10, day(-1)), (11, day(8)), (12, day(3)), (13, day(5))}
    lines = {(r.l_orderkey, r.l_partkey): r for r in out["lineitem"].collect()}
    assert lines[10, 5].l_shipdate == day(0) and lines[10, 5].l_ts.day == 1 and lines[10, 6].l_ts is None and lines[12, 5].l_shipdate is None and lines[99, 5].l_shipdate == day(3)


@pytest.mark.parametrize("halflife", [1.0, 7.0])
def test_carried_vectors(spark, halflife):
    rng = random.Random(3)
    notes = [(rng.choice([1, 1, 2, 4]), day(rng.randrange(60)), [rng.uniform(-1, 1) for _ in range(5)]) for _ in range(120)] + [(1, day(3), None), (1, day(4), [0.0] * 5), (None, day(4), [1.0] * 5)]
    days = [(p, day(i)) for p in (1, 2, 3) for i in range(-2, 65)]
    got = vectors.carried_vectors(spark.createDataFrame(days, "pid long, day date"), spark.createDataFrame(notes, "pid long, day date, v array<double>"), 5, halflife).collect()
    assert len(got) == len(days)
    for r in got:
        mine = {}
        for p, d, v in notes:
            if p == r.pid and d <= r.day and v is not None:
                v = np.array(v)
                mine[d] = mine.get(d, 0) + (v / np.linalg.norm(v) if v.any() else v)
        if not mine:
            assert r.since is None and r.total is None and r.ewm is None
            continue
        order = sorted(mine)
        w = 0.5 ** (np.arange(len(order))[::-1] / halflife)
        assert r.since == (r.day - order[-1]).days
        assert np.allclose(r.total, mine[order[-1]]) and np.allclose(r.ewm, sum(x * mine[d] for x, d in zip(w, order)) / w.sum())


def test_event_reasons(spark):
    rng = random.Random(5)
    rules = attribution.parse_features(["falls_7_day", "falls_1_day", "days_since_fall", "pulse_max_30_day", "pulse_400_day", "bed"], {"fall": "fall", "pulse": "pulse"}, {"pulse": (50.0, 100.0)})
    assert [r[1:3] for r in rules] == [("fall", 7), ("fall", 1), ("fall", attribution.EVER), ("pulse", 30), ("pulse", attribution.EVER), (None, attribution.EVER)]
    events = [(rng.choice([1, 2]), day(rng.randrange(200)), rng.choice(["fall", "pulse", "other"]), k, k, rng.choice([40.0, 70.0, 120.0, None])) for k in range(60)]
    days = [(p, day(i)) for p in (1, 2, 3) for i in range(0, 210, 3)]
    got = attribution.event_reasons(spark.createDataFrame(days, "pid long, day date"), spark.createDataFrame(events, "pid long, day date, kind string, ts long, event_id long, value double"), rules).collect()
    assert len(got) == len(days) * len(rules)
    by = {f: (kind, window, low, high) for f, kind, window, low, high in rules}
    for r in got:
        kind, window, low, high = by[r.feature]
        seen = [(d, ts, e, v) for p, d, k, ts, e, v in events if p == r.pid and k == kind and 0 <= (r.day - d).days < window]
        top = max(seen, key=lambda s: s[:3]) if seen else None
        status = "NOT_MAPPED" if kind is None else "DATA_NOT_FOUND" if top is None else "MAPPED" if low is not None and top[3] is not None and not low <= top[3] <= high else "DATA_FOUND"
        assert (r.status, r.event_id, r.days) == (status, top and top[2], top and (r.day - top[0]).days)
