"""Feature groups on small tables, against their DuckDB text."""

import datetime
import random

import duckdb
from pyspark.sql import functions as F

from censuskit.functions.codes import unit_vector
from censuskit.plans import registry


def tables(spark, path, events, vectors):
    """Events (event_id, user_id, event_type, day, value) and vectors of embeddings as a folder."""
    at = datetime.datetime(2024, 1, 1, 12)
    rows = [(i, u, kind, at + datetime.timedelta(days=day), value) for i, u, kind, day, value in events]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp, value double").coalesce(1).write.parquet(f"{path}/events.parquet")
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in ("events", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet/*.parquet')")
    return con


def test_notes_round_to_one_zero(spark, tmp_path):
    con = tables(spark, tmp_path, [(0, 1, "view", 0, 1.0), (1, 1, "view", 2, 2.0)], [(0, [-1e-7] + [1.0] * 7), (1, [1.0] * 8)])
    got = registry.queries()["fg_notes"](spark, str(tmp_path)).orderBy("pid", "day").select("total", "ewm").collect()
    told = con.execute(f"SELECT total, ewm FROM ({registry.oracle_sql()['fg_notes']}) ORDER BY pid, day").fetchall()
    assert [(str(r.total), str(r.ewm)) for r in got] == [(str(a), str(b)) for a, b in told]
    assert str(got[0].total[0]) == "0.0"


def test_mds_sees_every_assessment(spark, tmp_path):
    rng = random.Random(7)
    events = [(i, i % 2, rng.choice(["signup", "signup", "error"]) if i > 12 else "signup", i // 4, float(rng.randrange(300))) for i in range(60)]
    con = tables(spark, tmp_path, events, [(0, [1.0] * 8)])
    got = registry.queries()["fg_mds"](spark, str(tmp_path)).orderBy("pid", "day")
    told = con.execute(f"SELECT pid, day, last_1, last_2, change, code FROM ({registry.oracle_sql()['fg_mds']}) ORDER BY pid, day").fetchall()
    assert [tuple(r) for r in got.select("pid", "day", "last_1", "last_2", "change", "code").collect()] == told
    # all three events of patient 0 that are known on the third day, the newest of them first
    known = sorted(((day, day + i % 4, i), value) for i, u, kind, day, value in events if u == 0 and kind == "signup" and max(day, day + i % 4) <= 2)
    assert got.filter(F.col("pid") == 0).collect()[2].last_1 == known[-1][1]
    third = [i for (_, _, i), _ in known[-2:] if i % 3 == 2]
    assert third, "an event with a number that leaves 2 on division by 3 is among the last two"


def test_notes_take_every_vector_in_all_dimensions(spark, tmp_path):
    vectors = [(i, [float(i % 7 + 1), *[float((i + j) % 5) for j in range(11)]]) for i in range(700)]
    con = tables(spark, tmp_path, [(620 + i, i % 2, "view", i // 4, 1.0) for i in range(100)], vectors)
    got = registry.queries()["fg_notes"](spark, str(tmp_path)).orderBy("pid", "day").select("pid", "day", "total", "ewm").collect()
    told = con.execute(f"SELECT pid, day, total, ewm FROM ({registry.oracle_sql()['fg_notes']}) ORDER BY pid, day").fetchall()
    assert [tuple(r) for r in got] == told and len(got) == 50
    unit = {i: [x / sum(y * y for y in v) ** 0.5 for x in v] for i, v in vectors}
    # the first day of patient 0: notes 620 and 622
    assert got[0].total == [round(a + b, 5) for a, b in zip(unit[620], unit[622], strict=True)] and len(got[0].ewm) == 12
    # the last day of patient 1: notes 717 and 719 begin again at vector 0
    assert got[49].total == [round(a + b, 5) for a, b in zip(unit[17], unit[19], strict=True)]


def test_notes_without_vectors(spark, tmp_path):
    tables(spark, tmp_path, [(0, 1, "view", 0, 1.0), (1, 1, "click", 1, 1.0)], spark.createDataFrame([], "vec_id long, embedding array<float>").collect())
    got = registry.queries()["fg_notes"](spark, str(tmp_path)).orderBy("pid", "day").select("views", "clicks", "since", "total").collect()
    assert [tuple(r) for r in got] == [(1, 0, None, None), (0, 1, None, None)]


def test_the_length_of_a_vector_is_computed_once(spark):
    rows = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([],), (None,)], "v array<double>").select(unit_vector(F.col("v")).alias("u"))
    assert rows._jdf.queryExecution().analyzed().toString().lower().count("sqrt") == 1
    assert [r.u for r in rows.collect()] == [[0.6, 0.8], [0.0, 0.0], [], None]
