"""Literal frames of FIXTURES.md, and histories of many events against plain loops."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from censuskit.operators import bitemporal as b

DAYS = [(1, "2020-01-01"), (1, "2020-01-02"), (1, "2021-10-09"), (2, "2020-01-01"), (2, "2020-01-08"), (2, "2020-02-01"), (3, "2020-01-01"), (3, "2020-02-01"), (3, "2020-03-10")]
F1 = [(1, "2020-01-01"), (1, "2020-01-01"), (1, "2021-10-08"), (2, "2020-01-08"), (2, "2020-02-01"), (3, "2020-02-01"), (3, "2020-02-01")]
F2 = [
    (1, "2020-01-01", "2020-01-01"), (1, "2020-01-01", "2020-01-02"), (1, "2021-10-08", "2021-10-08"), (2, "2020-01-08", "2020-01-07"),
    (2, "2020-02-01", "2020-02-01"), (3, "2020-01-10", "2020-02-01"), (3, "2020-02-01", "2020-03-05"),
]


def spine_of(spark, days):
    return spark.createDataFrame(days, "pid long, day string").withColumn("day", F.to_date("day"))


def in_order(df, days, *names):
    rows = {(r.pid, str(r.day)): r for r in df.collect()}
    assert len(rows) == len(days)
    return [tuple(rows[d][n] for d in days) for n in names]


def test_counts(spark):
    for events, near, month, ever in (
        ([(p, e, e) for p, e in F1], "2 2 1 0 1 1 0 2 0", "2 2 1 0 1 2 0 2 0", "2 2 3 0 1 2 0 2 2"),
        (F2, "1 2 1 0 1 1 0 0 0", "1 2 1 0 1 2 0 1 0", "1 2 3 0 1 2 0 1 2"),
    ):
        got = b.counts(spine_of(spark, DAYS), spark.createDataFrame(events, "pid long, e string, r string"), [2, 7, 14, 30])
        want = [tuple(map(int, x.split())) for x in (near, near, near, month, ever)]
        assert in_order(got, DAYS, "n_2", "n_7", "n_14", "n_30", "n_all") == want


F3_DAYS = [(p, f"2020-01-{d:02d}") for p, ds in ((1, (1, 2, 9, 10, 11, 12, 13, 14)), (2, (2, 6, 7, 8, 9, 10, 11, 12)), (3, (1, 2, 3, 4, 5, 6, 10, 11)), (4, (2, 3, 4, 5, 6, 8, 9, 14))) for d in ds]
F3 = """1 01T18 02T18 09T18 C 8;1 02T18 09T18 - D 4;1 09T06 12T12 - C 3;1 11T18 11T06 - D 10;1 14T12 14T00 10T00 G 9;1 14T12 14T12 21T12 D 10;1 14T15 13T12 - F 10;1 14T18 14T12 - E 2
2 02T06 06T00 - C 0;2 06T12 12T12 18T12 A 1;2 08T18 12T12 - E 7;2 08T18 12T12 - E 9;2 11T00 17T18 - G 4;2 10T12 10T18 - F 0
3 02T00 05T00 - D 0;3 03T06 10T00 14T00 G 5;3 03T06 10T06 - E 6;3 03T18 11T12 - E 7;3 06T06 07T12 - A 4
4 02T18 17T18 - G 9;4 03T12 05T06 - B 9;4 03T18 04T18 - D 10;4 04T06 06T12 20T12 F 6;4 05T00 09T12 - B 10;4 05T18 13T06 - B 5;4 08T00 09T12 13T12 G 10;4 08T00 09T18 - B 6;4 14T01 14T12 - E 4;4 14T17 14T19 20T12 G 4;4 14T00 17T00 - B 7"""
R1 = "- CC - - DD CD CD CF - CC CC CC - FF FF AF - - - - DD DD AA AA - - DD BD BF BF BG BG".split()
R2 = "- 16 - - 20 13 13 12 - 0 0 0 - 0 0 9 - - - - 0 0 8 8 - - 20 19 16 16 16 10".split()


def test_window_agg_with_deletes(spark):
    stamp = lambda s: None if s == "-" else f"2020-01-{s[:2]} {s[3:]}:00:00"
    rows = [r.split() for line in F3.split("\n") for r in line.split(";")]
    events = spark.createDataFrame([(int(p), stamp(e), stamp(r), stamp(x), v, int(n)) for p, e, r, x, v, n in rows], "pid long, e string, r string, x string, v string, n long")
    got = b.window_agg(spine_of(spark, F3_DAYS), events, 7, {"a": F.concat(F.min("v"), F.max("v")), "b": F.min("n") + F.max("n")})
    a, c = in_order(got, F3_DAYS, "a", "b")
    assert [x or "-" for x in a] == R1
    assert ["-" if x is None else str(x) for x in c] == R2


F4_DAYS = DAYS + [(4, f"2020-01-0{i}") for i in range(1, 7)]
F4 = [
    (1, "2020-01-01 01:00", "2020-01-01 01:15", "A"), (1, "2020-01-01 02:00", "2020-01-01 02:15", "A"), (1, "2021-10-08 07:00", "2021-10-08 07:15", "A"),
    (2, "2020-01-08 11:00", "2020-01-08 11:15", "B"), (2, "2020-02-01 11:00", "2020-02-01 11:15", "C"), (3, "2020-02-01 11:00", "2020-02-03 15:00", "C"),
    (3, "2020-02-01 10:00", "2020-02-01 16:00", "A"), (4, "2020-01-01 07:00", "2020-01-01 07:15", "E"), (4, "2020-01-02 07:00", "2020-01-05 07:00", "D"),
    (4, "2020-01-03 07:00", "2020-01-04 07:00", "F"),
]
F5 = [(1, "2021-10-05 10:00", "2021-10-06 06:30"), (3, "2020-03-10 18:00", "2020-03-11 02:00"), (4, "2020-01-05 16:00", "2020-01-06 10:00")]


def test_last_n(spark):
    events = spark.createDataFrame(F4, "pid long, e string, r string, value string")
    resets = spark.createDataFrame(F5, "pid long, e string, r string")
    for reset, first, second in (
        (None, "A A A - B C - A C E E E F F F", "A A A - - B - - A - - - E D D"),
        (resets, "A A A - B C - A C E E E F F -", "A A - - - B - - A - - - E D -"),
    ):
        got = in_order(b.last_n(spine_of(spark, F4_DAYS), events, 2, reset), F4_DAYS, "last_1", "last_2")
        assert [[x or "-" for x in g] for g in got] == [first.split(), second.split()]


def test_days_since(spark):
    events = spark.createDataFrame(F2, "pid long, e string, r string")
    (got,) = in_order(b.days_since(spine_of(spark, DAYS), events), DAYS, "days_since")
    assert got == (0, 1, 1, 9999, 0, 0, 9999, 22, 38)


def plain_last(days, events, resets, n):
    """pid, day -> the last n values, day by day over all events."""
    out = {}
    for pid, day in days:
        seen = [(e, r, k, v) for p, e, r, x, k, v in events if p == pid and max(e, r) <= day and (x is None or day < x)]
        seen += [(e, r, k, None) for p, e, r, k in resets if p == pid and max(e, r) <= day]
        got = []
        for *_, v in sorted(seen, reverse=True)[:n]:
            if v is None:
                break
            got.append(v)
        out[pid, day] = (*got, *[None] * (n - len(got)))
    return out


@pytest.mark.parametrize("piece", [50_000, 40, 1])
def test_last_n_in_pieces(spark, piece):
    """Deletions, resets, nulls, many events on one day, patients without events or days."""
    rng, zero = random.Random(piece), datetime.date(2020, 1, 1)
    day = lambda i: zero + datetime.timedelta(days=i)
    events, resets = [], []
    for k in range(900):
        pid = rng.choice([1, 1, 1, 2, 3, 5])
        e = 50 if k % 5 == 0 else rng.randrange(120)
        r = e + rng.choice([-1, 0, 0, 1, 5])
        x = r + rng.choice([1, 2, 10, 60]) if rng.random() < 0.6 else None
        events.append((pid, day(e), day(r), None if x is None else day(x), k, None if rng.random() < 0.05 else f"v{k}"))
        if rng.random() < 0.02:
            resets.append((pid, day(e), day(r), k + 10_000))
    days = [(pid, day(i)) for pid in (1, 2, 3, 4) for i in range(-3, 130)]
    got = b.last_n(
        spark.createDataFrame(days, "pid long, day date"), spark.createDataFrame(events, "pid long, e date, r date, x date, k long, value string"), 3,
        spark.createDataFrame(resets, "pid long, e date, r date, k long"), ("e", "r", "k"), piece,
    ).collect()
    assert len(got) == len(days)
    assert {(r.pid, r.day): (r.last_1, r.last_2, r.last_3) for r in got} == plain_last(days, events, resets, 3)


def test_last_n_does_not_sort_short_histories_for_the_cuts(spark):
    """One long history beside short ones; tables count as too large to be sent, as they are at size."""
    number = lambda c: F.expr(f"date_add(DATE'2020-01-01', cast({c} as int))")
    events = spark.range(600).select(F.expr("CASE WHEN id < 400 THEN 0 ELSE id % 50 END").alias("pid"), number("id * 7 % 90").alias("e"), F.col("id").alias("value")).withColumns({"r": F.expr("date_add(e, cast(value % 5 as int))"), "x": F.expr("CASE WHEN value % 3 = 0 THEN date_add(e, 20) END")})
    days = spark.range(50 * 90).select((F.col("id") % 50).alias("pid"), number("floor(id / 50)").alias("day"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut, whole = (b.last_n(days, events, 3, order=("e", "r", "value"), piece=piece) for piece in (200, 50_000))
        rows = cut.collect()
        assert sorted(map(str, rows)) == sorted(map(str, whole.collect())) and len(rows) == 50 * 90
        assert "SortMergeJoin" not in cut._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_last_n_time_follows_the_history(spark):
    took = []
    for n in (10_000, 100_000):
        events = spark.range(n).select(F.lit(1).cast("long").alias("pid"), F.expr("date_add(DATE'1900-01-01', cast(id * 7919 % 36500 as int))").alias("e"), F.col("id").alias("value")).withColumns({"r": F.expr("date_add(e, cast(value % 5 as int))"), "x": F.expr("CASE WHEN value % 3 = 0 THEN date_add(e, cast(5 + value % 900 as int)) END")})
        days = spark.range(36_500).select(F.lit(1).cast("long").alias("pid"), F.expr("date_add(DATE'1900-01-01', cast(id as int))").alias("day"))
        began = time.time()
        got = b.last_n(days, events, 3, order=("e", "r", "value"), piece=5_000).agg(F.count(F.lit(1)), F.count("last_3")).first()
        took.append(time.time() - began)
        assert got[0] == 36_500 and got[1] > 30_000
    assert took[1] < 60


def test_window_apply(spark):
    stamp = lambda s: None if s == "-" else f"2020-01-{s[:2]} {s[3:]}:00:00"
    rows = [r.split() for line in F3.split("\n") for r in line.split(";")]
    events = spark.createDataFrame([(int(p), stamp(e), stamp(r), stamp(x), v, int(n)) for p, e, r, x, v, n in rows], "pid long, e string, r string, x string, v string, n long")
    fn = lambda seen: (seen["v"].min() + seen["v"].max(), int(seen["n"].min() + seen["n"].max()))
    got = b.window_apply(spine_of(spark, F3_DAYS), events, 7, fn, "a string, b long")
    a, c = in_order(got, F3_DAYS, "a", "b")
    assert [x or "-" for x in a] == R1
    assert ["-" if x is None else str(x) for x in c] == R2
    # without a window: all that is visible
    ever = b.window_apply(spine_of(spark, F3_DAYS), events, None, lambda seen: (len(seen),), "n long")
    agg = b.window_agg(spine_of(spark, F3_DAYS), events, 10_000, {"n": F.count(F.lit(1))})
    assert sorted(map(str, ever.collect())) == sorted(map(str, agg.collect()))


def test_window_lists_as_window_apply_without_frames(spark, monkeypatch):
    rng = random.Random(11)
    at = lambda i: datetime.date(2020, 1, 1) + datetime.timedelta(days=i)
    rows = [(rng.choice([1, 2, 3, None]), at(d := rng.randrange(150)), at(d + rng.randrange(4)), at(d + 9) if k % 5 == 0 else None, k, rng.choice(["a", "b", None])) for k in range(300)]
    events = spark.createDataFrame(rows, "pid long, e date, r date, x date, n long, v string")
    spine = spark.createDataFrame([(p, at(i)) for p in (1, 2, 4, None) for i in range(160)], "pid long, day date")
    framed = b.window_apply(spine, events, 7, lambda seen: (len(seen), ",".join(map(str, seen.sort_values(["e", "r", "n"])["n"]))), "size long, path string")
    monkeypatch.setattr(b, "pd", None)  # no frame is made
    got = b.window_lists(spine, events, 7, lambda n, v: (len(v), ",".join(map(str, n))), "size long, path string", ["n", "v"], ["e", "r", "n"])
    assert sorted(map(str, got.collect())) == sorted(map(str, framed.collect()))
