"""Features that see an event only from the day it was reported until it was deleted.

An event has an event day ``e``, a reported day ``r`` and perhaps a deleted day ``x``. It is
visible on patient-day ``c`` if max(e, r) <= c and not x <= c. Where the feature is a
running count or maximum, spine and events are united and one window runs over both: the
cost is a sort, however long a history is. The last n values come from one sweep over reports,
deletions and spine days, in pieces where a history is long. Aggregates of a window join spine
and events on stretches of days as long as the window, never a whole history by range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

NEVER = 9999
#: Changes and asked days of one patient that one piece of a sweep should have.
PIECE = 50_000
_END, _BEGIN = 2**31 - 1, -(2**31)
#: Places where a long history may be cut, and the smallest power of two above the pieces.
_CUTS, _LEAVES = 1024, 2048


def visible_day(e: str, r: str) -> Column:
    return F.greatest(F.to_date(e), F.to_date(r))


def _with_kinds(spine: DataFrame, kinds: Sequence[str] | None) -> DataFrame:
    return spine.withColumn("kind", F.explode(F.array(*map(F.lit, kinds)))) if kinds else spine.withColumn("kind", F.lit(None).cast("string"))


def days_since(spine: DataFrame, events: DataFrame, kinds: Sequence[str] | None = None) -> DataFrame:
    """Days from the latest visible event to each spine day, else 9999.

    spine: pid, day. events: pid, e, r and, with kinds, kind. One row per spine day and kind."""
    told = events.select("pid", *(["kind"] if kinds else [F.lit(None).cast("string").alias("kind")]), visible_day("e", "r").alias("day"), F.to_date("e").alias("e"), F.lit(False).alias("asked"))
    asked = _with_kinds(spine.select("pid", "day"), kinds).select("pid", "kind", "day", F.lit(None).cast("date").alias("e"), F.lit(True).alias("asked"))
    upto = W.partitionBy("pid", "kind").orderBy("day").rangeBetween(W.unboundedPreceding, 0)
    both = told.unionByName(asked).withColumn("last", F.max("e").over(upto)).filter("asked")
    return both.select("pid", "day", "kind", F.coalesce(F.date_diff("day", "last"), F.lit(NEVER)).alias("days_since"))


def counts(spine: DataFrame, events: DataFrame, windows: Sequence[int], kinds: Sequence[str] | None = None, first_only: bool = False) -> DataFrame:
    """Visible events with e > c - w for each window w, and of all time: columns n_<w>, n_all.

    An event counts on the days from max(e, r) to e + w - 1, so it adds 1 on the first and
    takes 1 away after the last; a running sum over both answers every spine day.
    first_only keeps the earliest event of each reported day."""
    told = events.select("pid", *(["kind"] if kinds else [F.lit(None).cast("string").alias("kind")]), F.to_date("e").alias("e"), visible_day("e", "r").alias("v"))
    if first_only:
        told = told.groupBy("pid", "kind", "v").agg(F.min("e").alias("e"))
    late = lambda w: F.date_add("e", w) > F.col("v")
    zero = F.lit(0)
    enter = F.struct(F.col("v").alias("day"), *[F.when(late(w), 1).otherwise(zero).alias(f"n_{w}") for w in windows], F.lit(1).alias("n_all"))
    leave = [F.struct(F.date_add("e", w).alias("day"), *[F.when(late(w), -1).otherwise(zero).alias(f"n_{v}") if v == w else zero.alias(f"n_{v}") for v in windows], zero.alias("n_all")) for w in windows]
    deltas = told.select("pid", "kind", F.inline(F.array(enter, *leave))).withColumn("asked", F.lit(False))
    asked = _with_kinds(spine.select("pid", "day"), kinds).select("pid", "kind", "day", *[zero.alias(f"n_{w}") for w in windows], zero.alias("n_all"), F.lit(True).alias("asked"))
    upto = W.partitionBy("pid", "kind").orderBy("day").rangeBetween(W.unboundedPreceding, 0)
    names = [*[f"n_{w}" for w in windows], "n_all"]
    both = deltas.unionByName(asked).withColumns({n: F.sum(n).over(upto) for n in names})
    return both.filter("asked").select("pid", "day", "kind", *names)


def _told(events: DataFrame) -> DataFrame:
    """events with v_ and until_, the first and last day that sees them (as day numbers)."""
    x = F.unix_date(F.to_date("x")) - 1 if "x" in events.columns else F.lit(None).cast("int")
    told = events.withColumns({"v_": F.unix_date(visible_day("e", "r")), "until_": F.coalesce(x, F.lit(_END))})
    return told.filter("pid IS NOT NULL AND v_ <= until_")


def _stretches(spine: DataFrame, events: DataFrame, window: int, length: int) -> tuple[DataFrame, DataFrame]:
    """Spine days and events with c - window < e, each with stretch_, a piece of time of length days,
    not less than the window: an event is in those (three at most, whatever the history) whose
    days can see it."""
    told = _told(events).withColumn("until_", F.least("until_", F.unix_date(F.to_date("e")) + (window - 1))).filter("v_ <= until_")
    piece = lambda c: F.floor(F.col(c) / length).cast("int")
    told = told.withColumn("stretch_", F.explode(F.sequence(piece("v_"), piece("until_"))))
    days = spine.select("pid", "day", F.unix_date("day").alias("day_")).withColumn("stretch_", piece("day_"))
    return days, told


def window_agg(spine: DataFrame, events: DataFrame, window: int, aggs: dict[str, Callable[[str], Column] | Column]) -> DataFrame:
    """Aggregates of the visible events with c - window < e <= c; null where there is none."""
    days, told = _stretches(spine, events, window, window)
    seen = days.join(told, ["pid", "stretch_"]).filter("day_ BETWEEN v_ AND until_")
    found = seen.groupBy("pid", "day").agg(*[a.alias(n) for n, a in aggs.items()])
    return spine.select("pid", "day").join(found, ["pid", "day"], "left")


def window_apply(spine: DataFrame, events: DataFrame, window: int | None, fn: Callable[[pd.DataFrame], tuple], schema: str) -> DataFrame:
    """What a Python function makes of the visible events with c - window < e <= c (None: of all
    that are visible), in the order of e and r: one value for each column of schema, nulls where
    there is none. For functions that no Column expresses.

    A group is a patient and a stretch of 60 days (or of the window, if longer), with the events
    that it can see; without a window it is all that a patient has, as the function is free to use it."""
    if window is None:
        days = spine.select("pid", "day", F.unix_date("day").alias("day_"), F.lit(0).alias("stretch_"))
        told = _told(events).withColumn("stretch_", F.lit(0))
    else:
        days, told = _stretches(spine, events, window, max(window, 60))
    names = [*events.columns]
    out = StructType([spine.schema["pid"], spine.schema["day"], *StructType.fromDDL(schema)])

    def apply(asked: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        seen = seen.sort_values(["e", "r"], kind="stable")
        first, last, plain = seen["v_"].to_numpy(), seen["until_"].to_numpy(), seen[names]
        rows = []
        for pid, day, number in zip(asked["pid"], asked["day"], asked["day_"], strict=True):
            mask = (first <= number) & (number <= last)
            rows.append((pid, day, *(fn(plain[mask]) if mask.any() else [None] * (len(out) - 2))))
        return pd.DataFrame(rows, columns=out.names)

    return days.groupBy("pid", "stretch_").cogroup(told.groupBy("pid", "stretch_")).applyInPandas(apply, out)


def window_lists(spine: DataFrame, events: DataFrame, window: int, fn: Callable[..., tuple], schema: str, columns: Sequence[str], order: Sequence[str] = ("e", "r")) -> DataFrame:
    """As window_apply, for functions of lists: fn gets the values of each of columns, of the visible
    events in the given order (nulls first). Events and days are united and sorted by patient and
    stretch, events first; a task holds the events of one stretch and makes no frame for a day."""
    days, told = _stretches(spine, events, window, max(window, 60))
    out = StructType([spine.schema["pid"], spine.schema["day"], *StructType.fromDDL(schema)])
    types = [f.type for f in to_arrow_schema(out)][2:]
    keys, names = [f"k{i}_" for i in range(len(order))], [f"c{i}_" for i in range(len(columns))]
    changes = told.select("pid", "stretch_", F.lit(False).alias("asked_"), "v_", "until_", *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)], *[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    asked = days.select("pid", "stretch_", F.lit(True).alias("asked_"), "day", "day_")
    rows = changes.unionByName(asked, allowMissingColumns=True).repartition("pid", "stretch_").sortWithinPartitions("pid", "stretch_", "asked_", *keys).drop(*keys)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seen = None, []
        for batch in batches:
            places, found = [], []
            column = [batch.column(c).to_pylist() for c in ("pid", "stretch_", "asked_", "day_", "v_", "until_", *names)]
            for i, (pid, stretch, ask, number, *event) in enumerate(zip(*column, strict=True)):
                if place != (pid, stretch):
                    place, seen = (pid, stretch), []
                if not ask:
                    seen.append(event)
                    continue
                inside = [x[2:] for x in seen if x[0] <= number <= x[1]]
                places.append(i)
                found.append(fn(*map(list, zip(*inside, strict=True))) if inside else [None] * len(types))
            if places:
                at = pa.array(places)
                made = [pa.array([f[k] for f in found], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([batch.column("pid").take(at), batch.column("day").take(at), *made], out.names)

    return rows.mapInArrow(walk, out)


class _Newest:
    """An event in a heap whose smallest member is the newest; stop ends the list of values."""

    __slots__ = ("key", "stop", "until", "value")

    def __init__(self, key: tuple, until: int, value: object, stop: bool) -> None:
        self.key, self.until, self.value, self.stop = key, until, value, stop

    def __lt__(self, other: _Newest) -> bool:
        return self.key > other.key


def _sweep(batches: Iterator[pa.RecordBatch], n: int, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows come by patient, piece and day, changes before asked days. The heap holds what has
    been reported; what has been deleted leaves it when it is met on top."""
    heap: list[_Newest] = []
    place, found, good_until = None, [], _BEGIN
    for batch in batches:
        column = {c: batch.column(c).to_pylist() for c in ("pid", "piece", "t", "asked", "until", "value", "stop", *keys)}
        rows: list[tuple[int, list]] = []
        for i, (pid, piece, day, asked) in enumerate(zip(column["pid"], column["piece"], column["t"], column["asked"], strict=True)):
            if place != (pid, piece):
                place, heap, good_until = (pid, piece), [], _BEGIN
            if not asked:
                key = tuple((column[k][i] is not None, column[k][i]) for k in keys)
                heappush(heap, _Newest(key, column["until"][i], column["value"][i], column["stop"][i]))
                good_until = _BEGIN
                continue
            if day > good_until:
                top, good_until = [], _END
                while heap and len(top) < n:
                    event = heappop(heap)
                    if event.until >= day:
                        top.append(event)
                        good_until = min(good_until, event.until)
                found = []
                for event in top:
                    heappush(heap, event)
                for event in top:
                    if event.stop:
                        break
                    found.append(event.value)
            rows.append((i, found))
        if rows:
            at = pa.array([i for i, _ in rows])
            values = [pa.array([f[k] if k < len(f) else None for _, f in rows], batch.schema.field("value").type) for k in range(n)]
            yield pa.RecordBatch.from_arrays([batch.column("pid").take(at), batch.column("day").take(at), *values], ["pid", "day", *[f"last_{k + 1}" for k in range(n)]])


def _cut(told: DataFrame, asked: DataFrame, n: int, piece: int) -> tuple[DataFrame, DataFrame]:
    """told and asked with the piece of the history that they belong to.

    Long histories are cut at quantiles of their changes and days. An event belongs to the
    pieces in which it appears or goes. Of those that are visible all through a piece only the n
    newest matter: they are found for the nodes of a binary tree over the pieces, of which some
    twenty cover any run, and handed down to the pieces below each node.

    There are at most one long history and three cuts for each ``piece`` changes and days, so
    both go to all tasks, and the other histories are not sorted or shuffled here."""
    times = told.select("pid", F.explode(F.array("v_", "until_")).alias("t")).filter(F.col("t") < _END).unionByName(asked.select("pid", F.col("day_").alias("t")))
    long = times.groupBy("pid").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > piece)
    marks = times.join(F.broadcast(long), "pid").groupBy("pid").agg(F.percentile_approx("t", [i / _CUTS for i in range(_CUTS)], 10_000).alias("marks"), F.min("t").alias("first"), F.first("rows").alias("rows"))
    step = F.greatest(F.lit(1), F.floor(F.lit(_CUTS * piece) / F.col("rows"))).cast("int")
    cuts = marks.select("pid", step.alias("step"), "first", "marks").select("pid", F.array_sort(F.array_distinct(F.concat(F.array(F.col("first") - 1), F.filter("marks", lambda m, i: i % F.col("step") == 0)))).alias("cuts"))
    cuts = F.broadcast(cuts)
    none = F.array().cast("array<int>")
    number = lambda c: F.size(F.filter("cuts", lambda x: x < F.col(c)))
    told = told.join(cuts, "pid", "left").withColumn("cuts", F.coalesce("cuts", none)).withColumns({"a_": number("v_"), "b_": number("until_")})
    whole_a = (F.col("a_") > 0) & (F.col("v_") == F.try_element_at("cuts", F.col("a_")) + 1)
    whole_b = F.when(F.col("b_") < F.size("cuts"), F.col("until_") == F.try_element_at("cuts", F.col("b_") + 1)).otherwise((F.col("until_") == _END) & (F.size("cuts") > 0))
    told = told.withColumns({"from_": F.col("a_") + F.when(whole_a, 0).otherwise(1), "to_": F.col("b_") - F.when(whole_b, 0).otherwise(1)})
    parts = F.filter(F.array_distinct(F.array("a_", "b_")), lambda c: (c < F.col("from_")) | (c > F.col("to_")))
    inside = told.withColumn("piece", F.explode(parts))

    def nodes(level: Column) -> Column:
        wide = F.pow(F.lit(2), level)
        lo, hi = F.ceil((F.col("from_") + _LEAVES) / wide), F.floor((F.col("to_") + 1 + _LEAVES) / wide)
        return F.array(F.when((lo < hi) & (lo % 2 == 1), lo), F.when((lo < hi) & (hi % 2 == 1), hi - 1))

    over = told.filter("from_ <= to_").withColumn("node_", F.explode(F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(10)), nodes)))))
    newest = W.partitionBy("pid", "node_").orderBy(F.desc("key_"))
    over = over.withColumn("turn_", F.row_number().over(newest)).filter(F.col("turn_") <= n)
    wide = F.pow(F.lit(2), F.lit(11) - F.floor(F.log2(F.col("node_") + 0.5)))
    below = F.sequence((F.col("node_") * wide - _LEAVES).cast("int"), F.least((F.col("node_") + 1) * wide - 1 - _LEAVES, F.size("cuts")).cast("int"))
    handed = over.withColumn("piece", F.explode(below)).withColumns({"v_": F.lit(_BEGIN), "until_": F.lit(_END)})
    asked = asked.join(cuts, "pid", "left").withColumn("cuts", F.coalesce("cuts", none)).withColumn("piece", number("day_"))
    keep = ["pid", "piece", "v_", "until_", "key_", "value", "stop_"]
    return inside.select(*keep).unionByName(handed.select(*keep)), asked.select("pid", "piece", "day", "day_")


def last_n(spine: DataFrame, events: DataFrame, n: int, resets: DataFrame | None = None, order: Sequence[str] = ("e", "r"), piece: int = PIECE) -> DataFrame:
    """The last n values visible on each day, newest first: columns last_1 .. last_n.

    resets (pid, e, r) count as n nulls each; a value is null if a newer one is null. One sweep
    over changes and days of a patient, in time that follows their number; of a history with
    more than ``piece`` of them the pieces are swept apart."""
    told = events.withColumn("stop_", F.col("value").isNull())
    if resets is not None:
        told = told.unionByName(resets.withColumn("stop_", F.lit(True)), allowMissingColumns=True)
    told = _told(told).withColumn("key_", F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)]))
    asked = spine.select("pid", "day", F.unix_date("day").alias("day_"))
    told, asked = _cut(told, asked, n, piece)
    keys = [f"k{i}" for i in range(len(order))]
    changes = told.select("pid", "piece", F.lit(None).cast("date").alias("day"), F.col("v_").alias("t"), F.lit(False).alias("asked"), F.col("until_").alias("until"), "value", F.col("stop_").alias("stop"), "key_.*")
    days = asked.select("pid", "piece", "day", F.col("day_").alias("t"), F.lit(True).alias("asked"))
    rows = changes.unionByName(days, allowMissingColumns=True).repartition("pid", "piece").sortWithinPartitions("pid", "piece", "t", "asked")
    out = StructType([spine.schema["pid"], spine.schema["day"], *[StructField(f"last_{k + 1}", events.schema["value"].dataType) for k in range(n)]])
    return rows.mapInArrow(lambda batches: _sweep(batches, n, keys), out)
