"""Reasons behind features: the event that a feature's name points at, for any day.

A feature's name says which kind of event it counts and how far back it looks. Names become a
small rule table; all features are answered from one union and one window per patient and kind.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

#: Days that a feature looks back if its name says more than 30, or nothing: all of them.
EVER = 1_000_000
_DAYS = re.compile(r"_(\d+)_day(?:s)?(?:_|$)")


def parse_features(features: Sequence[str], kinds: dict[str, str], bounds: dict[str, tuple[float, float]] | None = None) -> list[tuple]:
    """feature, kind, window (days), low, high. kinds maps patterns of names to kinds of events,
    the first that fits counts; bounds are those between which a kind's values are usual. A
    feature that no pattern fits has no kind."""
    out = []
    for f in features:
        kind = next((k for p, k in kinds.items() if re.search(p, f)), None)
        said = _DAYS.search(f)
        days = int(said[1]) if said and int(said[1]) <= 30 else EVER
        low, high = (bounds or {}).get(kind, (None, None))
        out.append((f, kind, days, low, high))
    return out


def event_reasons(spine: DataFrame, events: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """pid, day, feature, kind, event_id, days and status for each spine day and feature.

    events: pid, day, kind, ts, event_id, value. The latest event of the feature's kind within its
    window (the day itself and window - 1 before) is its reason: MAPPED if the value is outside
    the kind's bounds, else DATA_FOUND; DATA_NOT_FOUND without one; NOT_MAPPED without a kind.
    The latest event of a kind up to a day serves windows of all lengths, so that a history is
    sorted once, however many features ask."""
    spark = spine.sparkSession
    table = spark.createDataFrame(list(rules), "feature string, kind string, window int, low double, high double")
    kinds = sorted({r[1] for r in rules if r[1] is not None})
    asked = spine.select("pid", "day", F.explode(F.array(*map(F.lit, [*kinds, ""]))).alias("kind"), F.lit(True).alias("asked"))
    told = events.filter(F.col("kind").isin(*kinds)).select("pid", "day", "kind", F.struct("day", "ts", "event_id", "value").alias("found"))
    upto = W.partitionBy("pid", "kind").orderBy("day").rangeBetween(W.unboundedPreceding, 0)
    latest = asked.unionByName(told, allowMissingColumns=True).withColumn("found", F.max("found").over(upto)).filter("asked")
    # the rule table is as small as the list of features; "" stands for those without a kind
    both = latest.join(table.withColumnRenamed("kind", "of").withColumn("kind", F.coalesce("of", F.lit(""))), "kind")
    days = F.date_diff("day", "found.day")
    inside = days < F.col("window")
    x = F.col("found.value")
    status = F.when(F.col("of").isNull(), "NOT_MAPPED").when(F.coalesce(~inside, F.lit(True)), "DATA_NOT_FOUND").when((x < F.col("low")) | (x > F.col("high")), "MAPPED").otherwise("DATA_FOUND")
    return both.select("pid", "day", "feature", F.col("of").alias("kind"), F.when(inside, F.col("found.event_id")).alias("event_id"), F.when(inside, days).alias("days"), status.alias("status"))
