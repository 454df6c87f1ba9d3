"""Running vectors of patients: sums, exponentially weighted means, carried forward."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from censuskit.functions.codes import unit_vector


def day_sums(notes: DataFrame, dims: int) -> DataFrame:
    """pid, day and total, the sum of the day's unit vectors (pid, day, v: array of doubles)."""
    rows = notes.filter("v IS NOT NULL").select("pid", "day", unit_vector(F.col("v")).alias("v"))
    return rows.groupBy("pid", "day").agg(F.array(*[F.sum(F.get("v", F.lit(i))) for i in range(dims)]).alias("total"))


def carried_vectors(spine: DataFrame, notes: DataFrame, dims: int, halflife: float = 7.0, places: int | None = None) -> DataFrame:
    """For each spine day, of the last day with notes up to it: since (days), total (the sum of its
    unit vectors) and ewm (the mean of totals so far, weighing half for every halflife days
    with notes further back). Nulls before the first one. places: both come rounded, half away from
    zero, once for each day with notes.

    Days with notes and asked days are united and sorted by patient and day; one pass keeps a
    weighted sum and its weight for each patient, in all dimensions at once, so that a history
    costs a sort and one step a day, however long it is."""
    told = day_sums(notes, dims).select("pid", "day", F.lit(False).alias("asked"), "total")
    asked = spine.select("pid", "day", F.lit(True).alias("asked"), F.lit(None).cast("array<double>").alias("total"))
    rows = told.unionByName(asked).filter("pid IS NOT NULL").repartition("pid").sortWithinPartitions("pid", "day", "asked")
    out = StructType([spine.schema["pid"], spine.schema["day"], *StructType.fromDDL("since int, total array<double>, ewm array<double>")])
    shrink = 0.5 ** (1 / halflife)

    def rounded(v: np.ndarray) -> np.ndarray:
        return v if places is None else np.trunc(v * 10.0**places + np.copysign(0.5, v)) / 10.0**places + 0.0  # one zero

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, total, ewm = None, None, None, None
        top, weight = np.zeros(dims), 0.0
        for batch in batches:
            places, since, totals, means = [], [], [], []
            days = batch.column("day").cast(pa.int32()).to_pylist()
            for i, (pid, ask, day) in enumerate(zip(batch.column("pid").to_pylist(), batch.column("asked").to_pylist(), days, strict=True)):
                if pid != now:
                    now, last, total, ewm, top, weight = pid, None, None, None, np.zeros(dims), 0.0
                if not ask:
                    total = batch.column("total")[i].values.to_numpy(zero_copy_only=False)
                    top, weight, last = top * shrink + total, weight * shrink + 1.0, day
                    total, ewm = rounded(total), rounded(top / weight)
                    continue
                places.append(i)
                since.append(None if last is None else day - last)
                totals.append(total)
                means.append(ewm)
            if places:
                at, lists = pa.array(places), pa.list_(pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("pid").take(at), batch.column("day").take(at), pa.array(since, pa.int32()), pa.array(totals, lists), pa.array(means, lists)], out.names)

    return rows.mapInArrow(walk, out)
