"""Information between a number and a class, from nearest neighbours.

The estimate of Ross (2014): a row's distance to its k-th neighbour of the same class, and how
many rows of any class are nearer. Orders are over ranges of the number, and neighbours are
found in blocks of a class's ranks with the k rows on either side carried over, so that neither
a class nor the whole column is in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from censuskit.operators.frames import written
from censuskit.operators.scale import range_of, running_sums

#: Ranks of one block of a class.
BLOCK = 4096


def digamma(n: Column) -> Column:
    """The digamma function of positive whole numbers: of 8 and more by its series."""
    x = F.greatest(n.cast("double"), F.lit(8.0))
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * F.pow(x, 2)) + 1 / (120 * F.pow(x, 4)) - 1 / (252 * F.pow(x, 6)) + 1 / (240 * F.pow(x, 8))
    # from 8 down: psi(n) = psi(n + 1) - 1 / n
    steps = F.aggregate(F.sequence(F.lit(1), F.lit(7)), F.lit(0.0), lambda s, i: s + F.when(i >= n, 1.0 / i).otherwise(0.0))
    return series - steps


def _ranked(rows: DataFrame) -> DataFrame:
    """rows (id, x, y) with at, the place of the row in its class by x and id, from 0."""
    ranged = rows.withColumn("range_", range_of(rows, "x"))
    sizes = ranged.groupBy("y", "range_").agg(F.count(F.lit(1)).alias("n_"))
    before = F.coalesce(F.sum("n_").over(W.partitionBy("y").orderBy("range_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("y", "range_", before.alias("before_"))  # a row for each class and range
    inside = F.row_number().over(W.partitionBy("y", "range_").orderBy("x", "id")) - 1
    return ranged.withColumn("inside_", inside).join(offsets, ["y", "range_"]).select("id", "x", "y", (F.col("inside_") + F.col("before_")).alias("at"))


def neighbour_distances(rows: DataFrame, k: int = 3, block: int = BLOCK) -> DataFrame:
    """id, x, y, size (rows of the class), k (at most the others of the class) and dist, the
    distance to the k-th neighbour of the class; classes of one row are left out."""
    sizes = rows.groupBy("y").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    place, at = F.floor(F.col("at") / block), F.col("at") % block
    near = F.array_compact(F.array(place, F.when((at < k) & (place > 0), place - 1), F.when(at >= block - k, place + 1)))
    placed = _ranked(rows).withColumn("home", place).withColumn("block", F.explode(near))
    by = W.partitionBy("y", "block").orderBy("at")
    gaps = [F.col("x") - F.lag("x", i).over(by) for i in range(1, k + 1)] + [F.lead("x", i).over(by) - F.col("x") for i in range(1, k + 1)]
    found = placed.withColumn("gaps", F.array_sort(F.array_compact(F.array(*gaps)))).filter("block = home").join(sizes, "y")
    own = F.least(F.lit(k), F.col("size") - 1).cast("int")
    return found.select("id", "x", "y", "size", own.alias("k"), F.element_at("gaps", own).alias("dist"))


def mutual_information(df: DataFrame, number: str, label: str, k: int = 3) -> float:
    """Mutual information in nats, not below 0, of a number and a class; rows with a null in
    either, and classes of one row, take no part. Nearer rows are those with
    x - dist < x' < x + dist, and those equal to x (as doubles; with ties dist can be 0)."""
    rows = df.select(F.col(number).cast("double").alias("x"), F.col(label).alias("y")).filter("x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL")
    rows = written(rows.withColumn("id", F.monotonically_increasing_id()), "information-rows")
    near = written(neighbour_distances(rows, k), "information-near")
    zero = F.col("dist") == 0
    # points, and two questions a row: how many are below x + dist, how many not above x - dist
    points = near.select(F.col("x").alias("v"), F.lit(1).alias("tie"), F.lit(1).alias("one"), F.lit(None).cast("long").alias("id"), F.lit(0).alias("sign"))
    upper = near.select((F.col("x") + F.col("dist")).alias("v"), F.when(zero, 2).otherwise(0).alias("tie"), F.lit(0).alias("one"), "id", F.lit(1).alias("sign"))
    lower = near.select((F.col("x") - F.col("dist")).alias("v"), F.when(zero, 0).otherwise(2).alias("tie"), F.lit(0).alias("one"), "id", F.lit(-1).alias("sign"))
    counted = running_sums(points.unionByName(upper).unionByName(lower), "v", {"upto": "one"}, tie="tie").filter("id IS NOT NULL")
    m = counted.groupBy("id").agg(F.sum(F.col("upto") * F.col("sign")).alias("m"))
    total = near.join(m, "id").agg(F.count(F.lit(1)).alias("n"), F.avg(digamma(F.col("k"))).alias("a"), F.avg(digamma(F.col("size"))).alias("b"), F.avg(digamma(F.col("m"))).alias("c"))
    row = total.select("n", (digamma(F.col("n")) + F.col("a") - F.col("b") - F.col("c")).alias("mi")).first()
    return max(0.0, row.mi) if row.n else 0.0
