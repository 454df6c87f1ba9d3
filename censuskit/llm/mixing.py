"""Mixing sources to target weights with a low-discrepancy schedule.

Each source is a stream of words: its documents in a shuffled order (by a seeded hash),
read again from its start when it ends. The mix is a sequence of N slots of equally many
words, N a power of two of at least ``min_slots``, so that a slot has at most ``block_words``
words. Slot n takes the van der Corput point phi_2(n), which falls into one source's part
of the cumulative target shares; every stretch of the slots is close to these shares. Slots
are ranked inside their source, and the slot of rank k takes the k-th block of the source's
stream. What a source gives, and where, is what the sequence deals to it: its slots differ
from its share of N by one at most, as the first 2^m points are a grid; a source stops at
``most`` times its size.

Ranks, running word counts and running shares are two-level (per chunk, hash bucket or
range, then offsets), so a source with most rows, or a table of very many sources, is
spread over many tasks.

Defined results: null text has size 0; a null source is a source of its own, the last one;
documents of size 0 take 0. Rows that repeat are separate rows. Columns that are not named
are never read. An empty table gives an empty result; if no document has a word, all
targets are 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from censuskit.llm.common import WORD, stash

#: Weights that the sources take in turn.
WEIGHTS = (5, 2, 1)
#: A source table of at most so many rows is broadcast; beyond it is joined by key.
BROADCAST_ROWS = 50_000
#: Sources to a range of the running shares.
RANGE_SOURCES = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """One row per source: source, s (its number), source_size, target and total. Targets share
    all words by weight; a source stops at ``most`` times its size and the excess is shared
    again by weight, until none is above."""
    # numbered in parts of the sorted sources
    ordered = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.asc_nulls_last("source"))
    ordered = stash(ordered.withColumn("part", F.spark_partition_id()), "mix-sources")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per part
    offsets = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(W.partitionBy("part").orderBy(F.asc_nulls_last("source"))) - 1
    rows = ordered.withColumn("rank", rank).join(F.broadcast(offsets), "part").withColumn("s", F.col("offset") + F.col("rank"))
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.col("s") % len(weights)) + 1).cast("int")).cast("double")
    rows = stash(rows.select("source", "s", "source_size", w.alias("w"), (F.col("source_size") * float(most)).alias("cap")), "mix-weights")
    # words for a weight of 1; each turn caps the sources that would be above
    level, total = -1.0, rows.agg(F.sum("source_size")).first()[0] or 0
    while True:
        capped = F.col("cap") <= level * F.col("w")
        sums = rows.agg(F.sum(F.when(capped, 0.0).otherwise(F.col("w"))).alias("w"), F.sum(F.when(capped, F.col("cap")).otherwise(0.0)).alias("words")).first()
        further = (total - sums.words) / sums.w if sums.w else level
        if further <= level:
            break
        level = further
    return rows.select("source", "s", "source_size", F.least("cap", F.lit(max(level, 0.0)) * F.col("w")).alias("target"), F.lit(total).cast("long").alias("total"))


def van_der_corput(n: Column) -> Column:
    """The base-2 radical inverse of n: its binary digits mirrored at the point."""
    digits = F.bin(n)
    return F.conv(F.reverse(digits), 2, 10).cast("double") / F.pow(F.lit(2.0), F.length(digits))


def slot_count(total: int, block_words: int, min_slots: int) -> int:
    """A power of two: the slots of a mix of so many words."""
    return 1 << max(math.ceil(math.log2(min_slots)), math.ceil(math.log2(max(1.0, total / block_words))))


def schedule(targets: DataFrame, slots: int, point: Column | None = None) -> DataFrame:
    """Slots in order: position, s, k (the slot's rank in its source, from 0). point: the
    sequence, as a column of ``id``; van der Corput if not given."""
    chunk = max(1024, math.isqrt(slots))
    ranged = targets.filter("target > 0").withColumn("range", F.floor(F.col("s") / RANGE_SOURCES))
    sums = ranged.groupBy("range").agg(F.sum("target").alias("t")).withColumn("offset", F.coalesce(F.sum("t").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    inside = W.partitionBy("range").orderBy("s").rowsBetween(W.unboundedPreceding, 0)
    ends = ranged.withColumn("upto", F.sum("target").over(inside)).join(F.broadcast(sums.select("range", "offset")), "range").withColumn("end", F.col("offset") + F.col("upto"))
    ends = stash(ends.select("s", "target", "end"), "mix-ends")
    found = ends.agg(F.max("end"), F.count(F.lit(1))).first()
    whole, grid = found[0] or 1.0, 1 << max(10, (2 * found[1]).bit_length())
    # a source's part ends where the next one's begins: the end before, found by number, or 0
    part = ends.select("s", F.least(F.col("end") / whole, F.lit(1.0)).alias("hi"), F.greatest(F.lit(0.0), (F.col("end") - F.col("target")) / whole).alias("lo"))
    cells = part.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * grid), F.least(F.floor(F.col("hi") * grid), F.lit(grid - 1)))))
    points = targets.sparkSession.range(slots).select(F.col("id").alias("position"), (point if point is not None else van_der_corput(F.col("id"))).alias("x")).withColumn("cell", F.floor(F.col("x") * grid))
    hit = points.join(cells, "cell").filter((F.col("x") >= F.col("lo")) & ((F.col("x") < F.col("hi")) | (F.col("hi") >= 1.0)))
    # rounding may leave a point to two neighbours or none at a border; the first of two has it
    hit = hit.groupBy("position").agg(F.min("s").alias("s")).withColumn("chunk", F.floor(F.col("position") / chunk))
    hit = stash(hit, "mix-slots")
    counts = hit.groupBy("s", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("s").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("s", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(W.partitionBy("s", "chunk").orderBy("position")) - 1
    return hit.withColumn("rank", rank).join(offsets, ["s", "chunk"]).select("position", "s", (F.col("offset") + F.col("rank")).alias("k"))


def placed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key_col: str | None = None, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Documents at their places in their source's shuffled stream (start counts words from 0),
    and the targets. key_col: a column to keep."""
    size = F.expr(f"regexp_count(coalesce(`{text_col}`, ''), r'{WORD}')").cast("long")
    # with the text, so that rows without an id, or with one that many have, are dealt out too
    shuffled = F.xxhash64(F.lit(seed), F.col(id_col), F.coalesce(text_col, F.lit("")))
    key = F.col(key_col) if key_col else F.lit(None).cast("long")
    sizes = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), F.col(source_col).alias("source"), size.alias("size"), shuffled.alias("u"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("t"))
    sizes = stash(sizes, "mix-sizes")
    targets = stash(source_targets(sizes, weights, most), "mix-targets")
    small = targets.select(F.col("source").alias("src"), "s", "source_size", "target")
    if targets.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    buckets = max(1024, sizes.count() // 100_000)
    rows = sizes.join(small, sizes.source.eqNullSafe(F.col("src"))).drop("src").withColumn("bucket", F.pmod("u", F.lit(buckets)))
    before = W.partitionBy("s").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = rows.groupBy("s", "bucket").agg(F.sum("size").alias("n")).select("s", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("s", "bucket").orderBy("u", "doc_id", "t", "size", "key").rowsBetween(W.unboundedPreceding, 0)
    placed = rows.withColumn("upto", F.sum("size").over(inside)).join(offsets, ["s", "bucket"])
    placed = placed.withColumn("start", F.col("offset") + F.col("upto") - F.col("size"))
    return stash(placed.select("doc_id", "key", "s", "size", "source_size", "target", "start"), "mix-placed"), targets


def mixture(placed: DataFrame, slots: DataFrame, total: int, n_slots: int, most: int = 3) -> DataFrame:
    """The mix itself: one row for each piece of a document in a slot, with position, s, k,
    doc_id, start, from_word (in the document) and n_words, n_words > 0."""
    words = total / n_slots
    first = lambda k: F.floor(k * F.lit(words)).cast("long")
    # the stream's rounds: word w of round r is word w + r * source_size of the stream
    rounds = placed.filter("size > 0").withColumn("from", F.explode(F.sequence(F.col("start"), F.col("start") + (most - 1) * F.col("source_size"), F.col("source_size"))))
    near = lambda w: F.floor(w / F.lit(words)).cast("long")
    blocks = F.sequence(F.greatest(near(F.col("from")) - 1, F.lit(0)), near(F.col("from") + F.col("size")) + 1)
    pieces = rounds.select("doc_id", "s", "start", "size", "from", F.explode(blocks).alias("k"))
    begin, end = F.greatest("from", first(F.col("k"))), F.least(F.col("from") + F.col("size"), first(F.col("k") + 1))
    pieces = pieces.withColumn("n_words", end - begin).withColumn("from_word", begin - F.col("from")).filter("n_words > 0")
    return pieces.join(slots, ["s", "k"]).select("position", "s", "k", "doc_id", "start", "from_word", "n_words")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key_col: str | None = None, block_words: int = 256, min_slots: int = 1 << 16, most: int = 3, point: Column | None = None, **more) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken,
    first_slot (the position in the mix where it first appears; null if it does not), key."""
    placed, targets = placed_documents(docs, id_col, text_col, source_col, key_col, most=most, **more)
    total = (targets.agg(F.max("total")).first()[0]) or 0
    n_slots = slot_count(total, block_words, min_slots)
    slots = schedule(targets, n_slots if total else 0, point)
    taken = mixture(placed, slots, max(total, 1), n_slots, most).groupBy("s", "start").agg(F.sum("n_words").alias("taken"), F.min("position").alias("first_slot")).withColumn("sized", F.lit(True))
    rows = placed.withColumn("sized", F.col("size") > 0).join(taken, ["s", "start", "sized"], "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", "key")
