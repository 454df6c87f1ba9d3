"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A document is the set of the digests of its lines that are not blank. Its sketch has
three tables of ``width`` cells; each digest goes into one cell of each table. A cell
holds how many digests it has, their XOR and the XOR of their check values. Sketches of
two versions subtract cell by cell, which cancels what they share. A cell with one digest
left (and a check value that fits) gives that digest away; removing it from its other
cells exposes more, until the difference is recovered or no such cell is left.

A pair that does not peel is retried larger: both sets are split in four by bits of the
digests and each part gets a whole sketch of its own, again for parts that still fail.
The work stays linear in the number of lines at each step, for documents of any length.

Likeness is Jaccard over the two sets, from the sizes and the recovered difference. A text
of one line and its edited form share no line, so their likeness is 0.

Defined results: null counts as the empty text; two texts without lines have likeness 1,
one without and one with lines 0. Repeated lines count once. Rows that share an id are
ordered by a hash of the text; identical rows follow one another. Rows with a null id come
last. A table of one row is its own next document. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from censuskit.llm.common import stash

WIDTH = 10
ROUNDS = 12
CELL = "struct<n: int, x: bigint, h: bigint>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it any number of times in body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of the lines that are not blank."""
    lines = F.filter(F.split(text, "\n"), lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(lines, lambda p: F.xxhash64(p)))


def _check(x: Column) -> Column:
    return F.xxhash64(F.lit(99), x)


def _keyed(x: Column, n: Column, h: Column, width: int) -> Column:
    """A digest with its sign, check value and its cell in each of the three tables."""
    return F.struct(n.alias("n"), x.alias("x"), h.alias("h"), *[(F.pmod(F.xxhash64(F.lit(j), x), F.lit(width)).cast("int") + j * width).alias(f"c{j}") for j in range(3)])


def _in_cell(k: Column, i: Column) -> Column:
    return (k["c0"] == i) | (k["c1"] == i) | (k["c2"] == i)


def _cell(n: Column, x: Column, h: Column) -> Column:
    return F.struct(n.alias("n"), x.alias("x"), h.alias("h")).cast(CELL)


def sketch(digest_array: Column, width: int = WIDTH) -> Column:
    """An array of 3 * width cells."""
    keys = F.transform(digest_array, lambda d: _keyed(d, F.lit(1), _check(d), width))
    empty = _cell(F.lit(0), F.lit(0), F.lit(0))
    add = lambda acc, k: _cell(acc["n"] + 1, acc["x"].bitwiseXOR(k["x"]), acc["h"].bitwiseXOR(k["h"]))
    cells = lambda ks: F.transform(F.sequence(F.lit(0), F.lit(3 * width - 1)), lambda i: F.aggregate(F.filter(ks, lambda k: _in_cell(k, i)), empty, add))
    return let(keys, cells)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: _cell(p["n"] - q["n"], p["x"].bitwiseXOR(q["x"]), p["h"].bitwiseXOR(q["h"])))


def peel(difference: Column, width: int = WIDTH) -> Column:
    """struct(ok, only_a, only_b): the digests of the difference, complete if ok."""
    pure = lambda c: (F.abs(c["n"]) == 1) & (c["h"] == _check(c["x"]))
    remove = lambda acc, k: _cell(acc["n"] - k["n"], acc["x"].bitwiseXOR(k["x"]), acc["h"].bitwiseXOR(k["h"]))

    def turn(state: Column, _: Column) -> Column:
        seen = F.array_distinct(F.transform(F.filter(state["cells"], pure), lambda c: _keyed(c["x"], c["n"], c["h"], width)))
        without = lambda out: F.transform(state["cells"], lambda c, i: F.aggregate(F.filter(out, lambda k: _in_cell(k, i)), c, remove))
        after = lambda out: F.struct(without(out).alias("cells"), F.concat(state["found"], F.transform(out, lambda k: F.struct(k["n"].alias("n"), k["x"].alias("x")))).alias("found"))
        return F.when(F.exists(state["cells"], pure), let(seen, after)).otherwise(state)

    start = F.struct(difference.alias("cells"), F.array().cast("array<struct<n: int, x: bigint>>").alias("found"))
    side = lambda s, n: F.transform(F.filter(s["found"], lambda e: e["n"] == n), lambda e: e["x"])
    finish = lambda s: F.struct(F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["x"] == 0) & (c["h"] == 0)).alias("ok"), side(s, 1).alias("only_a"), side(s, -1).alias("only_b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, finish)


def compare(pairs: DataFrame, keys: list[str], width: int = WIDTH) -> DataFrame:
    """Rows with keys and digest arrays a and b become keys, only_a and only_b, each an array
    of the digests that one side alone has. Failing pairs are retried with larger sketches."""
    done, level = None, 0
    rows = pairs.select(*keys, "a", "b")
    while True:
        tried = stash(rows.withColumn("peeled", peel(subtract(sketch(F.col("a"), width), sketch(F.col("b"), width)), width)), "iblt-peeled")
        good = tried.filter("peeled.ok").select(*keys, "peeled.only_a", "peeled.only_b")
        done = good if done is None else done.unionByName(good)
        failed = tried.filter("not peeled.ok")
        if failed.isEmpty():
            break
        shift = 2 * level % 64
        part = lambda side, q: F.filter(F.col(side), lambda d: F.shiftrightunsigned(d, shift).bitwiseAND(F.lit(3)) == q)
        rows = failed.select(*keys, "a", "b", F.explode(F.array(*map(F.lit, range(4)))).alias("q")).select(*keys, part("a", F.col("q")).alias("a"), part("b", F.col("q")).alias("b"))
        level += 1
    return done.groupBy(*keys).agg(F.flatten(F.collect_list("only_a")).alias("only_a"), F.flatten(F.collect_list("only_b")).alias("only_b"))


def as_string(cells: Column) -> Column:
    """Count, XOR and check of each cell, in hexadecimal; empty cells are left blank."""
    one = lambda c: F.when((c["n"] == 0) & (c["x"] == 0), F.lit("")).otherwise(F.concat_ws(".", F.hex(c["n"].cast("bigint")), F.hex(c["x"]), F.hex(c["h"])))
    return F.array_join(F.transform(cells, one), ",")


def with_next(rows: DataFrame, partitions: int) -> DataFrame:
    """rows (doc_id, h, text) with next_text, the text of the next row by falling (doc_id, h),
    the last row's being the first row's. Rows are dealt to ranges of ids; the rows at the
    ranges' edges (two per range) are joined by themselves."""
    marks = rows.select(F.percentile_approx("doc_id", [i / partitions for i in range(1, partitions)], 10_000) if partitions > 1 else F.array().cast("array<bigint>")).first()[0] or []
    marks = sorted(set(marks))
    step = max(1, int(len(marks) ** 0.5))
    coarse, fine = F.array(*map(F.lit, marks[step - 1 :: step])).cast("array<bigint>"), F.array(*map(F.lit, marks)).cast("array<bigint>")
    below = lambda array: F.size(F.filter(array, lambda m: m < F.col("doc_id")))
    bucket = let(below(coarse), lambda c: c * step + below(F.slice(fine, c * step + 1, step)))
    # rows without an id come last, by falling hash: they are dealt to ranges of the hash, which is even
    nulls = -1 - F.floor((0.5 - F.col("h") / float(1 << 64)) * partitions).cast("int")
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), nulls).otherwise(bucket))
    place = F.struct("doc_id", "h")
    edges = rows.groupBy("bucket").agg(F.max(place).alias("first"), F.min(place).alias("last")).orderBy(F.desc("bucket")).collect()  # one row per range
    order = W.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), F.desc("h"))
    inner = rows.select("doc_id", "h", "text", F.lead("text").over(order).alias("next_text")).filter(F.col("next_text").isNotNull())
    links = [(e.last.doc_id, e.last.h, n.first.doc_id, n.first.h) for e, n in zip(edges, edges[1:] + edges[:1], strict=True)]
    links = rows.sparkSession.createDataFrame(links, "l_id bigint, l_h bigint, f_id bigint, f_h bigint")
    one = rows.select("doc_id", "h", "text")
    last = one.join(F.broadcast(links), one.doc_id.eqNullSafe(F.col("l_id")) & (one.h == F.col("l_h"))).dropDuplicates(["doc_id", "h"])
    first = one.join(F.broadcast(links.select(F.col("f_id").alias("id"), F.col("f_h").alias("fh"))), one.doc_id.eqNullSafe(F.col("id")) & (one.h == F.col("fh"))).dropDuplicates(["doc_id", "h"])
    first = first.select("id", "fh", F.col("text").alias("next_text"))
    outer = last.join(first, last.f_id.eqNullSafe(first.id) & (last.f_h == first.fh)).select("doc_id", "h", "text", "next_text")
    return inner.unionByName(outer)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text has its last half replaced by as much of the
    start of the next document, by falling id."""
    partitions = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    both = with_next(rows, partitions).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half))
    both = both.select("doc_id", "n_chars", "text", "next_text", edited.alias("edited"))
    sets = both.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("edit"), digests(F.col("next_text")).alias("next"),
    )
    sets = stash(sets, "iblt-sets")
    pairs = sets.select("row", F.col("own").alias("a"), F.explode(F.array(F.struct(F.lit("edited").alias("what"), F.col("edit").alias("b")), F.struct(F.lit("next").alias("what"), F.col("next").alias("b")))).alias("o"))
    gaps = compare(pairs.select("row", "o.what", "a", "o.b"), ["row", "what"], width).select("row", "what", (F.size("only_a") + F.size("only_b")).alias("gap"))
    gaps = gaps.groupBy("row").agg(*[F.max(F.when(F.col("what") == w, F.col("gap"))).alias(f"gap_{w}") for w in ("edited", "next")])

    def near(other: str, gap: str) -> Column:
        common = (F.size("own") + F.size(other) - F.col(gap)) / 2.0
        return F.when(F.size("own") + F.size(other) == 0, 1.0).otherwise(common / (common + F.col(gap)))

    return sets.join(gaps, "row").select(
        "doc_id", "n_chars", "edited_sha256", as_string(sketch(F.col("own"), width)).alias("fingerprint"), as_string(sketch(F.col("edit"), width)).alias("edited_fingerprint"),
        near("edit", "gap_edited").alias("near_edited"), near("next", "gap_next").alias("near_next"),
    )
