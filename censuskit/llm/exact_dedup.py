"""Exact deduplication by deterministic block naming.

A text without blanks is cut into blocks of a fixed number of bytes. Distinct blocks are
sorted into integer names; then neighbouring names are paired and each distinct pair gets
an integer name of its own, until one name per document is left. Two documents are equal
if and only if they have as many blocks and the same last name, so the identity rests on
comparing bytes (a name is only given to a distinct block or pair) and not on a digest.

Only block bytes are moved once, after a map-side distinct; all later exchanges carry
integers. A name is ``rank in its bucket * buckets + bucket``: ranks are taken inside hash
buckets, so no step needs one task to see all names.

Defined results: null text is the empty text (one empty block). Rows with a null id take
part; they stay only where no row of the group that is as long has an id. Exactly one row of
a group is ``kept``: rows that repeat an id are told apart by a row number (ties in length
and id: by a hash of the text, then by that number), and all count in ``group_size``. An
empty table gives an empty result. Columns other than id and text (and a key to keep) are
never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from censuskit.llm.common import BLANK, stash


def _named(distinct: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """An integer name for each row of distinct keys, by sorting inside hash buckets."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    rank = F.row_number().over(W.partitionBy("bucket").orderBy(*keys)).cast("long") - 1
    return distinct.withColumn("bucket", bucket).withColumn("name", rank * buckets + F.col("bucket")).select(*keys, "name")


def document_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None, block_bytes: int = 4096, buckets: int = 1024) -> DataFrame:
    """One row per input row: row (a number), doc_id, key, text_hash, n_chars, text_sha256, n_blocks
    and name, where (n_blocks, name) is the collision-free identity of the text without blanks."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), (F.col(key_col) if key_col else F.lit(None).cast("long")).alias("key"), F.xxhash64(text).alias("text_hash"), F.char_length(text).cast("long").alias("n_chars"), F.regexp_replace(text, f"{BLANK}+", "").alias("norm"))
    cut = base.withColumn("bytes", F.col("norm").cast("binary")).withColumn(
        "blocks",
        F.expr(f"transform(sequence(0, greatest(cast(ceil(octet_length(bytes) / {block_bytes}) as int) - 1, 0)), i -> substring(bytes, i * {block_bytes} + 1, {block_bytes}))"),
    )
    prints = F.transform("blocks", lambda b: F.struct(F.xxhash64(b).alias("h1"), F.xxhash64(F.lit(7), b).alias("h2")))
    rows = stash(cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "text_hash", "n_chars", F.sha2("norm", 256).alias("text_sha256"), prints.alias("prints")), "exact-rows")

    # Distinct blocks travel once. The two hashes stand in for the bytes afterwards, and only
    # because this aggregate has seen the bytes: a pair of hashes with two blocks is an error.
    blocks = cut.select(F.explode("blocks").alias("block")).select(F.xxhash64("block").alias("h1"), F.xxhash64(F.lit(7), "block").alias("h2"), "block").distinct()
    distinct = (
        blocks.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.when(F.col("n") > 1, F.raise_error(F.lit("two blocks share both hashes: change the seed"))).otherwise(F.lit(True)).cast("boolean"))
        .select("h1", "h2")
    )
    names = _named(distinct, ["h1", "h2"], buckets)
    placed = rows.select("row", F.size("prints").alias("n_blocks"), F.posexplode("prints").alias("pos", "print"))
    placed = placed.select("row", "n_blocks", "pos", F.col("print.h1").alias("h1"), F.col("print.h2").alias("h2"))
    level = stash(placed.join(names, ["h1", "h2"]).select("row", "n_blocks", "pos", "name"), "exact-level")

    longest = rows.agg(F.max(F.size("prints"))).first()[0] or 1
    finished = level.filter("n_blocks = 1")
    width = 1
    while width < longest:
        pairs = (
            level.filter(F.col("n_blocks") > width)
            .groupBy("row", "n_blocks", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"))
        )
        names = _named(pairs.select("left", "right").distinct(), ["left", "right"], buckets)
        level = stash(pairs.join(names, ["left", "right"]).select("row", "n_blocks", "pos", "name"), "exact-level")
        finished = finished.unionByName(level.filter((F.col("n_blocks") > width) & (F.col("n_blocks") <= 2 * width)))
        width *= 2
    return rows.drop("prints").join(finished.select("row", "n_blocks", "name"), "row")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None, block_bytes: int = 4096, buckets: int = 1024) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, key.

    Of equal texts the row with the most code points in its original text stays, then the
    one with the smallest id.
    """
    named = stash(document_names(docs, id_col, text_col, key_col, block_bytes, buckets), "exact-named")
    best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("inverse"), "text_hash", "row")).alias("best")
    # written, so that both sides of the next join are exchanged and a huge group can be split
    groups = stash(named.groupBy("n_blocks", "name").agg(F.count(F.lit(1)).alias("group_size"), best), "exact-groups")
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id", F.bitwise_not("best.inverse").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "key"
    )
