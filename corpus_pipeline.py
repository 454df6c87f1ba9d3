"""The corpus pipeline: five stages over documents, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
rows with the columns of documents. ORACLE_SQL is None: scoring, n-gram components and
byte-pair encoding have no SQL form, so a brute-force version tests the pipeline.

Rows are told apart by a number that a stage gives them, never by their id: rows without an
id, with an id that others have, or equal in everything take part like all others. The number
is a row's place in its Parquet file, where docs are all rows of such files; other rows are
written with a number first. A stage deletes the tables that led to its list of rows to keep,
so that stages do not add up on disk, and tells all tasks by a bit for each row which rows stay,
so that texts are not shuffled by it. Columns
are passed on as they are, whatever their names; only doc_id, text and source are read. An
empty table gives an empty result in every stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from censuskit.llm import bpe, exact_dedup as dedup, mixing, ngram_join, toxicity
from censuskit.llm.common import brief, crc_mod, documents, stash

ORACLE_SQL = None
#: Lists of rows are sent to all tasks up to this many blocks of 64 rows; beyond it texts are joined by row.
BROADCAST_BLOCKS = 1_000_000


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of docs has, whatever its case: Spark's names are alike in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _files(docs: DataFrame, name: str) -> DataFrame | None:
    """The files of docs, with a number each, if docs have each row of some Parquet files once."""
    try:
        place = docs.metadataColumn("_metadata")
        places = docs.select(place["file_path"].alias("file"), place["row_index"].alias("row"))
        rows = docs.sparkSession.read.parquet(*docs.inputFiles()).count()
    except AnalysisException:
        return None
    files = stash(places.distinct().groupBy("file").agg(F.count(F.lit(1)).alias("rows")), name)
    if not rows == docs.count() == (files.agg(F.sum("rows")).first()[0] or 0):
        return None
    return files.select("file", (F.row_number().over(W.orderBy("file")) - 1).cast("long").alias("number"))


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """docs with a number for each row, the same whenever they are read, and the name of that column."""
    key = _free(docs, "row_number")
    files = _files(docs, name)
    if files is None:
        return stash(docs.withColumn(key, F.monotonically_increasing_id()), name), key
    place, of = docs.metadataColumn("_metadata"), _free(docs, "row_file")
    placed = docs.withColumns({key: place["row_index"], of: place["file_path"]})
    files = F.broadcast(stash(files, name).select(F.col("file").alias(of), F.shiftleft("number", 40).alias(f"{of}_number")))
    return placed.join(files, of).withColumn(key, F.col(key) + F.col(f"{of}_number")).drop(of, f"{of}_number"), key


def _as_often(docs: DataFrame, key: str, taken: DataFrame, name: str, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """docs without key, each row as often as taken (key, times) says, rows that it lacks not at all.
    A block of 64 rows is one number for each binary digit of times; keep writes what is needed later."""
    taken = stash(taken.select("key", F.col("times").cast("int")), name)
    digits = range(int(taken.agg(F.max("times")).first()[0] or 1).bit_length())
    one = F.expr("shiftleft(1L, CAST(key & 63 AS INT))")
    marks = [F.bit_or(F.when(F.getbit("times", F.lit(i)) == 1, one).otherwise(F.lit(0).cast("long"))).alias(f"digit_{i}") for i in digits]
    blocks = keep(taken.groupBy(F.shiftright("key", 6).alias("block")).agg(*marks), name)
    times, block = _free(docs, key + "_times"), _free(docs, key + "_block")
    if blocks.count() > BROADCAST_BLOCKS:
        again = docs.join(keep(taken, name).select(F.col("key").alias(key), F.col("times").alias(times)), key)
    else:
        marked = blocks.select(F.col("block").alias(block), *[F.col(f"digit_{i}").alias(f"{block}_{i}") for i in digits])
        placed = docs.withColumn(block, F.shiftright(key, 6)).join(F.broadcast(marked), block)
        place = F.col(key).bitwiseAND(63).cast("int")
        often = [F.getbit(f"{block}_{i}", place).cast("int") * 2**i for i in digits]
        again = placed.withColumn(times, reduce(add, often)).filter(F.col(times) > 0).drop(block, *[f"{block}_{i}" for i in digits])
    if len(digits) > 1:
        again = again.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return again.drop(key, times)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts toxic go. It learns from the labelled rows that op6
    learns from. Null and empty texts have no evidence and stay unless most labels are toxic;
    texts of any length are read whole; repeated rows go or stay together."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(crc_mod("doc_id", 5) != 0)
    model = toxicity.train(toxicity.with_labels(docs, labels))
    # under other names, so that none clashes with those of the scorer
    inner = {c: {"doc_id": "doc_id", "text": "text"}.get(c, f"column_{i}") for i, c in enumerate(docs.columns)}
    extra = tuple(F.col(f"`{c}`").alias(name) for c, name in inner.items() if c not in ("doc_id", "text"))
    scored = toxicity.evidence_of(docs, model, extra, with_text=True).filter("score < 0.5")
    return scored.select(*[F.col(name).alias(c) for c, name in inner.items()])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, the one that op7 keeps. Null and empty texts
    are one group, as are texts of blanks; of rows that repeat, one stays."""
    docs, key = _numbered(docs, "pipeline-copies")
    with brief(spark) as keep:
        kept = dedup.exact_dedup(docs, key_col=key).filter("kept")
        return _as_often(docs, key, kept.select("key", F.lit(1).alias("times")), "pipeline-copies", keep)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words, a similarity of 0.8: of each group the row with the smallest id stays (rows
    without an id after all others; of equal ids any one, the same in each rerun over the same
    table). Documents without words are in no group and stay."""
    docs, key = _numbered(docs, "pipeline-near")
    with brief(spark) as keep:
        found = stash(ngram_join.ngram_components(docs, n=5, share=80, key_col=key), "pipeline-near")
        first = found.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
        kept = first.select("first.key").unionByName(found.filter("component IS NULL").select("key"))
        return _as_often(docs, key, kept.withColumn("times", F.lit(1)), "pipeline-near", keep)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target weights in whole documents: each row is repeated as often
    as the mix takes its words, to the nearest whole number, and goes if that is 0. Of a source,
    only the document at the end of what is taken is rounded, so the source misses its target
    by half a document at most. Documents without words are taken once; a null source is one."""
    docs, key = _numbered(docs, "pipeline-mix")
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(1).cast("int")
    with brief(spark) as keep:
        taken = mixing.mix_sources(docs, key_col=key).select("key", copies.alias("times")).filter("times > 0")
        return _as_often(docs, key, taken, "pipeline-mix", keep)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and digests of the ids and of what they decode to. Null and empty
    texts have no ids; other columns are not kept."""
    return bpe.encode_documents(docs)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies), ("mixing", mix), ("byte-level BPE", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written to the shared folder and read back."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stash(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
