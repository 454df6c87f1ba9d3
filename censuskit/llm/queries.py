"""Registered queries of this subpackage: thin calls of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, functions as F

from censuskit.llm.common import crc_mod, documents, stash

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.licenses import scan_licenses

    return scan_licenses(documents(spark, sf_dir)).drop("detections")


def op2_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.katz import score_documents

    return score_documents(documents(spark, sf_dir), crc_mod("doc_id", 5) == 1)[0]


def op3_iblt_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.iblt import fingerprint_documents

    return fingerprint_documents(documents(spark, sf_dir))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.bpe import encode_documents

    return encode_documents(documents(spark, sf_dir), with_ids=False)


def op5_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.warc_zip import read_archives, write_archives

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = read_archives(stash(write_archives(pages), "warc-zip"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.toxicity import evidence_of, train, with_labels

    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = crc_mod("doc_id", 5) == 0
    learn = with_labels(docs, labels.filter(~held_out))
    scored = evidence_of(docs, train(learn), (held_out.alias("held_out"),))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.language_id import identify, train_dictionaries

    docs = documents(spark, sf_dir)
    held_out = crc_mod("doc_id", 4) == 2
    return identify(docs, train_dictionaries(docs.filter(~held_out)), extra=(held_out.alias("held_out"),))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.exact_dedup import exact_dedup

    return exact_dedup(documents(spark, sf_dir)).drop("key")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.ngram_join import ngram_components

    return ngram_components(documents(spark, sf_dir)).drop("key", "component")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.mixing import mix_sources

    return mix_sources(documents(spark, sf_dir)).drop("key")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.pii import BASE, find_personal_data

    found = find_personal_data(documents(spark, sf_dir))
    base = F.filter("detections", lambda s: s["base"])
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))
    counts = [F.size(F.array_remove(F.transform(base, lambda s: s["kind"] == F.lit(kind)), False)).cast("long").alias(f"n_{kind}") for kind in BASE]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("detections")).alias("spans"))


def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.whitening import whiten

    white = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from censuskit.llm.hard_negatives import mine, mined_rows

    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = mined_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), moved)
    return mine(rows, F.col("vec_id") % 100 == 0)


OP7_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)
"""


OP13_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_sum(list_transform(list_zip(a.x, r.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return import_module("corpus_pipeline").run(spark, sf_dir)


ALL = [
    op1_license_scan, op2_katz_backoff, op3_iblt_fingerprint, op4_byte_bpe, op5_warc_zip, op6_toxicity,
    op7_exact_dedup, op8_language_id, op9_ngram_join, op10_source_mixing,
    op11_personal_data, op12_feast_whitening, op13_hard_negatives, pipeline,
]


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    pipeline_sql = import_module("corpus_pipeline").ORACLE_SQL
    return {"op7_exact_dedup": OP7_SQL, "op13_hard_negatives": OP13_SQL} | ({"pipeline": pipeline_sql} if pipeline_sql else {})
