"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of labelled text. A text is
cut into chunks and each chunk is encoded once per language with that dictionary; the
language with the smallest total is chosen. Chunks keep long texts from becoming their own
best dictionary. The margin is the share of bytes saved against the second best; narrow
margins are marked as rejected (the choice is still returned).

Learning reads all labelled rows and takes pieces of ``piece_chars`` characters from all
over their texts, chosen by a hash with a share that follows from the language's bytes; a
dictionary is at most ``dict_bytes`` of them. Languages with less text are taken whole, however
little it is. Every language has a dictionary. Prediction reads whole texts.

Defined results: a text that is null or has no letter gets ``und``, score 0, rejected. If
nothing can be learned, every text gets ``und``. With one language learned, it is chosen
with score 1. Ties go to the language with more training rows, then by name. Repeated rows
give equal results. Only id, text and language columns are read; ids pass through exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

LETTER = regex.compile(r"\p{L}")
#: Optimal parsing with three-byte matches separates related languages best (measured on held-out rows).
MIN_MATCH, STRATEGY = 3, zstandard.STRATEGY_BTOPT


def train_dictionaries(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dict_bytes: int = 65_536, piece_chars: int = 256) -> list[tuple[str, bytes]]:
    """(language, dictionary) by falling count; at most dict_bytes for each language."""
    usable = rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).orderBy(F.desc("n"), "lang")
    counts = [r for r in counts.collect() if r.b]
    if not counts:
        return []
    # twice what a dictionary holds is asked for, so that chance does not leave it short
    shares = rows.sparkSession.createDataFrame([(r.lang, min(1.0, 2 * dict_bytes / r.b)) for r in counts], "lang string, share double")
    # the places are chosen before any text is cut
    u = "pmod(xxhash64(6, doc_id, whole, i), 1048576) / 1048576D"
    places = F.expr(f"filter(sequence(0, greatest(cast(ceil(char_length(text) / {piece_chars}) as int) - 1, 0)), i -> {u} < share)")
    chosen = usable.join(F.broadcast(shares), "lang").withColumn("whole", F.xxhash64("text")).withColumn("i", F.explode(places))
    parts: dict[str, list[tuple[int, str]]] = {}
    for r in chosen.select("lang", F.expr("xxhash64(7, doc_id, whole, i)").alias("u"), F.expr(f"substring(text, i * {piece_chars} + 1, {piece_chars})").alias("piece")).collect():
        parts.setdefault(r.lang, []).append((r.u, r.piece))
    out = []
    for r in counts:
        pieces = dict.fromkeys(piece for _, piece in sorted(parts.get(r.lang, [])))
        out.append((r.lang, "\n".join(pieces).lower().encode()[-dict_bytes:]))
    # zstandard takes no dictionary below eight bytes: a shorter one is repeated
    return [(lang, data if len(data) >= 8 else (data + b"\n") * 8) for lang, data in out]


class Identifier:
    def __init__(self, dictionaries: list[tuple[str, bytes]], chunk_chars: int):
        self.langs = [lang for lang, _ in dictionaries]
        self.encoders = []
        for _, data in dictionaries:
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(3, source_size=chunk_chars, dict_size=len(data), min_match=MIN_MATCH, strategy=STRATEGY)
            d.precompute_compress(compression_params=how)
            self.encoders.append(zstandard.ZstdCompressor(compression_params=how, dict_data=d).compress)
        self.chunk = chunk_chars

    def sizes(self, text: str) -> list[int]:
        text = text.lower()
        parts = [text[i : i + self.chunk].encode() for i in range(0, len(text), self.chunk)]
        return [sum([len(encode(p)) for p in parts]) for encode in self.encoders]

    def __call__(self, text: str | None, min_margin: float) -> tuple[str, float, bool]:
        if not text or not self.langs or not LETTER.search(text):
            return "und", 0.0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = [s for i, s in enumerate(sizes) if i != best]
        margin = (min(others) - sizes[best]) / min(others) if others else 1.0
        return self.langs[best], 1.0 - math.exp(-20.0 * margin) if others else 1.0, margin < min_margin


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], id_col: str = "doc_id", text_col: str = "text", extra: tuple[Column, ...] = (), min_margin: float = 0.02, chunk_chars: int = 4096) -> DataFrame:
    """One row per document: doc_id, the extra columns, lang_pred, score, rejected."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), *extra, F.col(text_col).alias("text"))
    kept = [f for f in chosen.schema.fields if f.name != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Identifier(shared.value, chunk_chars)
        for batch in batches:
            found = [model(t.as_py(), min_margin) for t in batch.column("text")]
            named = list(zip(*found, strict=True)) or [(), (), ()]
            columns = [pa.array(v, kind) for v, kind in zip(named, (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *columns], [*[f.name for f in kept], "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return chosen.mapInArrow(work, f"{schema}, lang_pred string, score double, rejected boolean")
