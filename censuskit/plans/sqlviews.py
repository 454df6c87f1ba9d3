"""SQL over temporary views of the proxies, with the same text for Spark and DuckDB.

Two spellings differ between them and are written as macros: DD(a, b), the days from a to
b, and DADD(a, n), a plus n days.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from censuskit.plans import proxies
from censuskit.plans.registry import register
from censuskit.sources.tables import table

TABLES = "region nation customer supplier part orders lineitem events documents labels conversations embeddings".split()
VIEWS = {"ev": proxies.events, "sp": proxies.spine, "pr": proxies.predictions, "tr": proxies.transfers}
CTES = {"ev": proxies.EV, "sp": proxies.SP, "pr": proxies.PR, "tr": proxies.TR}
NEEDS = {"sp": ["ev"]}


def used(text: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b(?:FROM|JOIN|,)\s+{n}\b", text, re.I)]


def spark_text(text: str) -> str:
    text = re.sub(r"\bDD\(([^,()]+),\s*([^,()]+)\)", r"datediff(\2, \1)", text)
    return re.sub(r"\bDADD\(([^,()]+),\s*([^,()]+)\)", r"date_add(\1, CAST(\2 AS INT))", text)


def duck_text(text: str) -> str:
    text = re.sub(r"\bDD\(([^,()]+),\s*([^,()]+)\)", r"CAST(date_diff('day', \1, \2) AS INT)", text)
    text = re.sub(r"\bDADD\(([^,()]+),\s*([^,()]+)\)", r"CAST(\1 + CAST(\2 AS INT) AS DATE)", text)
    names = used(text, CTES)
    names = list(dict.fromkeys([m for n in names for m in [*NEEDS.get(n, []), n]]))
    heads = ", ".join(CTES[n] for n in names)
    if not heads:
        return text
    body = text.strip()
    return f"WITH {heads}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {heads} {body}"


def run(spark: SparkSession, d: str, text: str) -> DataFrame:
    for name in used(text, TABLES):
        table(spark, d, name).createOrReplaceTempView(name)
    for name in used(text, VIEWS):
        VIEWS[name](spark, d).createOrReplaceTempView(name)
    return spark.sql(spark_text(text))


def sql_query(key: str, text: str, oracle: str | None = None) -> None:
    """Register a query whose text is the same for both, or with a DuckDB text of its own."""
    fn = lambda spark, d: run(spark, d, text)
    fn.__name__, fn.__doc__ = key, text
    register(key, duck_text(oracle or text))(fn)
