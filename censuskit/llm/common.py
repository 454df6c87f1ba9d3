"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where none is set in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        path = "file://" + tempfile.mkdtemp(prefix="censuskit-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: The tables written in the innermost brief() block.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: computed once, lineage cut."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def brief(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables stashed in the block are deleted when it ends. What is still needed then has to be
    written by the function that the block gets, a stash() for the surrounding block: later
    work reads that table alone, also where an executor is lost and tasks run again."""
    outer, mine = _made.get(), []
    token = _made.set(mine)

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _made.set(outer)
        try:
            return stash(df, name)
        finally:
            _made.reset(inner)

    try:
        yield keep
    finally:
        _made.reset(token)
        for folder in mine:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column's decimal text, modulo n; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n
