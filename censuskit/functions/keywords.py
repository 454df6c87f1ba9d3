"""A table of phrases, counted by label in one pass over each text.

The phrases make one automaton (a trie with failure links) that is broadcast once and finds all
of them, overlapping ones too, while it reads a text once. A phrase counts where it stands
between borders of words, unless one of the last words before it, in the same sentence, is a
cue of negation.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce
from math import ceil

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: A phrase after one of these does not count.
NEGATIONS = ("no", "not", "by")
#: Phrases of one automaton; more of them are dealt to several, each of which reads the texts.
MOST = 1_000_000
_WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


def automaton(phrases: Sequence[tuple[str, str]]) -> ahocorasick.Automaton:
    """phrases: phrase and label; a phrase may have several labels."""
    labels: dict[str, list[str]] = {}
    for phrase, label in phrases:
        labels.setdefault(phrase.lower(), []).append(label)
    out = ahocorasick.Automaton()
    for phrase, its in labels.items():
        out.add_word(phrase, (len(phrase), tuple(dict.fromkeys(its))))
    out.make_automaton()
    return out


def negated(low: str, start: int, cue: re.Pattern, window: int) -> bool:
    """Whether a cue is among the last words before start that only blanks separate."""
    reach = 0
    at = start
    while reach < window and at and low[at - 1] == " ":
        end = at
        while end and low[end - 1] == " ":
            end -= 1
        begin = end
        while begin and low[begin - 1] in _WORD:
            begin -= 1
        if begin == end:
            return False
        if cue.fullmatch(low, begin, end):
            return True
        at, reach = begin, reach + 1
    return False


def count_labels(low: str, found: ahocorasick.Automaton, cue: re.Pattern, window: int) -> Counter:
    """Places of the phrases in a lower-case text, by label."""
    out: Counter = Counter()
    for last, (length, labels) in found.iter(low):
        start = last + 1 - length
        if (start and low[start - 1] in _WORD and low[start] in _WORD) or (last + 1 < len(low) and low[last + 1] in _WORD and low[last] in _WORD):
            continue
        if not negated(low, start, cue, window):
            out.update(labels)
    return out


def keyword_counts(df: DataFrame, text: str, keywords: DataFrame, cues: Sequence[str] = NEGATIONS, window: int = 3) -> DataFrame:
    """df with counts, a map of labels to the places of their phrases (labels with none are left
    out). keywords: phrase, label; empty and null phrases are none. Null texts have no places."""
    sound = keywords.select("phrase", "label").filter("phrase <> '' AND label IS NOT NULL").distinct()
    parts = max(1, ceil(sound.count() / MOST))
    cue = re.compile("|".join(map(re.escape, cues)) or r"(?!)")
    schema, out = df.schema, df
    plain = [F.col(f"`{c}`") for c in schema.names]

    def counted(some: DataFrame, name: str) -> DataFrame:
        rows = [(r.phrase, r.label) for r in some.collect()]
        shared = df.sparkSession.sparkContext.broadcast(automaton(rows) if rows else None)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                maps = [list(count_labels(t, shared.value, cue, window).items()) if t and shared.value is not None else [] for t in batch.column("low_").to_pylist()]
                keep = [batch.column(c) for c in batch.schema.names if c != "low_"]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(maps, pa.map_(pa.string(), pa.int64()))], [*[c for c in batch.schema.names if c != "low_"], name])

        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
        return out.withColumn("low_", F.lower(F.col(f"`{text}`"))).mapInArrow(work, f"{names}, `{name}` map<string, bigint>")

    names = [f"counts_{i}" for i in range(parts)]
    for i, name in enumerate(names):
        out = counted(sound.filter(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == i), name)
    add = lambda a, b: F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    return out.select(*plain, reduce(add, map(F.col, names)).alias("counts"))


def label_count(counts: str, label: Column | str) -> Column:
    return F.coalesce(F.try_element_at(F.col(counts), F.lit(label) if isinstance(label, str) else label), F.lit(0))
