"""Toxicity with noisy-channel deobfuscation.

Writers hide words by look-alike characters (``1d10t``), spacing (``i d i o t``) and
repetition (``idiooot``, ``iiddiioott``). A suspicious token opens a lattice: each observed
character offers the letters it may stand for, and a run of one letter offers one or two of
it. The Viterbi path through the lattice under a character trigram model (counted by a Spark
aggregate over all labelled texts) and the channel costs gives the restored word, whatever
its length. Plain tokens restore to themselves. Where a word begins with punctuation that
may stand for a letter (``!diot``), or a short one ends so, both readings are kept.

Scoring: features are the restored words and their prefixes. Log odds of each feature are
counted over labelled documents by a Spark aggregate; those that pass a significance
threshold form the lexicon. A word's weight is the largest log odds among its features, a
document's evidence the sum over its distinct words, and a logistic curve fitted to the
labelled documents turns evidence into a score.

The lexicon and the curve are learned from at most about ``sample_docs`` labelled rows
(chosen by a hash of the id); the trigrams, bounded by the alphabets in ``LETTERS``, from
all of them. Scoring reads whole texts.

Defined results: null and empty texts have no evidence and get the curve's value at 0. With
no labelled rows, or labels of one class, the lexicon is empty and the score is the share of
toxic labels (0.5 without any). Rows that repeat are scored alike. Only id, text and, for
learning, the label are read; other columns pass through as they are, ids exactly.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# What a character may stand for in obfuscated words.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "*": "aeiou",
}
STRETCH_COST, SWAP_COST = 0.2, 0.5
_ONE = r"(?:[^\W_]|[@$!|+(<€£])"
SPACED = re.compile(rf"(?<!\S){_ONE}(?:[ \t.\-_*]{{1,3}}{_ONE}){{2,}}(?!\S)")
BETWEEN = re.compile(r"[ \t.\-_*]")
EDGE = " \t\n\x0b\x0c\r.,;:!?\"'()[]{}<>|#%&*_~`-+=/\\«»…"
#: Edge characters that may also stand for a letter.
EITHER = "".join(c for c in EDGE if c in LOOKS_LIKE)
INSIDE = re.compile(r"[0-9@$!|+(<€£*]")
STRETCHED = re.compile(r"(.)\1\1")
PREFIXES = (5, 6, 7, 8)
#: Rows that a worker hands back at once.
SLICE_ROWS = 1024
#: Words of the character model: Latin, Greek and Cyrillic letters.
LETTERS = re.compile(r"[a-zß-öø-ɏͰ-ԯ]+")


def trigrams(words: dict[str, int]) -> Counter:
    """Counts of the trigrams of words; ^ starts and $ ends a word."""
    out: Counter = Counter()
    for word, n in words.items():
        padded = "^^" + word + "$"
        for i in range(2, len(padded)):
            out[padded[i - 2 : i + 1]] += n
    return out


class CharModel:
    """Character trigrams with add-k smoothing."""

    def __init__(self, words: dict[str, int], k: float = 0.05):
        self._count(trigrams(words), k)

    @classmethod
    def of_trigrams(cls, counts: dict[str, int], k: float = 0.05) -> CharModel:
        model = cls({}, k)
        model._count(counts, k)
        return model

    def _count(self, counts: dict[str, int], k: float) -> None:
        bi: Counter = Counter()
        for t, n in counts.items():
            bi[t[:2]] += n
        self.k, self.size = k, max(1, len({t[2] for t in counts}))
        self.bi = dict(bi)
        self.cost_of = {t: -math.log((n + k) / (bi[t[:2]] + k * self.size)) for t, n in counts.items()}

    def cost(self, pair: str, c: str) -> float:
        known = self.cost_of.get(pair + c)
        return known if known is not None else -math.log(self.k / (self.bi.get(pair, 0) + self.k * self.size))


def restore(word: str, model: CharModel) -> str:
    """The most likely plain word behind an observed one; linear in its length."""
    runs: list[tuple[str, int]] = []
    for c in word:
        if runs and runs[-1][0] == c:
            runs[-1] = (c, runs[-1][1] + 1)
        else:
            runs.append((c, 1))
    # a state's path is a chain of (piece, path before)
    states: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    for c, n in runs:
        options = [(o, SWAP_COST) for o in LOOKS_LIKE.get(c, "")] if c in LOOKS_LIKE else [(c, 0.0)] if c.isalpha() else [("", SWAP_COST)]
        lengths = [1] if n == 1 else [1, 2]
        following: dict[str, tuple[float, tuple | None]] = {}
        for pair, (cost, path) in states.items():
            for option, swap in options:
                for length in lengths if option else [0]:
                    at, total = pair, cost + swap * n + STRETCH_COST * abs(n - length)
                    for _ in range(length):
                        total += model.cost(at, option)
                        at = at[1] + option
                    best = following.get(at)
                    if best is None or total < best[0]:
                        following[at] = (total, (option * length, path) if length else path)
        states = following
    _, _, path = min((cost + model.cost(pair, "$"), pair, path) for pair, (cost, path) in states.items())
    pieces = []
    while path:
        pieces.append(path[0])
        path = path[1]
    return "".join(reversed(pieces))


def suspicious(word: str) -> bool:
    if (INSIDE.search(word) and any(map(str.isalpha, word))) or STRETCHED.search(word):
        return True
    # most letters doubled
    doubled = sum(a == b for a, b in zip(word, word[1:]))
    return doubled >= 3 and 2 * doubled >= 0.8 * len(word)


def readings(raw: str, model: CharModel | None) -> tuple[str, ...]:
    """The restored words that a token may be."""
    word = raw.strip(EDGE)
    if not model:
        return (word,)
    found = [restore(word, model) if suspicious(word) else word]
    wide = raw.strip("".join(c for c in EDGE if c not in EITHER)) if raw != word else word
    if wide != word and word:
        at = wide.index(word)
        # a longer word shows by its first letters, whatever its last one is
        wide = wide if len(word) < PREFIXES[0] else wide[: at + len(word)]
        if wide != word and any(map(str.isalpha, wide)):
            found.append(restore(wide, model))
    return tuple(found)


def words_of(text: str, model: CharModel | None, known: dict[str, tuple[str, ...]]) -> set[str]:
    """The distinct restored words of a text. known: readings of tokens seen before."""
    low = text.lower()
    out: set[str] = set()
    for raw in set(low.split()):
        words = known.get(raw)
        if words is None:
            words = readings(raw, model)
            if len(known) > 200_000:
                known.clear()
            if len(raw) <= 64:
                known[raw] = words
        out.update(words)
    if model:
        for m in SPACED.finditer(low):
            if any(map(str.isalpha, m[0])):
                out.add(restore(BETWEEN.sub("", m[0]), model))
    out.discard("")
    return out


def features_of(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) >= k)]


@dataclass
class ToxicModel:
    chars: CharModel | None
    weights: dict[str, float]
    slope: float
    offset: float

    def evidence(self, text: str | None, known: dict[str, tuple[str, ...]], weighed: dict[str, float]) -> float:
        if not text:
            return 0.0
        total = 0.0
        for word in words_of(text, self.chars, known):
            w = weighed.get(word)
            if w is None:
                w = max([0.0, *(self.weights.get(f, 0.0) for f in features_of(word))])
                if len(weighed) > 200_000:
                    weighed.clear()
                weighed[word] = w
            total += w
        return total

    def score(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.slope * math.log1p(evidence) + self.offset))))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """One-feature logistic regression by Newton steps, with a small ridge on the slope."""
    w = np.zeros(2)
    rows = np.column_stack([x, np.ones_like(x)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        ridge = np.array([1e-2, 1e-6])
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + np.diag(ridge), rows.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def with_labels(docs: DataFrame, labels: DataFrame, most: int = 1_000_000) -> DataFrame:
    """doc_id, text and toxic of the labelled documents. Up to ``most`` labels are broadcast, so
    that no text is shuffled; beyond that both sides are joined by id."""
    labels = labels.select("doc_id", "toxic")
    return docs.select("doc_id", "text").join(F.broadcast(labels) if labels.count() <= most else labels, "doc_id")


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_docs: int = 20_000, min_surprise: float = 20.0, min_docs: int = 3) -> ToxicModel:
    """Learn from rows with a label of 0 or 1."""
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), F.col(label_col).cast("int").alias("y"))
    counts = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return ToxicModel(None, {}, 0.0, (30.0 if 1 in counts else -30.0) if total else 0.0)
    u = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(u < min(1.0, sample_docs / total)).repartition(max(1, min(total, sample_docs) // 1000), "doc_id")

    def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column("text"):
                seen.update(text.as_py().lower().split())
            plain: Counter = Counter()
            for raw, n in seen.items():
                if LETTERS.fullmatch(word := raw.strip(EDGE)):
                    plain[word] += n
            counts.update(trigrams(plain))
        yield pa.RecordBatch.from_pydict({"trigram": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

    counted = rows.select("text").mapInArrow(count_trigrams, "trigram string, n long").groupBy("trigram").agg(F.sum("n").alias("n"))
    chars = CharModel.of_trigrams({r.trigram: r.n for r in counted.collect()})  # no more than the alphabets allow
    shared = labelled.sparkSession.sparkContext.broadcast(chars)

    def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, ...]] = {}
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("y").to_pylist(), strict=True):
                text = text.as_py()
                (toxic if y else clean).update({f for w in words_of(text, shared.value, known) for f in features_of(w)})
        keys = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_pydict({"feature": pa.array(keys, pa.string()), "a": pa.array([toxic[k] for k in keys], pa.int64()), "b": pa.array([clean[k] for k in keys], pa.int64())})

    n1, n0 = (max(1.0, counts[k] * min(1.0, sample_docs / total)) for k in (1, 0))
    a, b = F.col("a"), F.col("b")
    odds = F.log((a + 0.5) / F.lit(n1 + 1.0)) - F.log((b + 0.5) / F.lit(n0 + 1.0))
    # log-likelihood ratio of the 2 x 2 table of the feature and the label
    part = lambda n, row, column: F.when(n > 0, n * F.log(n * (n1 + n0) / (row * column))).otherwise(0.0)
    with_, without = a + b, F.greatest(F.lit(n1 + n0) - a - b, F.lit(0.5))
    surprise = 2 * (part(a, with_, n1) + part(b, with_, n0) + part(n1 - a, without, n1) + part(n0 - b, without, n0))
    features = (
        sample.mapInArrow(count_features, "feature string, a long, b long")
        .groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .filter(a >= min_docs).withColumn("odds", odds).withColumn("surprise", surprise).filter((F.col("odds") > 0) & (F.col("surprise") >= min_surprise))
    )
    model = ToxicModel(chars, {r.feature: r.odds for r in features.collect()}, 1.0, 0.0)
    scored = evidence_of(sample, model, (F.col("y"),)).select("evidence", "y").toPandas()
    model.slope, model.offset = _logistic(np.log1p(scored.evidence.to_numpy()), scored.y.to_numpy().astype(float))
    return model


def evidence_of(docs: DataFrame, model: ToxicModel, extra: tuple[Column, ...] = (), id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, the extra columns, the text (with_text), evidence and score of every row."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), *extra, F.col(text_col).alias("text"))
    kept = [f for f in chosen.schema.fields if f.name != "text" or with_text]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known, weighed = shared.value, {}, {}
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found = [m.evidence(t, known, weighed) for t in part.column("text").to_pylist()]
                columns = [part.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64()), pa.array([m.score(e) for e in found], pa.float64())], [*[f.name for f in kept], "evidence", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return chosen.mapInArrow(work, f"{schema}, evidence double, score double")
