"""Katz backoff language model over words, kept in partitioned tables.

Model of order n: P(w | u) = keep(u) d(c) c(u, w) / c(u) for every n-gram that training has,
with Katz's Good-Turing discounts d(c) for counts c up to ``K``; otherwise alpha(u) times
P(w | u without its first word), and so on down to single words, of which the discounted
share is the unknown word's. alpha(u) = (1 - sum of the n-grams' P(w | u)) / (1 - sum of
their P(w | shorter u)) makes the sum over the vocabulary and the unknown word exactly 1.
keep(u) is 1, but c(u) / (c(u) + 1) where all of a context's counts are above K: nothing
is discounted there, and no probability would be left for other words. A text is a start,
its words, an end. Every count is kept.

As jobs: texts become batches of word places (a compressed row each, in a written table).
From each batch come its distinct words, dealt by hash to parts as packed arrays: a frequent
word is sent once per batch. A part counts them by their bytes, numbers those that training
has, writes its table and answers each batch with numbers and counts. The distinct n-grams
(number of the context, number of the word) follow, order by order, dealt by context: so a
part has whole contexts, sums what alpha needs, and answers with counts, numbers, and these
sums where a batch has an unseen word after a known context. Answers and places meet again
by batch, where each token is evaluated recursively. The number of parts follows from the
bytes of the input. Nothing of a size that follows the corpus passes through the driver; it
sees totals and counts of counts.

Words are compared by their bytes; n-grams are keyed by numbers that belong to one word or
context each. Only inside one batch are words told apart by 64-bit hashes (and lengths).

Defined results: null and empty texts are one token, the end. Without training rows every
word is unknown with probability 1. Repeated rows are scored and, for training, counted
each; ids are exact beside nulls. Extra columns are never read. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from censuskit.llm.common import stash
from censuskit.llm.ngram_join import _CHUNK, WordHasher, _mix

K = 5
#: Numbers of the unknown word, the start and the end; words and n-grams are numbered from FIRST.
UNKNOWN, START, END, FIRST = 0, 1, 2, 3
TEXT_PART = -1


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string: numbers in as few bytes as they need, byte by byte."""
    out = []
    for a in arrays:
        if a.dtype.kind == "b":
            a = a.astype("u1")
        if a.dtype.kind in "iu":
            most = int(a.max()) if len(a) else 0
            a = a.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if most < 1 << 8 * int(t[2])))
        out += [f"{a.dtype.str} {len(a)}\n".encode(), np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()]
    return zstandard.compress(b"".join(out), 1)


def unpack(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(blob), 0, []
    while at < len(data):
        end = data.index(b"\n", at)
        kind, n = data[at:end].split()
        kind, n = np.dtype(kind.decode()), int(n)
        at, end = end + 1, end + 1 + n * kind.itemsize
        a = np.ascontiguousarray(np.frombuffer(data[at:end], np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()
        out.append(a.astype(np.int64) if kind.kind == "u" else a)
        at = end
    return out


def discounts(n: dict[int, int]) -> dict[int, float]:
    """Katz's discount for counts up to K from counts of counts, above 0 and below 1; absolute
    discounting where the counts of counts are too thin for Good-Turing."""
    n1, out = n.get(1, 0), {}
    tail = (K + 1) * n.get(K + 1, 0) / n1 if n1 else 1.0
    for c in range(1, K + 1):
        turing = (c + 1) * n.get(c + 1, 0) / (c * n[c]) if n.get(c) else 0.0
        d = (turing - tail) / (1 - tail) if tail < 1 else 0.0
        out[c] = d if 0 < d < 1 else 1 - (n1 / (n1 + 2 * n[2]) if n1 and n.get(2) else 0.5) / c
    return out


@dataclass
class Totals:
    """All that the driver learns."""

    parts: int = 1
    tokens: int = 0
    types: int = 0
    docs: int = 0
    #: by order, from 1: the discounts
    d: dict[int, dict[int, float]] = field(default_factory=dict)
    unknown: float = 1.0
    word_keep: float = 1.0

    @property
    def word_d(self) -> dict[int, float]:
        return self.d[1]

    @property
    def pair_d(self) -> dict[int, float]:
        return self.d[2]

    def discounted(self, order: int, c: np.ndarray) -> np.ndarray:
        table = np.array([0.0] + [self.d[order][i] * i for i in range(1, K + 1)])
        return np.where(c <= K, table[np.minimum(c, K)], c)

    def p_word(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discounted(1, c) * self.word_keep / max(self.tokens, 1), self.unknown)

    def p_seen(self, order: int, c: np.ndarray, total: np.ndarray, keep: np.ndarray) -> np.ndarray:
        """P of a seen n-gram; keep: whether its context keeps something back."""
        return self.discounted(order, c) / np.maximum(np.where(keep, total + 1, total), 1)


# ---- words


def _tokenise(docs: DataFrame, batch_bytes: int, parts: int) -> DataFrame:
    """A row of part -1 for each batch, with its texts as places in the list of its distinct
    words; and a row for each part that has some of these words, with their training counts."""
    names = ["batch", "part", "texts", "places", "words", "counts"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rng = WordHasher(), np.random.default_rng()
        ids, held, texts, size = [], [], [], 0

        def rows() -> pa.RecordBatch:
            joined, hashes, lengths, starts, stops, base, at = b" ".join(texts), [], [], [], [], 0, 0
            while at < len(texts):
                stop, taken = at, 0
                while stop < len(texts) and (stop == at or taken + len(texts[stop]) < _CHUNK):
                    taken += len(texts[stop])
                    stop += 1
                h, bounds, a, b = hasher.spans(texts[at:stop])
                hashes, lengths, starts, stops = [*hashes, h], [*lengths, np.diff(bounds)], [*starts, a + base], [*stops, b + base]
                base += taken + stop - at
                at = stop
            hashes, lengths, starts, stops = map(np.concatenate, (hashes, lengths, starts, stops))
            keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            long = stops - starts
            if np.any(long != long[first][inverse]):
                raise ValueError("two words of a batch share a hash: change the constants")
            part = (keys % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            place = np.empty(len(keys), np.int64)
            place[order] = np.arange(len(keys))
            place = place[inverse]
            train = np.repeat(~np.array(held, bool), lengths)
            counts = np.bincount(place, weights=train, minlength=len(keys)).astype(np.int64)
            borders = np.searchsorted(part[order], np.arange(parts + 1))
            words = [joined[a:b] for a, b in zip(starts[first[order]].tolist(), stops[first[order]].tolist(), strict=True)]
            key = int.from_bytes(rng.bytes(7), "little")  # any key will do, it is written with the row
            numbers = np.array([i or 0 for i in ids], np.int64)
            head = pack(numbers.view("<u8"), np.array([i is None for i in ids]), np.array(held, bool), lengths)
            out = [(key, TEXT_PART, head, pack(place), None, None)]
            out += [(key, p, None, None, zstandard.compress(b" ".join(words[s:e]), 3), pack(counts[s:e])) for p, (s, e) in enumerate(zip(borders[:-1], borders[1:], strict=True)) if e > s]
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), *[pa.binary()] * 4), strict=True)], names)

        with np.errstate(over="ignore"):
            for b in batches:
                for i in range(b.num_rows):
                    data = (b.column("text")[i].as_py() or "").encode().lower()
                    if texts and size + len(data) > batch_bytes:
                        yield rows()
                        ids, held, texts, size = [], [], [], 0
                    ids.append(b.column("doc_id")[i].as_py())
                    held.append(b.column("held")[i].as_py())
                    texts.append(data)
                    size += len(data)
            if texts:
                yield rows()

    return docs.mapInArrow(work, "batch long, part int, texts binary, places binary, words binary, counts binary")


COUNTED = "kind string, batch long, part int, data binary, sums array<long>"


def _counted(part: int, table: bytes, sums: list[int], answers: list[tuple[int, bytes]]) -> pd.DataFrame:
    rows = [("table", 0, part, table, []), ("sums", 0, part, b"", sums), *[("answer", batch, part, data, []) for batch, data in answers]]
    return pd.DataFrame(rows, columns=["kind", "batch", "part", "data", "sums"])


def _sums(c: np.ndarray) -> list[int]:
    """How many, their sum, and counts of counts up to K + 1."""
    return [len(c), int(c.sum()), *np.bincount(c[c <= K + 1], minlength=K + 2)[1:].tolist()]


def _count_words(rows: DataFrame, parts: int) -> DataFrame:
    """The part's table (words and counts, in the order of their numbers), sums, and answers: the
    number and count of each word asked for."""

    def count(group: pd.DataFrame) -> pd.DataFrame:
        part, total = int(group.part.iloc[0]), {}
        asked = [zstandard.decompress(w).split(b" ") for w in group.words]
        for words, counts in zip(asked, group["counts"], strict=True):
            for w, n in zip(words, unpack(counts)[0].tolist(), strict=True):
                total[w] = total.get(w, 0) + n
        known = sorted((w for w, n in total.items() if n), key=lambda w: (-total[w], w))
        number = {w: FIRST + rank * parts + part for rank, w in enumerate(known)}
        answers = [(int(batch), pack(np.array([number.get(w, UNKNOWN) for w in words]), np.array([total[w] for w in words]))) for batch, words in zip(group.batch, asked, strict=True)]
        c = np.array([total[w] for w in known], np.int64)
        return _counted(part, pack(np.frombuffer(b" ".join(known), np.uint8), c), _sums(c), answers)

    return rows.groupBy("part").applyInPandas(count, COUNTED)


# ---- n-grams


class Batch:
    """The tokens of a batch, and what is known of their n-grams, order by order."""

    def __init__(self, texts: bytes, places: bytes, answers: pd.DataFrame, totals: Totals):
        numbers, nulls, held, lengths = unpack(texts)
        self.ids, self.nulls, self.held, self.t = numbers.view(np.int64), nulls.astype(bool), held.astype(bool), totals
        self.by = {(order, part): data for order, part, data in zip(answers["order"], answers.part, answers.data, strict=True)}
        words = [unpack(self.by[1, p]) for p in range(totals.parts) if (1, p) in self.by]
        number, count = (np.concatenate([*[w[i] for w in words], [last]]).astype(np.int64) for i, last in ((0, END if totals.docs else UNKNOWN), (1, totals.docs)))
        # the end stands behind the words of each text
        place = np.insert(unpack(places)[0], np.cumsum(lengths), len(number) - 1)
        self.lengths = lengths + 1
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat(~self.held, self.lengths)
        self.place, self.n_places, self.word = place, len(number), number[place]
        # of the last order: each token's count, its number, its index among the distinct ones,
        # the count of its context, and whether that keeps something back
        self.order = 1
        self.count, self.number, self.index, self.n_index = count[place], self.word, place, self.n_places
        self.total, self.keep = np.full(len(place), totals.tokens), np.zeros(len(place), bool)

    def _before(self, a: np.ndarray, first: int) -> np.ndarray:
        out = np.concatenate([[first], a[:-1]])[: len(a)]
        out[self.begins] = first
        return out

    def ask(self) -> None:
        """The distinct n-grams of the next order, dealt by context."""
        start = self.order == 1
        self.context = self._before(self.number, START if start else UNKNOWN)
        self.next_total = self._before(self.count, self.t.docs if start else 0)
        index = self._before(self.index, self.n_index)
        self.asked = np.flatnonzero(self.context != UNKNOWN)
        _, first, self.inverse = np.unique(index[self.asked] * self.n_places + self.place[self.asked], return_index=True, return_inverse=True)
        at = self.asked[first]
        part = (_mix(self.context[at].astype(np.uint64)) % np.uint64(self.t.parts)).astype(np.uint16 if self.t.parts < 1 << 16 else np.int64)
        order = np.argsort(self.context[at], kind="stable")
        order = order[np.argsort(part[order], kind="stable")]
        self.at, part = at[order], part[order]
        self.spot = np.empty(len(order), np.int64)
        self.spot[order] = np.arange(len(order))
        self.borders = np.searchsorted(part, np.arange(self.t.parts + 1))

    def _firsts(self, s: int, e: int) -> np.ndarray:
        c = self.context[self.at[s:e]]
        return np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))

    def messages(self) -> Iterator[tuple[int, bytes]]:
        n = np.bincount(self.spot[self.inverse], weights=self.train[self.asked], minlength=len(self.at)).astype(np.int64)
        for part, (s, e) in enumerate(zip(self.borders[:-1], self.borders[1:], strict=True)):
            if e > s:
                at, firsts = self.at[s:e], self._firsts(s, e)
                runs, one = np.diff(np.append(firsts, e - s)), at[firsts]
                yield part, pack(np.diff(self.context[one], prepend=0), runs, self.word[at], n[s:e], self.count[at], self.total[one], self.keep[one])

    def learn(self) -> np.ndarray:
        """Take in the answers for the n-grams asked for; log10 alpha of each token that needs it,
        else 0."""
        order, size = self.order + 1, len(self.at)
        count, number, keep, log_alpha = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool), np.zeros(size)
        for part, (s, e) in enumerate(zip(self.borders[:-1], self.borders[1:], strict=True)):
            if e == s:
                continue
            c, numbers, kept, open_, lower, *n = unpack(self.by[order, part])
            firsts = self._firsts(s, e)
            runs = np.diff(np.append(firsts, e - s))
            count[s:e], keep[s:e] = c, np.repeat(kept.astype(bool), runs)
            number[s:e] = numbers if len(numbers) else 0
            if len(open_):
                total = self.next_total[self.at[s:e][firsts[open_]]]
                mass = total - sum(i * m for i, m in enumerate(n, 1)) + sum(i * m * self.t.d[order][i] for i, m in enumerate(n, 1))
                free = 1 - mass / np.where(kept[open_] > 0, total + 1, total)
                alpha = np.zeros(len(firsts))
                alpha[open_] = np.log10(free / (1 - lower))
                log_alpha[s:e] = np.where(c == 0, np.repeat(alpha, runs), 0.0)
        spot = self.spot[self.inverse]
        spread = lambda a, fill: self._spread(a[spot], fill)
        self.count, self.number, self.keep, self.total = spread(count, 0), spread(number, UNKNOWN), spread(keep, False), self.next_total
        self.index, self.n_index, self.order = spread(np.arange(size), 0), size, order
        return spread(log_alpha, 0.0)

    def _spread(self, of_asked: np.ndarray, fill) -> np.ndarray:
        out = np.full(len(self.place), fill, of_asked.dtype)
        out[self.asked] = of_asked
        return out


def _batch(rows: pd.DataFrame, answers: pd.DataFrame, totals: Totals) -> Batch:
    return Batch(rows.texts.iloc[0], rows.places.iloc[0], answers, totals)


def _ask(texts: DataFrame, answers: DataFrame, totals: Totals, order: int) -> DataFrame:
    """What each batch asks the parts about n-grams of this order: batch, part, data."""

    def ask(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["batch", "part", "data"])
        with np.errstate(over="ignore", divide="ignore"):
            b = _batch(rows, got, totals)
            while True:
                b.ask()
                if b.order + 1 == order:
                    break
                b.learn()
            return pd.DataFrame([(rows.batch.iloc[0], part, data) for part, data in b.messages()], columns=["batch", "part", "data"])

    return texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(ask, "batch long, part int, data binary")


def _count_grams(asked: DataFrame, totals: Totals, order: int, last: bool) -> DataFrame:
    """The part's table (contexts, how many n-grams each has, words, counts), sums, and answers."""

    def count(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group.part.iloc[0])
        got = [unpack(d) for d in group.data]
        contexts, runs, total_low, keep_low = ([g[i] for g in got] for i in (0, 1, 5, 6))
        contexts, runs = [np.cumsum(c) for c in contexts], [r.astype(np.int64) for r in runs]
        w, n, low = (np.concatenate([g[i] for g in got]) for i in (2, 3, 4))
        ends = np.cumsum([0, *[int(r.sum()) for r in runs]])
        distinct, where = np.unique(np.concatenate(contexts), return_inverse=True)
        of_row = np.repeat(where, np.concatenate(runs))
        width = int(w.max()) + 1
        if len(distinct) * width >= 1 << 63:
            raise ValueError("a part has too many n-grams: raise the number of parts")
        keys, first, inverse = np.unique(of_row * width + w, return_index=True, return_inverse=True)
        c = np.bincount(inverse, weights=n).astype(np.int64)
        context, seen = keys // width, c > 0
        # of each context: its sums, and what the shorter contexts give to the words seen after it
        size = len(distinct)
        n_of = [np.bincount(context[c == i], minlength=size) for i in range(1, K + 1)]
        total = np.bincount(context, weights=c, minlength=size).astype(np.int64)
        kept = (total > 0) & (sum(n_of) == 0)
        one = np.empty(size, np.int64)
        one[where] = np.arange(len(where))
        total_low, keep_low = np.concatenate(total_low)[one][context], np.concatenate(keep_low)[one][context]
        p = totals.p_word(low[first]) if order == 2 else totals.p_seen(order - 1, low[first], total_low, keep_low > 0)
        lower = np.bincount(context, weights=np.where(seen, p, 0.0), minlength=size)
        number = np.zeros(0 if last else len(keys), np.int64)
        if not last:
            number[seen] = FIRST + np.arange(seen.sum()) * totals.parts + part
        answers, at = [], 0
        for batch, r, s, e in zip(group.batch, runs, ends[:-1], ends[1:], strict=True):
            mine, here = where[at : at + len(r)], inverse[s:e]
            at += len(r)
            least = np.minimum.reduceat(c[here], np.cumsum(r) - r)
            open_ = np.flatnonzero((least == 0) & (total[mine] > 0))
            of = mine[open_]
            answers.append((int(batch), pack(c[here], number[here] if len(number) else number, kept[mine], open_, lower[of], *[m[of] for m in n_of])))
        table = pack(np.diff(distinct, prepend=0), np.bincount(context[seen], minlength=size), keys[seen] % width, c[seen])
        return _counted(part, table, _sums(c[seen]), answers)

    return asked.groupBy("part").applyInPandas(count, COUNTED)


def _scores(texts: DataFrame, answers: DataFrame, totals: Totals, order: int) -> DataFrame:
    def score(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        if not len(rows):
            return pd.DataFrame(columns=names)
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            b = _batch(rows, got, totals)
            c = b.count
            p = np.log10(totals.p_word(c))
            for n in range(2, order + 1):
                b.ask()
                log_alpha = b.learn()
                p = np.where(b.count > 0, np.log10(totals.p_seen(n, b.count, b.total, b.keep)), p + log_alpha)
            base = np.log10((c + 0.5) / (totals.tokens + 0.5 * (totals.types + 1)))
            sums = lambda x: np.add.reduceat(x, b.begins)
            ids = pd.arrays.IntegerArray(b.ids.copy(), b.nulls)
            return pd.DataFrame(dict(zip(names, (ids, b.held, b.lengths, sums((c > 0).astype(np.int64)), sums(base), sums(p)), strict=True)))

    return texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


@dataclass
class KatzModel:
    """The model's tables, packed by part, and its totals."""

    word_table: DataFrame
    gram_tables: dict[int, DataFrame]
    totals: Totals

    @property
    def words(self) -> DataFrame:
        """number, word, c."""
        parts = self.totals.parts

        def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for part, data in zip(f.part, f.data, strict=True):
                    words, c = unpack(data)
                    words = words.astype(np.uint8).tobytes().decode().split(" ") if len(c) else []
                    yield pd.DataFrame({"number": FIRST + np.arange(len(c)) * parts + part, "word": words, "c": c})

        return self.word_table.mapInPandas(work, "number long, word string, c long")

    def grams(self, order: int) -> DataFrame:
        """u (the context's number), w (the word's), c."""

        def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for data in f.data:
                    contexts, runs, w, c = unpack(data)
                    u = np.repeat(np.cumsum(contexts), runs)
                    for s in range(0, len(w), 1 << 16):
                        yield pd.DataFrame({"u": u[s : s + (1 << 16)], "w": w[s : s + (1 << 16)], "c": c[s : s + (1 << 16)]})

        return self.gram_tables[order].mapInPandas(work, "u long, w long, c long")

    @property
    def pairs(self) -> DataFrame:
        return self.grams(2)


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2, batch_bytes: int = 8 << 20, part_bytes: int = 16 << 20) -> tuple[DataFrame, KatzModel]:
    """Rows doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; and the model
    of the given order learned from the rows that are not held out."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    found = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count_if(~F.col("held")).alias("docs")).first()
    totals = Totals(docs=int(found.docs), parts=max(1, math.ceil((found.bytes or 0) / part_bytes)))
    rows = stash(_tokenise(docs, batch_bytes, totals.parts), "katz-batches")
    texts = rows.filter(F.col("part") == TEXT_PART).select("batch", "texts", "places")

    def sums(counted: DataFrame) -> list[int]:
        got = counted.filter("kind = 'sums'").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"n{i}") for i in range(K + 3)]).first()
        return [int(x or 0) for x in got]

    def of_order(counted: DataFrame, n: int) -> DataFrame:
        return counted.filter("kind = 'answer'").select("batch", F.lit(n).alias("order"), "part", "data")

    words = stash(_count_words(rows.filter(F.col("part") != TEXT_PART).select("batch", "part", "words", "counts"), totals.parts), "katz-words")
    types, tokens, *n = sums(words)
    # the end is a word as well
    totals.types, totals.tokens = types + (totals.docs > 0), tokens + totals.docs
    if 0 < totals.docs <= K + 1:
        n[totals.docs - 1] += 1
    totals.d[1] = discounts(dict(enumerate(n, 1)))
    if totals.tokens:
        freed = sum(n[c - 1] * c * (1 - d) for c, d in totals.d[1].items()) / totals.tokens
        totals.unknown = max(freed, 1 / (totals.tokens + 1))
        totals.word_keep = (1 - totals.unknown) / (1 - freed)

    # every batch gets an answer, also one without words
    answers, tables = texts.select("batch", F.lit(0).alias("order"), F.lit(0).alias("part"), F.lit(b"").alias("data")).unionByName(of_order(words, 1)), {}
    for level in range(2, order + 1):
        counted = stash(_count_grams(_ask(texts, answers, totals, level), totals, level, level == order), f"katz-grams-{level}")
        totals.d[level] = discounts(dict(enumerate(sums(counted)[2:], 1)))
        answers, tables[level] = answers.unionByName(of_order(counted, level)), counted.filter("kind = 'table'").select("part", "data")
    scored = _scores(texts, answers, totals, order)
    out = scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")
    return out, KatzModel(words.filter("kind = 'table'").select("part", "data"), tables, totals)
