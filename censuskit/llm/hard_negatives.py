"""Hard-negative mining with inner products by a residue number system.

Components x become floor(256 x). Vectors are dealt into blocks by hash; every block of anchors
meets every block of rows in one task (a stated query set against all rows), never row by row.
A task multiplies the two component matrices modulo several primes below 1024: balanced
residues are at most 511, so that a float32 product over 64 columns is exact, and longer ones
are summed by pieces of 64. Chinese remaindering with balanced mixed-radix digits gives the
exact signed scores; there are as many primes as the largest possible score needs.

1. Each task keeps an anchor's first rows of the same label; a window over all blocks keeps the
   first ``positives`` of them.
2. The matrices are multiplied again. For each positive, its score bounds those of the
   negatives: a task sorts an anchor's other-label scores once, and takes the first
   ``negatives`` below each upper bound. A window over all blocks ranks them.

Matrices are computed anew rather than kept: they are quadratic, what the tasks return is
``positives`` or ``positives * negatives`` rows for an anchor and block at most. Scores and
ties do not depend on how rows are dealt out.

Defined results: rows whose label or vector is null, or whose vector holds a null or a
non-finite entry, take no part. A row without an id is no anchor, its label is not shifted, and
it comes after all other rows of an equal score. Rows that repeat an id are rows of their own:
each is an anchor, and another row may be its positive. Rows of equal score and id are ordered
by their number in the written table. Vectors shorter than others are continued by zeros.
Components are held to what keeps 100 scores within 64 bits (2 ** 25 for 64 dimensions).
An anchor without positives, or with none in range, has no rows. An empty table gives an empty
result. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from censuskit.llm.common import stash

#: Rows and anchors in a block at most (on average), and anchors worked on at a time.
ROWS, ANCHORS, AT_ONCE = 16_384, 4_096, 64
#: Scores stay below this, so that 100 of them fit into 64 bits.
MOST = 1 << 56
#: Columns whose products of residues below 512 add up to less than 2 ** 24.
_COLUMNS = 64


class Residues:
    """Exact integer matrix products for scores up to bound, by primes below 1024."""

    def __init__(self, bound: int) -> None:
        self.primes: list[int] = []
        product = 1
        for m in range(1023, 2, -1):
            if product > 2 * bound + 1:
                break
            if all(m % k for k in range(2, isqrt(m) + 1)):
                self.primes.append(m)
                product *= m

    @staticmethod
    def _balanced(x: np.ndarray, m: int) -> np.ndarray:
        x = x % m
        return x - m * (x > m // 2)

    def of(self, x: np.ndarray) -> list[np.ndarray]:
        """The residues of integers, one float32 matrix for each prime."""
        return [self._balanced(x, m).astype(np.float32) for m in self.primes]

    def scores(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Inner products of the rows of a and b, from their residues."""
        digits: list[np.ndarray] = []
        total, weight = np.zeros((len(a[0]), len(b[0])), np.int64), 1
        for m, p, q in zip(self.primes, a, b, strict=True):
            digit = np.zeros(total.shape, np.int64)
            for k in range(0, p.shape[1], _COLUMNS):
                digit += (p[:, k : k + _COLUMNS] @ q[:, k : k + _COLUMNS].T).astype(np.int32) % m
            for earlier, known in zip(self.primes, digits, strict=False):
                digit = (digit - known) * pow(earlier, -1, m) % m
            digits.append(self._balanced(digit, m))
            total += digits[-1] * weight
            weight *= m
        return total


def _usable(vector: Column) -> Column:
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, sound)


def mined_rows(vectors: DataFrame, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """no, vec_id, label and x (the integer components) of the rows that take part, written."""
    v = F.col(vector_col)
    limit = F.floor(F.sqrt(F.lit(float(MOST)) / F.greatest(F.size(v), F.lit(1)))).cast("double")
    whole = lambda x: F.floor(F.greatest(F.least(256.0 * x.cast("double"), limit), -limit)).cast("int")
    rows = vectors.filter(F.col(label_col).isNotNull() & _usable(v)).select(F.col(id_col).cast("long").alias("vec_id"), (F.col(label_col) if label is None else label).cast("long").alias("label"), F.transform(v, whole).alias("x"))
    return stash(rows.withColumn("no", F.monotonically_increasing_id()), "negatives-rows")


def _matrix(table: pa.Table, d: int) -> np.ndarray:
    column = table.column("x").combine_chunks()
    lengths = column.value_lengths().to_numpy()
    out, flat = np.zeros((len(lengths), d), np.int64), column.flatten().to_numpy()
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    """A column of whole numbers; nulls after all others."""
    return table.column(name).combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy()


def _first(keys: np.ndarray, k: int) -> np.ndarray:
    """The k largest of each row, falling."""
    n = keys.shape[1]
    return np.sort(keys if n <= k else np.partition(keys, n - k, axis=1)[:, n - k :], axis=1)[:, ::-1]


class _Meeting:
    """A block of anchors and a block of rows: keys that order an anchor's scores. A key is the
    score times the number of rows, less the row's place by id, and so tells both; where that
    does not fit into 64 bits, scores are ranked first."""

    def __init__(self, gemm: Residues, anchors: pa.Table, rows: pa.Table, d: int) -> None:
        order = np.lexsort((_numbers(rows, "no"), _numbers(rows, "vec_id")))
        self.rows = rows.take(pa.array(order))
        self.no, self.label, self.gemm = _numbers(self.rows, "no"), _numbers(self.rows, "label"), gemm
        self.anchor_no, self.anchor_label = _numbers(anchors, "no"), _numbers(anchors, "label")
        self.a, self.b = gemm.of(_matrix(anchors, d)), gemm.of(_matrix(self.rows, d))

    def scores(self, some: slice) -> np.ndarray:
        return self.gemm.scores([r[some] for r in self.a], self.b)

    def ranked(self, scores: np.ndarray, wanted: np.ndarray, k: int | None = None) -> list[np.ndarray]:
        """For each anchor, places of the wanted rows by falling score, then place; the first k."""
        n = scores.shape[1]
        if int(np.abs(scores).max(initial=0)) < (1 << 61) // n:
            least = np.iinfo(np.int64).min
            keys = np.where(wanted, scores * n + np.arange(n - 1, -1, -1), least)
            keys = _first(keys, n if k is None else k)
            return [n - 1 - row[row > least] % n for row in keys]
        return [at[np.argsort(-s[at], kind="stable")][:k] for s, w in zip(scores, wanted, strict=True) for at in [np.flatnonzero(w)]]


def _met(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """work on every block of anchors with every block of rows."""
    deal = lambda n: F.pmod(F.xxhash64("no"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select("*", deal(blocks[0]).alias("a_block")).select("*", every(blocks[1]).alias("r_block"))
    right = rows.select("*", deal(blocks[1]).alias("r_block")).select("*", every(blocks[0]).alias("a_block"))
    return left.groupBy("a_block", "r_block").cogroup(right.groupBy("a_block", "r_block")).applyInArrow(work, schema)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """rows: a result of mined_rows. One row per anchor, positive and negative whose score is
    between low and high percent of the positive's, first ones first."""
    spark = rows.sparkSession
    most = F.greatest(F.abs(F.coalesce(F.array_max("x"), F.lit(0))), F.abs(F.coalesce(F.array_min("x"), F.lit(0)))).cast("long")
    n, a, d, x, y = rows.agg(F.count(F.lit(1)), F.count_if(anchor), F.max(F.size("x")), F.max(most), F.max(F.when(anchor, most))).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n or not a:
        return spark.createDataFrame([], out)
    d, bound = max(d, 1), max(d, 1) * (x or 0) * (y or 0)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = ceil(a / ANCHORS), max(ceil(n / ROWS), min(parts, ceil(n / 256)))
    gemm = Residues(bound)
    asked = rows.filter(anchor)

    def best_positives(anchors: pa.Table, held: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], []]
        if anchors.num_rows and held.num_rows:
            m = _Meeting(gemm, anchors, held, d)
            ids = m.rows.column("vec_id").to_pylist()
            for start in range(0, anchors.num_rows, AT_ONCE):
                some = slice(start, start + AT_ONCE)
                scores = m.scores(some)
                wanted = (m.anchor_label[some, None] == m.label) & (m.anchor_no[some, None] != m.no)
                for i, places in enumerate(m.ranked(scores, wanted, positives)):
                    found[0] += [int(m.anchor_no[start + i])] * len(places)
                    found[1] += m.no[places].tolist()
                    found[2] += [ids[p] for p in places]
                    found[3] += scores[i, places].tolist()
        return pa.table([pa.array(c, pa.int64()) for c in found], ["anchor", "other", "id", "score"])

    first = W.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
    close = _met(asked, rows, blocks, best_positives, "anchor long, other long, id long, score long")
    close = close.withColumn("turn", F.row_number().over(first)).filter(F.col("turn") <= positives)
    close = close.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "score"))).alias("close"))
    asked = stash(asked.join(close, F.col("no") == F.col("anchor")).select("no", "vec_id", "label", "x", F.col("close.id").alias("ids"), F.col("close.score").alias("scores")), "negatives-anchors")

    def best_negatives(anchors: pa.Table, held: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], [], [], [], [], []]
        if anchors.num_rows and held.num_rows:
            m = _Meeting(gemm, anchors, held, d)
            ids, own = m.rows.column("vec_id").to_pylist(), anchors.column("vec_id").to_pylist()
            pos_ids, pos_scores = anchors.column("ids").to_pylist(), anchors.column("scores").to_pylist()
            for start in range(0, anchors.num_rows, AT_ONCE):
                some = slice(start, start + AT_ONCE)
                scores = m.scores(some)
                for i, places in enumerate(m.ranked(scores, m.anchor_label[some, None] != m.label)):
                    falling, who = -scores[i, places], start + i
                    for turn, (pos, score) in enumerate(zip(pos_ids[who], pos_scores[who], strict=True)):
                        # 100 * negative <= high * positive, and from low * positive on
                        lo, hi = np.searchsorted(falling, [-(high * score // 100), (-low * score) // 100 + 1])
                        got = places[lo : min(hi, lo + negatives)]
                        for column, values in zip(found, ([int(m.anchor_no[who])], [own[who]], [turn], [pos], [score]), strict=False):
                            column.extend(values * len(got))
                        found[5] += m.no[got].tolist()
                        found[6] += [ids[p] for p in got]
                        found[7] += scores[i, got].tolist()
        return pa.table([pa.array(c, pa.int64()) for c in found], ["anchor", "anchor_id", "turn", "positive_id", "positive_score", "other", "negative_id", "negative_score"])

    hard = _met(asked, rows, blocks, best_negatives, "anchor long, anchor_id long, turn long, positive_id long, positive_score long, other long, negative_id long, negative_score long")
    first = W.partitionBy("anchor", "turn").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "other")
    ranked = hard.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
