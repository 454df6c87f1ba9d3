"""N-gram Jaccard join with a token-group matrix.

A document is the set of its word n-grams (tokens, as 64-bit hashes). Two documents link
when ``share`` percent of their union is shared. The join finds every link class exactly:

1. Documents with equal sets form a class and are one node from here on.
2. Only tokens that two nodes hold matter. A node keeps those of a fixed quarter of the hash
   range (its sure tokens: whoever else holds one keeps it too) and, where they are few, its
   first tokens by hash, as many as a link can miss and one.
3. Nodes are partitioned into groups: a node is in the group of its smallest shared token
   (by another hash, so that similar nodes meet) and its band of sizes. The token-group
   matrix has a row for each token of a group's union. The first round asks it for the
   largest group of each of a query's rarest tokens, and compares the query with the leaders
   of the groups that share most: a leader is the node whose tokens are most widely held on
   average, the original of its copies. Most of a large class is linked by its leaders.
4. The smaller node of a pair is the query. A query of n tokens can miss at most n - o in a
   partner, where o is the common number that a link with a partner not below n needs. So any
   n - o + 1 tokens of it must meet the union of a group that holds a partner. Sure tokens that
   no node of another component holds are met by no group that matters: a node with more than
   n - ceil(share n) of them is closed, first by the kept tokens, then by its whole set. A query
   asks for sure tokens; one with fewer than n - o + 1 of these asks for all that it keeps: the
   smallest token that it has in common with a partner is among the kept ones of both.
5. What is left gets groups and a matrix of its own, by whole sets: the group of a node is now
   its most widely held token, so that a class has few groups. A query asks for its n - o + 1
   tokens that the fewest nodes of other components hold; groups whose unions, without the
   query's own component, have none of them stay closed. Open groups are compared in blocks
   of queries and members inside tasks. Every link between components is between such a
   query and such a member, so the result is exact.

Comparisons count common tokens of whole sets. Components are found by repeated minimum
labels with shortcuts, in written tables. Keys that many rows have (a shared passage, a
leader) are dealt to several tasks: see ``salted``.

Defined results: null and empty texts, and texts of blanks, have no tokens and are linked
with nothing; their component is their own id. Rows with equal sets are in one component, whether they repeat
an id or not, and each row keeps its own place; a component is named by the smallest id in
it, null if none has one. Extra columns are never read (``key_col`` names one to keep). An
empty table gives an empty result. Hashes of 64 bits stand for n-grams; two of one document
collide with a chance of about n * n / 2 ** 65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from censuskit.llm.common import brief, stash

#: Ids to verify are broadcast up to this number (8 MB); beyond it texts are joined by id.
BROADCAST_IDS = 1_000_000
_ROWS = 1024
#: Every node keeps its tokens below this bound.
_SURE = 1 << 62
#: Open groups whose leaders a query is compared with; what they leave is found without them.
LEADERS = 4
_STEP, _CHUNK = np.uint64(0x9E3779B97F4A7C15), 1 << 20
_BLANKS = np.zeros(256, bool)
_BLANKS[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the words of many texts at once, by prefix sums of a polynomial."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            base = 0xD1342543DE82EF95
            self.powers, self.inverses = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
            self.powers[0] = self.inverses[0] = 1
            self.powers, self.inverses = np.cumprod(self.powers), np.cumprod(self.inverses)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and for each text the number of words before it."""
        return self.spans(texts)[:2]

    def spans(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As words(), and where each word starts and stops in the texts joined by one byte."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self._grow(len(data) + 1)
        blank = _BLANKS[data]
        edges = np.diff(np.concatenate([[True], blank]).astype(np.int8))
        starts, stops = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        hashes = _mix((sums[stops] - sums[starts]) * self.inverses[starts])
        return hashes, np.concatenate([[0], np.searchsorted(starts, ends)]), starts, stops


def ngram_sets(texts: list[str | None], n: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text, in order."""
    at, raw = 0, [(t or "").encode().lower() for t in texts]
    while at < len(raw):
        stop, size = at, 0
        while stop < len(raw) and (stop == at or size + len(raw[stop]) < _CHUNK):
            size += len(raw[stop])
            stop += 1
        words, bounds = hasher.words(raw[at:stop])
        grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for i in range(n):
            grams = grams * _STEP + words[i : len(words) - n + 1 + i]
        grams = _mix(grams)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                whole = np.uint64(b - a)
                for w in words[a:b]:
                    whole = whole * _STEP + w
                yield _mix(np.array([whole]))
            else:
                yield grams[:0]
        at = stop


def _set_hashes(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    return int(s.sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(_mix(s)).astype(np.int64)) if len(s) else 0


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.uint64)]).astype(np.int64)))


def _tokens(docs: DataFrame, n: int, share: int, with_tokens: bool) -> DataFrame:
    """doc_id, key, n (set size), s1, s2 (order-free hashes of the set) and, if asked for, tokens:
    the sure ones of the first quarter of the hash range, whose number is ``known``, and the
    smallest others where these are fewer than a node can miss and one."""
    names = ["doc_id", "key", "n", "s1", "s2", *["known", "tokens"] * with_tokens]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        with np.errstate(over="ignore"):
            for batch in batches:
                for start in range(0, batch.num_rows, _ROWS):
                    part, sums, kept = batch.slice(start, _ROWS), [], []
                    for s in ngram_sets(part.column("text").to_pylist(), n, hasher):
                        prefix = len(s) - (share * len(s) + 99) // 100 + 1 if len(s) else 0
                        quarter = int(np.searchsorted(s, np.uint64(_SURE)))
                        sums.append((len(s), *_set_hashes(s), *[quarter] * with_tokens))
                        if with_tokens:
                            kept.append(s[: max(quarter, prefix)])
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), *[pa.array(c, pa.int64()) for c in zip(*sums, strict=True)], *[_lists(kept)] * with_tokens], names)

    return docs.mapInArrow(work, "doc_id long, key long, n long, s1 long, s2 long" + ", known long, tokens array<long>" * with_tokens)


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """node and tokens, the whole set, of the wanted nodes (node, rep, s1, s2, n)."""
    wanted = stash(wanted.distinct(), "ngram-wanted")
    ids = wanted.select(F.col("rep").alias("id")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        ids, wanted = F.broadcast(ids), F.broadcast(wanted)
    chosen = docs.join(ids, docs.doc_id.eqNullSafe(F.col("id")), "left_semi").select("text")
    names = ["s1", "s2", "n", "tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        with np.errstate(over="ignore"):
            for batch in batches:
                for start in range(0, batch.num_rows, _ROWS):
                    found = list(ngram_sets(batch.slice(start, _ROWS).column("text").to_pylist(), n, hasher))
                    sums = zip(*[(*_set_hashes(s), len(s)) for s in found], strict=True)
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in sums], _lists(found)], names)

    found = chosen.mapInArrow(work, "s1 long, s2 long, n long, tokens array<long>")
    return stash(found.join(wanted, ["s1", "s2", "n"]).select("node", "tokens").dropDuplicates(["node"]), "ngram-sets")


def hot_keys(counts: DataFrame, keys: list[str], limit: int = 500, most: int = 50_000) -> DataFrame:
    """Of counts (keys, rows), keys with many rows and the number of parts to deal them to. There
    are at most ``most`` of them, as the least number of rows rises with the total."""
    total = counts.agg(F.sum("rows")).first()[0] or 0
    least = max(limit, total // most + 1)
    return F.broadcast(stash(counts.filter(F.col("rows") > least).select(*keys, F.ceil(F.col("rows") / least).cast("int").alias("parts")), "ngram-hot"))


def salted(big: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame | None = None) -> DataFrame:
    """big joined with small on keys. Rows of big with a hot key go to several tasks by a hash
    of the row, and small's rows for that key are repeated, once for each."""
    if hot is None:
        hot = hot_keys(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")), keys)
    deal = F.coalesce(F.pmod(F.xxhash64(*big.columns), F.col("parts")), F.lit(0)).cast("int")
    left = big.join(hot, keys, "left").withColumn("salt", deal).drop("parts")
    right = small.join(hot, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return left.join(right, [*keys, "salt"]).drop("salt")


def _links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, n: int, share: int) -> DataFrame:
    """The pairs (a, b) that link; b may be in very many."""
    pairs = stash(pairs, "ngram-pairs")
    ids = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets(docs, nodes.join(ids, "node", "left_semi"), n)
    hot = hot_keys(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("rows")), ["b"])
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    both = salted(left, sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), ["b"], hot)
    common = both.select("a", "b", F.size("x").alias("p"), F.size("y").alias("q"), F.size(F.array_intersect("x", "y")).alias("c"))
    return stash(common.filter(100 * F.col("c") >= share * (F.col("p") + F.col("q") - F.col("c"))).select("a", "b"), "ngram-links")


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that links (a, b) lead to, for each node with a link."""
    both = stash(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "ngram-edges")
    hot = hot_keys(both.groupBy("b").agg(F.count(F.lit(1)).alias("rows")), ["b"])
    labels = stash(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "ngram-labels")
    while True:
        # the smallest label among the neighbours, then the label of that label
        near = salted(both, labels.select(F.col("node").alias("b"), F.col("label").alias("near")), ["b"], hot).groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        least = stash(labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")), "ngram-least")
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = stash(salted(least, jump, ["label"]).select("node", "was", F.least("label", "further").alias("label")), "ngram-labels")
        if labels.filter("was <> label").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def _with_label(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """rows with the label of their node; a node without links is its own. comps is a table."""
    if comps.count() <= BROADCAST_IDS:
        comps = F.broadcast(comps)
    return rows.join(comps, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _shared(nodes: DataFrame, whole: bool = False) -> DataFrame:
    """The tokens of nodes (node, n, known, tokens) that two nodes or more hold: node, n, known (how
    many sure tokens the node has), token, sure (every node that holds the token is counted in
    df: all tokens of whole sets, else those of the fixed quarter), df."""
    held = nodes.select("node", "n", "known", F.explode("tokens").alias("token")).withColumn("sure", F.lit(whole) | F.col("token").between(0, _SURE - 1))
    counts = stash(held.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "ngram-counts")
    return salted(held, counts, ["token"], hot_keys(counts.withColumnRenamed("df", "rows"), ["token"]))


def _band(share: int) -> Column:
    # wider by a trifle, so that sizes of a link are in the same or the next band
    return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / share + 1e-6)))


def _common(share: int) -> Column:
    """The tokens that a link of a node with one not below it needs in common."""
    return F.ceil(2 * F.col("n") * share / (100 + share))


def _led(nodes: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """The shared tokens (see _shared), and pairs (a, b) of queries and leaders."""
    by_node = W.partitionBy("node")
    found = _shared(nodes.select("node", "n", "known", "tokens")).withColumns({"pivot": F.min(F.xxhash64("token")).over(by_node), "weight": F.sum("df").over(by_node) / F.col("n"), "rank": F.row_number().over(by_node.orderBy("df", "token")), "alone": F.col("known") - F.count_if("sure").over(by_node)})
    shared = stash(found.withColumn("band", _band(share)), "ngram-shared")
    group = ["pivot", "band"]
    leaders = shared.filter("rank = 1").groupBy(*group).agg(F.max(F.struct("weight", F.bitwise_not("node").alias("inverse"), F.col("n").alias("m"))).alias("top"))
    leaders = stash(leaders.select(*group, F.bitwise_not("top.inverse").alias("leader"), F.col("top.m").alias("m"), F.col("top.weight").alias("lead")), "ngram-leaders")
    # the matrix, and of each of its rows the largest group
    matrix = shared.groupBy("token", *group).agg(F.count(F.lit(1)).alias("holders"))
    largest = stash(matrix.groupBy("token", "band").agg(F.max(F.struct("holders", "pivot")).alias("top")).select("token", "band", "top.pivot"), "ngram-matrix")
    # the rarest tokens, those that no other node holds before all others; as many as a link
    # with a larger node leaves must be in the union
    length = F.col("n") - F.ceil(F.col("n") * share / 100) + 1
    asked = shared.filter(F.col("rank") + F.col("alone") <= length).select("node", "n", "known", "token", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    met = salted(asked, largest, ["token", "band"]).groupBy("node", "n", "known", *group).agg(F.count(F.lit(1)).alias("found"))
    met = met.filter(F.col("found") >= F.least(length, "known") - (F.col("n") - _common(share)))
    led = salted(stash(met, "ngram-open"), leaders, group)
    close = (share * F.col("n") <= 100 * F.col("m")) & (share * F.col("m") <= 100 * F.col("n")) & (F.col("node") != F.col("leader"))
    best = W.partitionBy("node").orderBy(F.desc("lead"), "leader")
    pairs = led.filter(close).withColumn("turn", F.dense_rank().over(best)).filter(F.col("turn") <= LEADERS)
    return shared, pairs.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()


def _foreign(labelled: DataFrame) -> DataFrame:
    """labelled (node, n, token, label, ...) with ``others``, how many nodes of other labels hold
    the token, where these are any."""
    of_label = stash(labelled.groupBy("token", "label").agg(F.count(F.lit(1)).alias("mine")), "ngram-of-label")
    of_token = of_label.groupBy("token").agg(F.sum("mine").alias("rows"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    of_token = stash(of_token, "ngram-of-token")
    hot = hot_keys(of_token.select("token", "rows"), ["token"])
    mixed = salted(of_label, of_token, ["token"], hot).select("token", "label", (F.col("rows") - F.col("mine")).alias("others"), F.col("mine").alias("rows"))
    mixed = stash(mixed, "ngram-mixed")
    return salted(labelled, mixed.drop("rows"), ["token", "label"], hot_keys(mixed.select("token", "label", "rows"), ["token", "label"]))


def _open_groups(foreign: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """Queries with the groups open to them, and the members of these: each node, n, label, pivot,
    band. foreign: tokens of nodes (see _foreign)."""
    by_node = W.partitionBy("node")
    placed = foreign.withColumns({"pivot": F.max(F.struct("df", "token")).over(by_node)["token"], "rank": F.row_number().over(by_node.orderBy(F.desc("sure"), "others", "token")), "met": F.count_if("sure").over(by_node)})
    # a link with a smaller node allows a node to miss this many
    placed = placed.filter(F.col("known") - F.col("met") <= F.col("n") - F.ceil(F.col("n") * share / 100))
    placed = stash(placed.withColumn("band", _band(share)), "ngram-placed")
    matrix = placed.groupBy("token", "band", "pivot").agg(F.max("n").alias("hi"), F.min("label").alias("low_label"), F.max("label").alias("high_label"))
    # sure tokens that no other component holds are asked for first, and are met by none; where
    # the sure ones do not suffice, all that are kept are asked for
    need = F.col("n") - _common(share) + 1
    asked = placed.filter((F.col("known") < need) | (F.col("rank") + F.col("known") - F.col("met") <= need))
    asked = asked.select("node", "n", "label", "token", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    met = salted(asked, stash(matrix, "ngram-matrix"), ["token", "band"]).filter("hi >= n AND (label <> low_label OR label <> high_label)")
    queries = stash(met.select("node", "n", "label", "pivot", "band").distinct(), "ngram-open")
    members = placed.filter("rank = 1").select("node", "n", "label", "pivot", "band")
    return queries, stash(salted(members, queries.select("pivot", "band").distinct(), ["pivot", "band"]), "ngram-others")


def _block_links(sets: DataFrame, opened: DataFrame, members: DataFrame, share: int) -> DataFrame:
    """Links (a, b) of queries (node, n, label, pivot, band) with members of other labels of the
    groups open to them; as many in each block as join its labels. members have the same columns."""
    key = ["pivot", "band"]
    limit = lambda size, name: F.ceil(F.greatest(F.count(F.lit(1)) / 256, F.sum(size) / 2_000_000.0)).cast("int").alias(name)
    groups = opened.groupBy(*key).agg(limit("n", "q_blocks")).join(members.groupBy(*key).agg(limit("n", "m_blocks")), key)
    groups = stash(groups, "ngram-groups")
    asking, asked = salted(opened.select("node", "label", *key), groups, key), salted(members.select("node", "label", *key), groups, key)
    block = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    asking = stash(asking.select("node", "label", *key, block("q_blocks").alias("qb"), each("m_blocks").alias("mb")), "ngram-asking")
    asked = stash(asked.select("node", "label", *key, each("q_blocks").alias("qb"), block("m_blocks").alias("mb")), "ngram-asked")

    def compare(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(held):
            sizes, labels, members = held.held.map(len).to_numpy(), held.other.to_numpy(), held.member.to_numpy()
            tokens, owner = np.concatenate(list(held.held)), np.repeat(np.arange(len(held)), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while (up := parent.get(x, x)) != x:
                    parent[x] = parent.get(up, up)
                    x = up
                return x

            for node, label, own in zip(queries.node, queries.label, queries.tokens, strict=True):
                lo, hi = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
                runs = hi - lo
                at = np.repeat(lo - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
                common = np.bincount(owner[at], minlength=len(held))
                linked = np.flatnonzero((100 * common >= share * (sizes + len(own) - common)) & (labels != label))
                _, first = np.unique(labels[linked], return_index=True)
                for m in linked[first]:
                    mine, other = root(label), root(labels[m])
                    if mine != other:
                        parent[other] = mine
                        out.append((node, members[m]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    place = [*key, "qb", "mb"]
    # columns of their own, or Spark could not tell the two sides' apart
    asked = asked.join(sets, "node").select(*[F.col(c).alias(f"m_{c}") for c in place], F.col("node").alias("member"), F.col("label").alias("other"), F.col("tokens").alias("held"))
    both = asking.join(sets, "node").groupBy(*place).cogroup(asked.groupBy(*[f"m_{c}" for c in place]))
    return stash(both.applyInPandas(compare, "a long, b long"), "ngram-links")


def ngram_components(docs: DataFrame, n: int = 4, share: int = 85, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by
    links), key, component (a number for each component; null without words)."""
    key = F.col(key_col).cast("long") if key_col else F.lit(None).cast("long")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"), F.col(text_col).alias("text"))
    # hashed twice: writing the tokens of all rows costs more disk than hashing costs time
    rows = stash(_tokens(docs, n, share, False), "ngram-rows")
    classes = _tokens(docs, n, share, True).filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"), F.first("known").alias("known"), F.first("tokens").alias("tokens"))
    with brief(docs.sparkSession) as keep:
        nodes = stash(classes.withColumn("node", F.monotonically_increasing_id()), "ngram-nodes")
        names = keep(nodes.drop("known", "tokens"), "ngram-names")
        shared, pairs = _led(nodes, share)
        links = keep(_links(docs, names.drop("rows"), pairs, n, share), "ngram-links")
        comps = keep(components(links), "ngram-labels")
        # what the leaders did not settle: by kept tokens, then by whole sets
        few = _foreign(_with_label(shared.select("node", "n", "known", "token", "sure", "df"), comps))
        queries, members = _open_groups(few, share)
        opened = keep(queries.select("node").unionByName(members.select("node")).distinct(), "ngram-opened")
    if not opened.isEmpty():
        with brief(docs.sparkSession) as keep:
            sets = _sets(docs, names.drop("rows").join(opened, "node", "left_semi"), n)
            size = F.size("tokens").cast("long")
            whole = _shared(sets.withColumns({"n": size, "known": size}), whole=True)
            queries, members = _open_groups(_foreign(_with_label(whole, comps)), share)
            more = _block_links(sets, queries, members, share)
            if not more.isEmpty():
                comps = keep(components(links.unionByName(more)), "ngram-labels")

    labelled = _with_label(names, comps)
    named = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    final = stash(salted(labelled, named, ["label"]), "ngram-final")
    hot = hot_keys(final.select("s1", "s2", "n", "rows"), ["s1", "s2", "n"])
    with_words = salted(rows.filter("n > 0").select("doc_id", "key", "n", "s1", "s2"), final.select("s1", "s2", "n", "label", "component_id"), ["s1", "s2", "n"], hot)
    out = with_words.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "key", F.col("label").alias("component"))
    without = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "key", F.lit(None).cast("long").alias("component"))
    return out.unionByName(without)
