"""Each stage of the pipeline against a brute-force version on its own input."""

import collections
import random
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from censuskit.llm.bpe import Vocabulary

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    d = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = [], []
    for i in range(240):
        text = " ".join(rng.choices(words, k=rng.randint(20, 60)))
        if i % 6 == 0:
            text += " you moron idiot"
        if i % 8 == 1 and docs:
            text = docs[-1][1] + ("  " if i % 16 == 1 else " extra")
        docs.append((i, text, "en", f"s{i % 4}" if i % 9 else None, len(text)))
        if i % 3 == 0:
            labels.append((i, 1, int("moron" in text)))
    docs += [(240, None, None, "s0", 0), (241, "", "en", "s1", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, corpus):
    import corpus_pipeline
    from censuskit.llm.common import documents, stash

    docs = documents(spark, corpus)
    columns = docs.columns
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, corpus), "test-pipeline")
        after = docs.collect()
        if name != "byte-level BPE":
            assert docs.columns == columns
            full = {r.doc_id: r for r in before}
            assert all(full[r.doc_id] == r for r in after)
        left = {r.doc_id for r in after}
        if name == "toxicity":
            assert left == {r.doc_id for r in before if "moron" not in (r.text or "")}
        elif name == "exact dedup":
            groups = collections.defaultdict(list)
            for r in before:
                groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id))
            assert sorted(r.doc_id for r in after) == sorted(min(g)[1] for g in groups.values())
        elif name == "n-gram Jaccard join":
            sets = {}
            for r in before:
                w = re.findall(WORD, (r.text or "").lower())
                sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
            parent = {i: i for i in sets}

            def root(x):
                return x if parent[x] == x else root(parent[x])

            for a in sets:
                for b in sets:
                    if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        x, y = sorted((root(a), root(b)))
                        parent[y] = x
            assert sorted(r.doc_id for r in after) == sorted(i for i in sets if root(i) == i) and len(after) < len(before)
        elif name == "mixing":
            times = collections.Counter(r.doc_id for r in after)
            assert max(times.values()) <= 3
            size = lambda r: len(re.findall(WORD, r.text or ""))
            have, took = collections.Counter(), collections.Counter()
            for r in before:
                have[r.source] += size(r)
            for r in after:
                took[r.source] += size(r)
            names = sorted(have, key=lambda s: (s is None, s or ""))
            w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
            total, capped, target = sum(have.values()), set(), {}
            while True:
                free = sum(w[s] for s in names if s not in capped)
                rest = total - sum(3 * have[s] for s in capped)
                target = {s: 3 * have[s] if s in capped else rest * w[s] / free for s in names}
                over = {s for s in names if target[s] > 3 * have[s]}
                if not over:
                    break
                capped |= over
            assert all(abs(took[s] - target[s]) <= 0.1 * target[s] + 60 for s in names)
        else:
            v = Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
            t = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
            texts = {r.doc_id: r.text or "" for r in before}
            assert len(after) == len(before) and all(r.ids == t.encode_ordinary(texts[r.doc_id]) for r in after)
        before = after


@pytest.mark.parametrize("name", ["exact dedup", "n-gram Jaccard join", "mixing"])
def test_stages_leave_no_texts(spark, corpus, name):
    """What a stage leaves in the shared folder is lists of rows, not the documents."""
    import glob
    import os

    import corpus_pipeline
    from censuskit.llm.common import documents, shared_dir

    base = shared_dir(spark).removeprefix("file://")
    old = set(os.listdir(base))
    dict(corpus_pipeline.STAGES)[name](spark, documents(spark, corpus), corpus).collect()
    tables = [spark.read.parquet(f"file://{base}/{t}") for t in set(os.listdir(base)) - old if glob.glob(f"{base}/{t}/*.parquet")]
    assert tables and not any("text" in t.columns or t.count() > 242 for t in tables)


@pytest.mark.parametrize("name", ["exact dedup", "n-gram Jaccard join", "mixing"])
def test_lists_of_rows_shuffle_no_texts(spark, corpus, name):
    """However large the tables are that Spark joins by a shuffle, the texts stay where they are read."""
    import corpus_pipeline
    from censuskit.llm.common import documents

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = dict(corpus_pipeline.STAGES)[name](spark, documents(spark, corpus), corpus)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastExchange" in plan and not re.search(r"\bExchange ", plan)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_rows_are_taken_as_often_as_listed(spark, corpus, monkeypatch, limit):
    """Sent in blocks or, where these are too many, joined by row: 0 to 9 times, or once."""
    import corpus_pipeline
    from censuskit.llm.common import brief, documents

    monkeypatch.setattr(corpus_pipeline, "BROADCAST_BLOCKS", limit)
    docs, key = corpus_pipeline._numbered(documents(spark, corpus), "test-often")
    for most in (9, 1):
        times = (F.col("doc_id") % (most + 1)).alias("times")
        with brief(spark) as keep:
            got = corpus_pipeline._as_often(docs, key, docs.select(F.col(key).alias("key"), times).filter("times > 0"), "test-often", keep)
        assert got.columns == documents(spark, corpus).columns
        assert collections.Counter(r.doc_id for r in got.collect()) == collections.Counter({i: i % (most + 1) for i in range(242) if i % (most + 1)})


def test_rows_are_numbered_alike_however_they_are_read(spark, corpus):
    """Numbers are places in files where docs are whole files; else they are written down once."""
    import corpus_pipeline
    from censuskit.llm.common import documents

    docs = documents(spark, corpus)
    whole = {"whole": docs, "filtered": docs.filter("doc_id % 3 > 0"), "twice": docs.unionByName(docs), "joined": docs.join(spark.range(2), F.lit(True)), "made": spark.createDataFrame([(1, "a"), (1, "a")], "row_file long, text string")}
    for name, df in whole.items():
        got, key = corpus_pipeline._numbered(df, f"test-{name}")
        first = {r[key]: r for r in got.collect()}
        assert len(first) == df.count() and set(got.columns) == {*df.columns, key}, name
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        again = {r[key]: r for r in got.repartition(7).collect()}
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert first == again, name


def test_run_gives_the_last_stage(spark, corpus):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, corpus)
    assert got.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 100


def test_stages_on_awkward_rows(spark, tmp_path):
    """Null and shared ids, repeated rows, blank and very long texts, columns named like inner ones."""
    import corpus_pipeline
    from censuskit.llm.common import stash

    rng = random.Random(3)
    words = [f"word{i}" for i in range(200)]
    some = lambda k: " ".join(rng.choices(words, k=k))
    near = some(80)
    texts = [some(30) for _ in range(30)] + [near, near + " more", near + " more", None, None, "", " ", some(120_000), "you moron idiot " + some(20)]
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, t, "en", None if k % 4 == 0 else "s", k, "a", 1.5, k % 2, "q") for k, t in enumerate(texts)]
    rows += [rows[4], rows[4], rows[30]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, Row_Number string, ROW_NUMBER_TIMES double, Score int, component string"
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, schema).repartition(3)
    for empty in (False, True):
        left = stash(docs.limit(0) if empty else docs, "test-awkward")
        for name, stage in corpus_pipeline.STAGES:
            before = collections.Counter(map(tuple, left.collect()))
            after = stash(stage(spark, left, str(tmp_path)), "test-awkward")
            if name == "byte-level BPE":
                assert after.count() == sum(before.values())
                break
            got = collections.Counter(map(tuple, after.collect()))
            assert after.columns == left.columns and set(got) <= set(before)
            if name == "toxicity":
                # rows that are equal go or stay together
                assert all(got[r] in (0, n) for r, n in before.items())
                after, got = left, before
            elif name == "exact dedup":
                groups = collections.defaultdict(list)
                for r in before:
                    groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
                assert sum(got.values()) == len(groups) and all(sum(got[r] for r in g) == 1 for g in groups.values())
            elif name == "n-gram Jaccard join":
                assert sum(got.values()) == sum(before.values()) - (0 if empty else 1)
            left = after
