"""Queries that SQL cannot express: models, vectors and resampling, against plain recomputation."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer, VectorAssembler, Word2Vec
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from censuskit.functions import notes
from censuskit.operators import metrics
from censuskit.operators.models import cross_fitted
from censuskit.plans import registry, texts


def run(spark, sf_dir, key):
    return registry.queries()[key](spark, sf_dir)


def test_bootstrap_weighs_whole_keys(spark):
    rows = spark.createDataFrame([(k, float(k % 3 == 0), 1.0) for k in range(40) for _ in range(3)], "k long, a double, b double")
    got = metrics.bootstrap(rows, "k", {"m": (F.col("a"), F.col("b"))}, replicates=50).first()
    grid = spark.range(40).toDF("k").crossJoin(spark.range(1, 51).select(F.col("id").cast("int").alias("r")))
    drawn = grid.select("k", "r", metrics.poisson(F.col("k"), F.col("r")).alias("w")).toPandas()
    drawn["hit"] = drawn.w * (drawn.k % 3 == 0)
    sums = drawn.groupby("r")[["hit", "w"]].sum()
    values = (sums.hit / sums.w).to_numpy()
    assert [got.low, got.mid, got.high] == pytest.approx([np.percentile(values, q) for q in (2.5, 50, 97.5)])


def test_bootstraps_hold_the_plain_estimate(spark, sf_dir):
    base = run(spark, sf_dir, "performance_base").toPandas()
    recall = base.shown[base.label].mean()
    found = {r.metric: r for r in run(spark, sf_dir, "bootstrap_ci").collect()}
    assert set(found) == {"recall", "precision"}
    assert found["recall"].low <= recall <= found["recall"].high
    paired = {r.metric: r for r in run(spark, sf_dir, "paired_bootstrap").collect()}
    gain = (base["rnk"][base.label] <= 1).mean() - recall
    assert paired["gain"].low <= gain <= paired["gain"].high


def test_cross_fitted_scores_all_rows_by_models_of_other_keys(spark):
    # the label is the same for all rows of one fold, so a model that saw its rows would say so
    rows = spark.range(200).select(F.col("id").alias("k"), F.pmod(F.xxhash64("id"), F.lit(2)).alias("fold0"), (F.col("id") % 7).cast("double").alias("x"))
    rows = rows.withColumn("label", F.when(F.col("x") > 3, F.col("fold0")).otherwise(1 - F.col("fold0")).cast("double"))
    scored = cross_fitted(VectorAssembler(inputCols=["x"], outputCol="features").transform(rows), "k", LogisticRegression())
    got = scored.select("k", "label", "prediction").toPandas()
    assert sorted(got.k) == list(range(200))
    assert (got.label == got.prediction).mean() < 0.2


@pytest.mark.parametrize("key", ["train_classifier", "batch_score"])
def test_models_score_each_line_once(spark, sf_dir, key):
    got = run(spark, sf_dir, key).toPandas()
    keys = ["l_orderkey", "l_linenumber"]  # not unique in the given tables
    given = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*keys).toPandas()
    assert sorted(got[keys].itertuples(index=False, name=None)) == sorted(given.itertuples(index=False, name=None))
    assert got.score.between(0, 1).all()


def test_platt_fit_has_no_gradient(spark, sf_dir):
    fit = run(spark, sf_dir, "platt_fit").first()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    rows = docs.select(F.col("n_chars").cast("double").alias("s"), (F.col("quality") == 1).cast("double").alias("y")).toPandas()
    rest = rows.y - 1 / (1 + np.exp(-(fit.a * rows.s + fit.b)))
    assert abs(rest.mean()) < 1e-3 and abs((rest * rows.s / rows.s.std()).mean()) < 1e-2


def test_search_tries_different_parameters(spark, sf_dir):
    got = run(spark, sf_dir, "hyperparameter_search").toPandas()
    assert len(got) == 6 and got[["depth", "step", "subsample"]].drop_duplicates().shape[0] == 6
    assert got.best.any() and (got[got.best].auc == got.auc.max()).all() and got.rounds.ge(1).all()
    assert got.auc.between(0, 1).all()


def test_rolling_vectors(spark):
    rows = [(k, i, [float(k + i), float(i * i)]) for k in (1, 2) for i in range(10)]
    got = {(r.k, r.i): r.v for r in notes.rolling_vectors(spark.createDataFrame(rows, "k int, i int, v array<double>"), "k", "i", "v", 7).collect()}
    for k, i, _ in rows:
        assert got[k, i] == pytest.approx(np.mean([v for a, b, v in rows if a == k and i - 7 < b <= i], axis=0).tolist())


def test_topics_are_distributions_and_their_means(spark, sf_dir):
    raw = {r.doc_id: np.array(r.topics) for r in run(spark, sf_dir, "topic_model_lda").collect()}
    means = {r.doc_id: np.array(r.topics) for r in run(spark, sf_dir, "topic_rolling_mean").collect()}
    bare = {r.doc_id for r in texts._bag(spark, sf_dir).select("doc_id", "tf").collect() if not r.tf.numNonzeros()}
    assert raw.keys() == means.keys() and all(len(v) == 34 and v.sum() == pytest.approx(float(i not in bare)) for i, v in raw.items())
    ids = sorted(i for i in raw if i // 50 == 1)
    assert means[ids[9]] == pytest.approx(np.mean([raw[i] for i in ids[3:10]], axis=0), abs=1e-6)


def test_pool_against_plain_sums(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["zz"]), (3, [])], "doc_id int, words array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 4.0]), ("b", [3.0, -2.0])], "word string, v array<double>")
    got = {r.doc_id: r for r in notes.pool(docs, "words", vectors, 2).collect()}
    assert got[1].vector == pytest.approx([5 / 3, 2.0]) and got[1].total == [5.0, 6.0] and got[1].top == [3.0, 4.0]
    assert got[2].vector == got[2].total == got[2].top == [2.0, 1.0]  # unknown: the average vector
    assert got[3].vector == [2.0, 1.0]


def test_pool_shuffles_no_words(spark):
    docs = spark.createDataFrame([(i, ["a", f"w{i}"]) for i in range(20)], "doc_id int, words array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 4.0])], "word string, v array<double>")
    plan = notes.pool(docs, "words", vectors, 2)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\((.*)\)", plan)
    assert keys and not any("word" in k for k in keys)


def test_word_vectors_cover_frequent_words(spark, sf_dir):
    got = {r.word: r.vector for r in run(spark, sf_dir, "word_vectors").collect()}
    words = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.explode(notes.clean_tokens(F.col("text"), ["the", "and", "for", "was", "with"])).alias("word"))
    assert set(got) == {r.word for r in words.groupBy("word").count().filter("count >= 15").collect()}
    assert all(len(v) == 16 and np.isfinite(v).all() for v in got.values())
    pooled = run(spark, sf_dir, "doc_vector_pool").collect()
    assert len(pooled) == spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").distinct().count()


def test_pca_against_numpy(spark, sf_dir):
    x = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    m = np.array([x[i] for i in sorted(x)])
    axes = np.linalg.svd(m - m.mean(axis=0), full_matrices=False)[2][:3]
    got = {r.vec_id: r.components for r in run(spark, sf_dir, "pca_embeddings").collect()}
    mine = np.array([got[i] for i in sorted(got)])
    assert np.abs(mine) == pytest.approx(np.abs(m @ axes.T), abs=1e-4)


def test_running_weights_over_many_blocks(spark, tmp_path):
    n, rng = 2300, np.random.default_rng(3)
    values = rng.normal(100, 20, n)
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("event_id") * 60)
    rows = spark.createDataFrame([(i, 7, "view", float(v)) for i, v in enumerate(values)], "event_id long, user_id long, event_type string, value double").withColumn("ts", ts)
    rows.write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: r.ewm for r in registry.queries()["ewm_halflife"](spark, str(tmp_path)).collect()}
    for i in (0, 5, 699, 700, 701, 1399, 1400, 2299):
        w = 2.0 ** (np.arange(-i, 1) / 7.0)
        assert got[i] == pytest.approx((values[: i + 1] * w).sum() / w.sum(), abs=1e-6)


def test_word_vectors_are_trained_in_all_tasks(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(texts, "Word2Vec", lambda numPartitions=1, **more: asked.append(numPartitions) or Word2Vec(numPartitions=numPartitions, **more))
    words = spark.createDataFrame([(["left", "right", f"w{i % 3}"],) for i in range(60)], "words array<string>")
    assert {r.word for r in texts._word_vectors(words).collect()} == {"left", "right", "w0", "w1", "w2"}
    assert asked == [spark.sparkContext.defaultParallelism] and asked[0] > 1


def test_iterations_of_the_topic_model_read_a_table(spark, sf_dir):
    plan = texts._bag(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "regexp" not in plan and "documents.parquet" not in plan


def test_vocabulary_is_bounded_by_a_number_of_texts(spark, sf_dir, monkeypatch):
    asked = []
    monkeypatch.setattr(texts, "CountVectorizer", lambda **more: asked.append(more["maxDF"]) or CountVectorizer(**more))
    bag = texts._bag(spark, sf_dir)
    assert asked == [0.5 * bag.count()] and asked[0] >= 15  # a share would make it keep all words in memory
    words = texts._tokens(spark, sf_dir).select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
    assert bag.first().tf.size == words.filter(F.col("count").between(15, asked[0])).count()


def test_topic_model_has_no_more_parts_than_tasks(spark, monkeypatch):
    parts = []

    class Fitted(LDA):
        def fit(self, rows):
            parts.append(rows.rdd.getNumPartitions())
            return super().fit(rows)

    rows = [(i, Vectors.sparse(40, [i % 40], [2.0])) for i in range(400)]
    bag = spark.createDataFrame(rows, ["doc_id", "features"]).repartition(16)
    monkeypatch.setattr(texts, "LDA", Fitted)
    monkeypatch.setattr(texts, "_bag", lambda spark, d: bag)
    assert {r.doc_id for r in texts._topics(spark, "").collect()} == set(range(400))
    assert parts == [spark.sparkContext.defaultParallelism]
