"""Text at scale (inventory 2.9)."""

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, PCA, CountVectorizer, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window as W, functions as F

from censuskit.functions import notes
from censuskit.functions.keywords import keyword_counts, label_count
from censuskit.operators import frames
from censuskit.plans.registry import register
from censuskit.plans.sqlviews import sql_query as q
from censuskit.sources.tables import table

q("stitch_note_parts", "SELECT conv_id, array_join(transform(array_sort(collect_list(struct(turn, text))), x -> x.text), '') AS note FROM conversations GROUP BY conv_id", "SELECT conv_id, string_agg(text, '' ORDER BY turn, text) AS note FROM conversations GROUP BY conv_id")
q("club_notes_by_day", "SELECT conv_id % 50 AS pid, conv_id % 7 AS day, sha2(array_join(transform(array_sort(collect_list(struct(conv_id, turn, text))), x -> x.text), '. '), 256) AS note_sha FROM conversations GROUP BY conv_id % 50, conv_id % 7", "SELECT conv_id % 50 AS pid, conv_id % 7 AS day, sha256(string_agg(text, '. ' ORDER BY conv_id, turn, text)) AS note_sha FROM conversations GROUP BY 1, 2")
q("note_type_split", "SELECT conv_id, turn, CASE WHEN role RLIKE '(?i)USER' THEN 'emar' ELSE 'other' END AS kind FROM conversations", "SELECT conv_id, turn, CASE WHEN regexp_matches(role, '(?i)USER') THEN 'emar' ELSE 'other' END AS kind FROM conversations")
q("note_type_counts", "SELECT conv_id % 50 AS pid, count(*) FILTER (WHERE role = 'user') AS user_notes, count(*) FILTER (WHERE role = 'assistant') AS assistant_notes, count(*) FILTER (WHERE turn > 2) AS late_notes FROM conversations GROUP BY conv_id % 50")
q("note_count_prev_day", "WITH n AS (SELECT pid, e AS day, count(*) AS n FROM ev WHERE kind = 'view' GROUP BY pid, e) SELECT s.pid, s.day, coalesce(n.n, 0) AS notes_before FROM sp s LEFT JOIN n ON n.pid = s.pid AND DADD(n.day, 1) = s.day")

CLEAN = r"""list_filter(string_split(regexp_replace(regexp_replace(lower(text), '\[[^\]]*\]|\([^)]*\)', ' ', 'g'), '[^a-z0-9 ]+', ' ', 'g'), ' '), lambda x: length(x) > 2 AND NOT regexp_matches(x, '[0-9]') AND x NOT IN ('the', 'and', 'for', 'was', 'with'))"""


def _tokens(spark, d):
    return table(spark, d, "documents").select("doc_id", notes.clean_tokens(F.col("text"), ["the", "and", "for", "was", "with"]).alias("words"))


@register("tokenize_clean", f"SELECT doc_id, CAST(len({CLEAN}) AS INT) AS n, sha256(array_to_string({CLEAN}, ' ')) AS words_sha FROM documents")
def tokenize_clean(spark, d):
    return _tokens(spark, d).select("doc_id", F.size("words").alias("n"), F.sha2(F.array_join("words", " "), 256).alias("words_sha"))


#: Fifty notes in a row stand for the notes of a patient.
PATIENT = "floor(doc_id / 50)"
#: Keywords by hand; the first words of each benchmark passage, two and three of them, are phrases too.
KEYWORDS = [("idiot", "abuse"), ("moron", "abuse"), ("license", "legal"), ("licensed under", "legal"), ("token", "secret")]
FIRST = r"regexp_extract(lower(text), '^([a-z]+ [a-z]+(?: [a-z]+){{{n}}})\b', 1)"


@register("keyword_label_counts", """WITH b AS (""" + " UNION ".join(f"SELECT {FIRST.format(n=n)} AS phrase, 'topic_' || item_id % 3 AS label FROM benchmark" for n in (0, 1)) + """), k AS (SELECT * FROM (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in KEYWORDS) + r""") t(phrase, label) UNION SELECT * FROM b WHERE phrase <> ''),
  c AS (SELECT d.doc_id, k.label, CAST(sum(len(regexp_extract_all(lower(d.text), '\b' || k.phrase || '\b')) - len(regexp_extract_all(lower(d.text), '\b(?:no|not|by) ' || k.phrase || '\b'))) AS BIGINT) AS n FROM documents d CROSS JOIN k GROUP BY 1, 2),
  s AS (SELECT doc_id // 50 AS pid, doc_id, label, n FROM c) SELECT doc_id, label, n, CAST(sum(n) OVER (PARTITION BY pid, label ORDER BY doc_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS n_30, CAST(sum(n) OVER (PARTITION BY pid, label ORDER BY doc_id) AS BIGINT) AS n_all FROM s""")
def keyword_label_counts(spark, d):
    """Phrases of a keyword table counted by label in one pass over each text; a cue right before
    a phrase negates it."""
    firsts = [table(spark, d, "benchmark").select(F.expr(FIRST.format(n=n).replace("\\b", "\\\\b")).alias("phrase"), F.concat(F.lit("topic_"), F.expr("item_id % 3")).alias("label")) for n in (0, 1)]
    keywords = spark.createDataFrame(KEYWORDS, "phrase string, label string").unionByName(firsts[0]).unionByName(firsts[1])
    labels = ["abuse", "legal", "secret", "topic_0", "topic_1", "topic_2"]
    found = keyword_counts(table(spark, d, "documents").select("doc_id", "text"), "text", keywords, window=1)
    long = found.select("doc_id", *[label_count("counts", label).alias(label) for label in labels]).unpivot("doc_id", labels, "label", "n")
    by = W.partitionBy(F.expr(PATIENT), "label").orderBy("doc_id")
    return long.select("doc_id", "label", "n", F.sum("n").over(by.rowsBetween(-29, 0)).alias("n_30"), F.sum("n").over(by.rowsBetween(W.unboundedPreceding, 0)).alias("n_all"))


@register("doc_frequency_filter", f"WITH w AS (SELECT DISTINCT doc_id, unnest({CLEAN}) AS word FROM documents), c AS (SELECT word, count(*) AS df FROM w GROUP BY word) SELECT word, df FROM c WHERE df >= 15 AND df <= 0.5 * (SELECT count(*) FROM documents)")
def doc_frequency_filter(spark, d):
    n = table(spark, d, "documents").agg(F.count(F.lit(1)).alias("total"))
    df = _tokens(spark, d).select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return df.filter("df >= 15").crossJoin(F.broadcast(n)).filter(F.col("df") <= 0.5 * F.col("total")).select("word", "df")  # one row


@register("tfidf", f"WITH w AS (SELECT doc_id, unnest({CLEAN}) AS word FROM documents), t AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY 1, 2), c AS (SELECT word, count(*) AS df FROM t GROUP BY word HAVING count(*) >= 15) SELECT t.doc_id, t.word, t.tf, round(t.tf * ln(((SELECT count(*) FROM documents) + 1.0) / (c.df + 1.0)), 6) AS weight FROM t JOIN c USING (word)")
def tfidf(spark, d):
    """Texts are cut into words once; the counts are written and read for both sides."""
    tf = frames.written(_tokens(spark, d).select("doc_id", F.explode("words").alias("word")).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("tf")), "tf")
    df = tf.groupBy("word").agg(F.count(F.lit(1)).alias("df")).filter("df >= 15")
    n = table(spark, d, "documents").agg(F.count(F.lit(1)).alias("total"))
    return tf.join(df, "word").crossJoin(F.broadcast(n)).select("doc_id", "word", "tf", F.round(F.col("tf") * F.log((F.col("total") + 1.0) / (F.col("df") + 1.0)), 6).alias("weight"))


def _bag(spark, d, size=100_000):
    """Weighted words of each document. Words and weights are written, as models read them in every iteration."""
    words = frames.written(_tokens(spark, d), "words")
    n = words.count()
    most = 0.5 * n if n > 1 else 0.5  # given a share, CountVectorizer counts the texts itself and keeps all their words for that
    bag = CountVectorizer(inputCol="words", outputCol="tf", minDF=15, maxDF=most, vocabSize=size).fit(words).transform(words)
    return frames.written(IDF(inputCol="tf", outputCol="features").fit(bag).transform(bag).select("doc_id", "tf", "features"), "bag")


def _topics(spark, d):
    """In each iteration every part of the rows makes a matrix of topics by words and sends it on, so there are
    only as many parts as tasks run at a time."""
    bag = _bag(spark, d)
    model = LDA(k=34, maxIter=20, optimizer="online", seed=7).fit(bag.coalesce(spark.sparkContext.defaultParallelism))
    return model.transform(bag).select("doc_id", vector_to_array("topicDistribution").alias("topics"))


@register("topic_model_lda")
def topic_model_lda(spark, d):
    """The share of each topic; all zero for a document without a word of the vocabulary."""
    return _topics(spark, d)


@register("topic_rolling_mean")
def topic_rolling_mean(spark, d):
    """Topic scores of the model, averaged over a patient's last seven notes."""
    topics = _topics(spark, d).withColumn("pid", F.expr(PATIENT))
    return notes.rolling_vectors(topics, "pid", "doc_id", "topics", 7).select("doc_id", "topics")


def _found(words: str, n: str) -> str:
    """Counts and scored pairs of a table of words in order (doc_id, pos, word)."""
    return f"""u{n} AS (SELECT *, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM {words}), c{n} AS (SELECT word, count(*) AS n FROM {words} GROUP BY word), v{n} AS (SELECT count(*) AS v FROM c{n}), p{n} AS (SELECT word AS a, nxt AS b, count(*) AS n_ab FROM u{n} WHERE nxt IS NOT NULL GROUP BY 1, 2),
  k{n} AS (SELECT p{n}.a, p{n}.b, n_ab, round((n_ab - 5) * CAST(v AS DOUBLE) / (x.n * y.n), 6) AS score FROM p{n} JOIN c{n} x ON x.word = p{n}.a JOIN c{n} y ON y.word = p{n}.b CROSS JOIN v{n} WHERE n_ab > 5 AND (n_ab - 5) * CAST(v AS DOUBLE) / (x.n * y.n) > 10)"""


@register("phrase_detection", f"""WITH w AS (SELECT doc_id, {CLEAN} AS ws FROM documents), t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w), {_found("t", "1")},
  f AS (SELECT u1.doc_id, u1.pos FROM u1 JOIN k1 ON a = word AND b = nxt), g AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM f),
  h AS (SELECT doc_id, pos FROM (SELECT *, min(pos) OVER (PARTITION BY doc_id, run) AS first FROM g) WHERE (pos - first) % 2 = 0),
  m AS (SELECT u1.doc_id, u1.pos, CASE WHEN h.pos IS NOT NULL THEN word || '_' || nxt ELSE word END AS word FROM u1 LEFT JOIN h ON h.doc_id = u1.doc_id AND h.pos = u1.pos LEFT JOIN h AS l ON l.doc_id = u1.doc_id AND l.pos = u1.pos - 1 WHERE l.pos IS NULL), {_found("m", "2")}
  SELECT 1 AS turn, * FROM k1 UNION ALL SELECT 2 AS turn, * FROM k2""")
def phrase_detection(spark, d):
    words = frames.written(_tokens(spark, d).withColumn("row", F.monotonically_increasing_id()), "words")
    return notes.phrases(words, "row", "words", least=5, score=10.0)


def _word_vectors(words):
    """Vectors of frequent words. Each of the tasks that run at a time trains on its share of all
    texts, and the vectors of a word are averaged after every iteration."""
    parts = words.sparkSession.sparkContext.defaultParallelism
    return Word2Vec(vectorSize=16, minCount=15, maxIter=5, seed=3, numPartitions=parts, inputCol="words", outputCol="v").fit(words).getVectors()


@register("word_vectors")
def word_vectors(spark, d):
    return _word_vectors(frames.written(_tokens(spark, d), "words")).select("word", vector_to_array("vector").alias("vector"))


@register("doc_vector_pool")
def doc_vector_pool(spark, d):
    """Mean, sum and largest values of the vectors of each document's words; unknown words take the average vector."""
    words = frames.written(_tokens(spark, d), "words")
    return notes.pool(words, "words", _word_vectors(words).select("word", vector_to_array("vector").alias("v")), 16)


@register("vector_sum_by_day", "SELECT pid, day, list_transform(generate_series(1, 4), lambda i: round(list_sum(list_transform(vs, lambda v: CAST(v[i] AS DOUBLE))), 4)) AS total FROM (SELECT vec_id % 40 AS pid, vec_id % 7 AS day, list(embedding ORDER BY vec_id) AS vs FROM embeddings GROUP BY 1, 2)")
def vector_sum_by_day(spark, d):
    e = table(spark, d, "embeddings").select((F.col("vec_id") % 40).alias("pid"), (F.col("vec_id") % 7).alias("day"), "embedding")
    sums = e.groupBy("pid", "day").agg(*[F.round(F.sum(F.col("embedding")[i].cast("double")), 4).alias(f"s{i}") for i in range(4)])
    return sums.select("pid", "day", F.array(*[f"s{i}" for i in range(4)]).alias("total"))


@register("pca_embeddings")
def pca_embeddings(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("x"))
    return PCA(k=3, inputCol="x", outputCol="y").fit(e).transform(e).select("vec_id", vector_to_array("y").alias("components"))
