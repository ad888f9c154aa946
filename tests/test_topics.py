import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.operators import topics


def docs(spark):
    texts = {
        0: ["python code error python", "code python class", "error in python code"],
        1: ["sql select table", "select from sql table", "sql table"],
        2: ["chat about weather"],
    }
    rows = [(f"{c}{i}", c, t) for c, ts in texts.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "id string, cluster_id int, search_text string")


def test_keywords_and_labels(spark):
    keywords = topics.cluster_keywords(docs(spark), top=3, stop_words=["from", "about"])
    lists = topics.keyword_lists(keywords)
    found = {r.cluster_id: r.keywords for r in lists.collect()}
    assert found[0] == ["python", "code", "error"] and found[1][:2] == ["sql", "table"]
    assert {r.cluster_id: r.label for r in topics.keyword_labels(lists).collect()}[0] == "Python_Code_Error"
    labels = {r.cluster_id: r.label for r in topics.cluster_labels(lists).collect()}
    assert labels == {0: "python_code", 1: "SQL Database", 2: "chat_weather"}


def test_vocabulary_cap(spark):
    capped = topics.cluster_keywords(docs(spark), vocabulary=2).collect()
    assert {r.term for r in capped} == {"python", "sql"} or len({r.term for r in capped}) == 2


def test_whole_words_only(spark):
    df = spark.createDataFrame([("a", 0, "abc abc1 naïve xyz_ ab caféxyz DEF")], "id string, cluster_id int, search_text string")
    assert {r.term for r in topics.cluster_keywords(df).collect()} == {"abc", "def"}


def test_samples_and_external_labels(spark):
    lists = topics.keyword_lists(topics.cluster_keywords(docs(spark)))
    samples = topics.cluster_samples(docs(spark), n=2)
    assert {r.cluster_id: len(r.samples) for r in samples.collect()} == {0: 2, 1: 2, 2: 1}

    def labeler(keywords, texts):
        if "sql" in keywords:
            raise ConnectionError
        return ' "Label: Snakes"\nbecause' if "python" in keywords else "None"

    labels = topics.external_labels(lists, samples, labeler)
    assert {r.cluster_id: r.label for r in labels.collect()} == {0: "Snakes", 1: "sql_table", 2: "General"}


def test_ngrams(spark):
    df = spark.createDataFrame([("x y x y zz",), ("the xx yy the xx",), ("",), ("xx yy",)], "search_text string")
    rows = {r.term: (r["count"], r.doc_freq) for r in topics.ngram_counts(df, stop_words=["the"], min_df=1).collect()}
    assert rows == {"zz": (1, 1), "xx": (3, 2), "yy": (2, 2), "xx yy": (2, 2), "yy xx": (1, 1)}
    assert {r.term for r in topics.ngram_counts(df, stop_words=["the"], min_df=2).collect()} == {"xx", "yy", "xx yy"}


def test_topic_terms_and_info(spark):
    df = docs(spark).withColumnRenamed("cluster_id", "topic_id")
    merged = topics.merge_small_topics(df, min_size=2)
    assert {r.topic_id for r in merged.select("topic_id").distinct().collect()} == {0, 1, -1}
    terms = topics.topic_terms(merged)
    first = {r.topic_id: r.term for r in terms.filter("position = 1").collect()}
    assert first[0] == "python" and first[1] in ("sql", "table")
    info = topics.topic_info(merged, topics.topic_names(terms)).collect()
    assert [(r.topic_id, r["count"]) for r in info] == [(0, 3), (1, 3), (-1, 1)]
    assert info[0].name.startswith("0_python_")


def test_dedup_and_apply(spark):
    seen = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "id string, seq int, v string")
    last = topics.dedup_keep_last(seen, "id", "seq")
    assert sorted(map(tuple, last.collect())) == [("a", 3, "y"), ("b", 1, None)]
    assert topics.dedup_keep_last(last, "id", "seq").count() == 2
    fact = spark.createDataFrame([("a", "old"), ("b", "old"), ("c", None), (None, "kept"), (None, "too")], "id string, topic string")
    updates = spark.createDataFrame([("a", "new"), ("c", "new"), ("zz", "new")], "id string, new_topic string")
    applied = topics.apply_topics(fact, updates)
    assert applied.columns == fact.columns
    assert sorted(map(str, (tuple(r) for r in applied.collect()))) == sorted(
        map(str, [("a", "new"), ("b", "old"), ("c", "new"), (None, "kept"), (None, "too")])
    )


def test_updates(spark):
    assigned = spark.createDataFrame([("a", 0, 1), ("a", 1, 2), ("b", 9, 3)], "id string, cluster_id int, seq int")
    labels = spark.createDataFrame([(0, "X"), (1, "Y")], "cluster_id int, label string")
    updates = topics.topic_updates(assigned, labels, "seq")
    assert sorted(map(tuple, updates.collect())) == [("a", "Y"), ("b", "General")]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 8)) * 10
    points = [centres[i % 4] + rng.normal(size=8) * 0.1 for i in range(200)]
    return spark.createDataFrame(
        [(str(i), i % 4, [float(x) for x in p]) for i, p in enumerate(points)], "id string, truth int, embedding array<float>"
    )


def test_pca_matches_numpy(vectors):
    rows = topics.pca(vectors, 3).orderBy(F.col("id").cast("int")).collect()
    x = np.array([r.embedding for r in rows], dtype=float)
    x -= x.mean(axis=0)
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    expected, found = x @ axes[:3].T, np.array([r.reduced for r in rows])
    assert np.allclose(np.abs(expected), np.abs(found), atol=1e-6)


def test_kmeans_finds_the_groups(vectors):
    clustered = topics.cluster_embeddings(vectors, k=4, dimensions=3)
    assert clustered.count() == 200
    pairs = clustered.select("truth", "cluster_id").distinct().collect()
    assert len(pairs) == 4 and len({p.cluster_id for p in pairs}) == 4


def test_embedding_hooks(spark, tmp_path):
    base = docs(spark).select("id", "search_text")
    hashed = topics.hashed_embeddings(base, 32).collect()
    weighted = topics.hashed_embeddings(base, 32, idf_corpus=base).collect()
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-5 for r in hashed + weighted)

    def load_model():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    cached = topics.embed_texts(base.filter("id < '1'"), load_model, batch=2)
    assert {r.id: list(r.embedding) for r in cached.collect()}["00"] == [24.0, 1.0]
    assert topics.missing_embeddings(base, cached).count() == base.count() - 3
    zero = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<float>")
    assert sorted(list(r[0]) for r in topics.normalize_vectors(zero).collect()) == [[0.0, 0.0], [0.6, 0.8]]


def test_sample_is_exact_and_stable(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"))
    one, two = topics.sample_fixed(df, 40), topics.sample_fixed(df.repartition(7), 40)
    assert {r.id for r in one.collect()} == {r.id for r in two.collect()} and one.count() == 40
    assert {r.id for r in topics.sample_fixed(df, 40, seed=1).collect()} != {r.id for r in one.collect()}


def test_topic_terms_read_texts_once_and_where_they_lie(spark):
    """Texts do not move by topic, and both the weights and the names read them once."""
    rows = [(i % 3, f"common words w{i % 3} and{i}") for i in range(30)]
    merged = topics.merge_small_topics(spark.createDataFrame(rows, "topic_id int, search_text string"), min_size=2)
    plan = merged.select("topic_id", "search_text")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for min_topics in (1, 2):
        terms = topics.topic_terms(merged, min_topics=min_topics)
        for df in (terms, topics.topic_names(terms)):
            assert {r.topic_id for r in df.collect()} == {0, 1, 2}
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert plan.count("Generate ") == 1
