"""Topics from text clusters: reduce and cluster embeddings, describe clusters, write topics back."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.filters import usable_text
from parley.functions.small import member_of
from parley.functions.text import clean_label
from parley.functions.topics import DEFAULT_TOPIC
from parley.functions.topn import first_n
from parley.operators.minibatch import minibatch_kmeans

DIMENSIONS = 5
CLUSTERS = 50
SEED = 42
VOCABULARY = 1000
OUTLIER_TOPIC = -1

# Whole words: two or more word characters, or three or more ASCII letters.
WORD = r"(?U)\b\w\w+\b"
LETTERS = r"(?U)\b[a-z]{3,}\b"

# Words too common in chat prompts to describe a topic.
CHAT_STOP_WORDS = ("please", "help", "write", "create", "make", "chatgpt", "openai", "code")

# Keywords that decide a cluster's label, in order of precedence.
LABEL_RULES = (
    (("class", "div", "span"), "Web Development (HTML/CSS)"),
    (("def", "return", "import"), "Python Programming"),
    (("sql", "select"), "SQL Database"),
    (("dan", "jailbreak"), "Jailbreak Attempt"),
)


# ---- embeddings ----


def model_docs(fact: DataFrame) -> DataFrame:
    """``(id, search_text)`` of rows with enough text to model."""
    return fact.select("id", "search_text").filter(usable_text(F.col("search_text")))


def embed_texts(
    docs: DataFrame, load_model: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 512
) -> DataFrame:
    """``(id, embedding)`` from an external model, loaded once per Python worker."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for part in parts:
            for start in range(0, len(part), batch):
                rows = part.iloc[start : start + batch]
                vectors = np.asarray(model(rows["search_text"].tolist()), dtype="float32")
                yield pd.DataFrame({"id": rows["id"].to_numpy(), "embedding": list(vectors)})

    return docs.select("id", "search_text").mapInPandas(run, "id string, embedding array<float>")


def missing_embeddings(docs: DataFrame, cached: DataFrame) -> DataFrame:
    """Documents that have no cached embedding yet, by key instead of by position."""
    return docs.join(cached.select("id").distinct(), "id", "left_anti")


def hashed_embeddings(
    docs: DataFrame, features: int = 256, idf_corpus: DataFrame | None = None
) -> DataFrame:
    """Hashed word counts of unit length: the stand-in when no embedding model is at hand.

    Each vector depends on its own text only, so cached and new vectors go together. With
    ``idf_corpus`` the words are weighted by their inverse document frequency there.
    """
    hashing = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features)

    def counts(texts: DataFrame) -> DataFrame:
        words = F.regexp_extract_all(F.lower("search_text"), F.lit(WORD), F.lit(0))
        return hashing.transform(texts.withColumn("_words", words))

    vectors, weighted = counts(docs), "_tf"
    if idf_corpus is not None:
        weighted = "_tfidf"
        vectors = IDF(inputCol="_tf", outputCol=weighted).fit(counts(idf_corpus)).transform(vectors)
    unit = Normalizer(inputCol=weighted, outputCol="_unit").transform(vectors)
    return unit.select("id", vector_to_array("_unit", "float32").alias("embedding"))


def normalize_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Vectors scaled to unit length, in double precision; zero vectors stay as they are."""
    values = F.transform(column, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x))
    scaled = F.transform("_values", lambda x: x / F.col("_norm"))
    return (
        df.withColumn("_norm", norm)
        .withColumn("_values", values)
        .withColumn(column, F.when(F.col("_norm") > 0, scaled).otherwise(F.col("_values")))
        .drop("_norm", "_values")
    )


def pca(df: DataFrame, k: int = DIMENSIONS, column: str = "embedding") -> DataFrame:
    """Centred projection on the first ``k`` principal components, as ``reduced``."""
    vectors = df.withColumn("_raw", array_to_vector(F.col(column)))
    steps = Pipeline(
        stages=[
            StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False),
            PCA(k=k, inputCol="_centred", outputCol="_reduced"),
        ]
    )
    reduced = steps.fit(vectors).transform(vectors)
    return reduced.withColumn("reduced", vector_to_array("_reduced")).drop("_raw", "_centred", "_reduced")


def kmeans(
    df: DataFrame, k: int = CLUSTERS, seed: int = SEED, column: str = "reduced", max_iter: int = 20
) -> DataFrame:
    """Adds ``cluster_id``; every row takes part in the fit and gets a cluster."""
    return kmeans_with_centres(df, k, seed, column, max_iter)[0]


def kmeans_with_centres(
    df: DataFrame, k: int = CLUSTERS, seed: int = SEED, column: str = "reduced", max_iter: int = 20
) -> tuple[DataFrame, list[list[float]]]:
    """As ``kmeans``, and the centres by cluster id."""
    vectors = df.withColumn("_features", array_to_vector(F.col(column)))
    model = KMeans(
        k=k, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cluster_id"
    ).fit(vectors.select("_features"))
    centres = [[float(x) for x in c] for c in model.clusterCenters()]
    return model.transform(vectors).drop("_features"), centres


def is_nearest(centres: Sequence[Sequence[float]], column: str = "reduced") -> Column:
    """Whether no centre is closer than that of the row's cluster."""
    known = F.array(*[F.array(*[F.lit(x) for x in c]) for c in centres])

    def distance(centre: Column) -> Column:
        squares = F.zip_with(F.col(column), centre, lambda x, y: (x - y) * (x - y))
        return F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)

    distances = F.transform(known, distance)
    return F.get(distances, F.col("cluster_id")) <= F.array_min(distances) + 1e-9


def cluster_embeddings(
    df: DataFrame,
    k: int = CLUSTERS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
    batch_rows: int | None = None,
) -> DataFrame:
    """Reduce, then cluster: over all rows in every step or, with ``batch_rows``, over batches."""
    reduced = pca(df, dimensions)
    if batch_rows:
        return minibatch_kmeans(reduced, k, seed, batch_rows=batch_rows)
    return kmeans(reduced, k, seed)


# ---- describing clusters ----


def _terms(text: Column, pattern: str, stop_words: Sequence[str]) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(list(stop_words))) if stop_words else found


def cluster_keywords(
    docs: DataFrame,
    top: int = 15,
    pattern: str = LETTERS,
    stop_words: Iterable[str] = (),
    vocabulary: int = VOCABULARY,
    cluster: str = "cluster_id",
    text: str = "search_text",
) -> DataFrame:
    """Most frequent words of each cluster as ``(cluster_id, term, count, position)``.

    Only the ``vocabulary`` words most frequent over all clusters count. Counting is by (cluster,
    word), so a large cluster is spread over its words.
    """
    counts = (
        docs.select(
            F.col(cluster).alias("cluster_id"),
            F.explode_outer(_terms(F.col(text), pattern, list(stop_words))).alias("term"),
        )
        .filter(F.col("term").isNotNull())
        .groupBy("cluster_id", "term")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    frequent = (
        counts.groupBy("term")
        .agg(F.sum("count").alias("_total"))
        .orderBy(F.desc("_total"), "term")
        .limit(vocabulary)
    )
    position = Window.partitionBy("cluster_id").orderBy(F.desc("count"), "term")
    return (
        counts.join(F.broadcast(frequent.select("term")), "term", "left_semi")  # <= vocabulary rows
        .withColumn("position", F.row_number().over(position))
        .filter(F.col("position") <= top)
        .select("cluster_id", "term", "count", "position")
    )


def keyword_lists(keywords: DataFrame) -> DataFrame:
    """``(cluster_id, keywords)``: the few ranked words of each cluster as an array."""
    ranked = F.array_sort(F.collect_list(F.struct("position", "term")))
    return keywords.groupBy("cluster_id").agg(
        F.transform(ranked, lambda p: p["term"]).alias("keywords")
    )


def keyword_labels(lists: DataFrame, words: int = 3) -> DataFrame:
    """Short label such as ``Python_Code_Error``."""
    shown = F.transform(F.slice("keywords", 1, words), F.initcap)
    return lists.select("cluster_id", F.array_join(shown, "_").alias("label"))


def cluster_labels(lists: DataFrame, rules=LABEL_RULES, default: str = DEFAULT_TOPIC) -> DataFrame:
    """Readable label: the first rule that shares a keyword, else two keywords, else the default."""
    fallback = F.array_join(F.slice("keywords", 1, 2), "_")
    label = F.when(F.trim(fallback) == "", F.lit(default)).otherwise(fallback)
    for any_of, name in reversed(rules):
        hit = F.arrays_overlap("keywords", F.array(*[F.lit(w) for w in any_of]))
        label = F.when(hit, F.lit(name)).otherwise(label)
    return lists.select("cluster_id", label.alias("label"))


def external_labels(
    lists: DataFrame,
    samples: DataFrame,
    labeler: Callable[[list[str], list[str]], str],
    default: str = DEFAULT_TOPIC,
) -> DataFrame:
    """Labels from a callable given a cluster's keywords and sample texts.

    A failing call falls back to two keywords; empty answers become the default.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            answers = []
            for keywords, texts in zip(part["keywords"], part["samples"]):
                try:
                    answers.append(labeler(list(keywords), list(texts)))
                except Exception:
                    answers.append("_".join(list(keywords)[:2]))
            yield pd.DataFrame({"cluster_id": part["cluster_id"], "answer": answers})

    asked = lists.join(samples, "cluster_id").select("cluster_id", "keywords", "samples")
    schema = f"cluster_id {dict(lists.dtypes)['cluster_id']}, answer string"
    label = clean_label(F.col("answer"))
    blank = F.coalesce(label, F.lit("")).isin("") | F.contains(label, F.lit("None"))
    return asked.mapInPandas(run, schema).select(
        "cluster_id", F.when(blank, F.lit(default)).otherwise(label).alias("label")
    )


def cluster_samples(
    docs: DataFrame,
    n: int = 3,
    cluster: str = "cluster_id",
    text: str = "search_text",
    order: str = "id",
) -> DataFrame:
    """The first ``n`` texts of each cluster as an ordered array."""
    rows = docs.select(
        F.col(cluster).alias("cluster_id"), F.col(order).alias("_order"), F.col(text).alias("_text")
    )
    # At most ``n`` texts per cluster are left to collect.
    ordered = F.array_sort(F.collect_list(F.struct("_order", "_text")))
    return (
        first_n(rows, ["cluster_id"], "_order", n)
        .groupBy("cluster_id")
        .agg(F.transform(ordered, lambda p: p["_text"]).alias("samples"))
    )


def ngram_counts(
    docs: DataFrame,
    text: str = "search_text",
    pattern: str = WORD,
    stop_words: Iterable[str] = (),
    min_df: int = 10,
) -> DataFrame:
    """Counts and document frequencies of words and word pairs.

    The terms of a document are sorted and each is set beside its predecessor, so the first of
    equal terms is known and one aggregation with map-side combine gives both numbers.
    """
    terms = docs.select(_terms(F.col(text), pattern, list(stop_words)).alias("_w")).select(
        F.sort_array(F.concat("_w", _pairs("_w"))).alias("_t")
    )
    predecessors = F.concat(F.array(F.lit(None).cast("string")), F.slice("_t", 1, _all_but_one("_t")))
    # Outer, as the inner form would test the arrays first and so build them twice.
    beside = terms.select(
        F.inline_outer(F.arrays_zip(F.col("_t").alias("term"), predecessors.alias("previous")))
    ).filter(F.col("term").isNotNull())
    return (
        beside.groupBy("term")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.count_if(~F.col("term").eqNullSafe(F.col("previous"))).alias("doc_freq"),
        )
        .filter(F.col("doc_freq") >= min_df)
    )


def _all_but_one(array: str) -> Column:
    return F.greatest(F.size(array) - 1, F.lit(0))


def _pairs(words: str) -> Column:
    """Neighbouring words joined by a space."""
    n = _all_but_one(words)
    return F.zip_with(
        F.slice(words, F.lit(1), n),
        F.slice(words, F.lit(2), n),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def merge_small_topics(
    docs: DataFrame, topic: str = "topic_id", min_size: int = 100, outlier: int = OUTLIER_TOPIC
) -> DataFrame:
    """Topics with fewer than ``min_size`` documents become the outlier topic.

    The large topics go to the documents: texts dealt out by topic would be as few tasks as topics."""
    sizes = docs.groupBy(topic).agg(F.count(F.lit(1)).alias("_n"))
    large = F.broadcast(sizes.filter(F.col("_n") >= min_size).select(topic))  # one row per topic
    return (
        member_of(docs, topic, large)
        .withColumn(topic, F.when(F.col("_member"), F.col(topic)).otherwise(F.lit(outlier)))
        .drop("_member")
    )


def topic_terms(
    docs: DataFrame,
    topic: str = "topic_id",
    text: str = "search_text",
    pattern: str = WORD,
    stop_words: Iterable[str] = (),
    min_topics: int = 1,
    top: int = 10,
) -> DataFrame:
    """Class-based TF-IDF (M. Grootendorst, 2022): the words and word pairs typical of each topic.

    weight = share of the term in its topic * ln(1 + A / f), with f the term's count over all
    topics and A the mean number of terms per topic, truncated.
    """
    words = docs.select(
        F.col(topic).alias("topic_id"), _terms(F.col(text), pattern, list(stop_words)).alias("_w")
    )
    counts = (
        words.select("topic_id", F.explode_outer(F.concat("_w", _pairs("_w"))).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("topic_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    # One row per topic and term here, so a term has at most as many rows as there are topics. These
    # rows move once more, by term, and stay there.
    same_term = Window.partitionBy("term")
    kept = counts.select("topic_id", "term", "tf", F.sum("tf").over(same_term).alias("f"), F.count(F.lit(1)).over(same_term).alias("topics"))
    sized = counts
    if min_topics > 1:
        sized = kept = kept.filter(F.col("topics") >= min_topics)
    sizes = sized.groupBy("topic_id").agg(F.sum("tf").alias("size"))
    # Mean and sizes in one table, as it is needed whole whatever columns a caller wants.
    sizes = sizes.withColumn("a", F.floor(F.avg("size").over(Window.partitionBy())))
    position = Window.partitionBy("topic_id").orderBy(F.desc("_score"), "term")
    # The size is the same for all terms of a topic, so ranking needs only the rest of the weight.
    return (
        kept.join(F.broadcast(sizes), "topic_id")  # one row per topic
        .select("topic_id", "term", "size", (F.col("tf") * F.log(1 + F.col("a") / F.col("f"))).alias("_score"))
        .withColumn("position", F.row_number().over(position))
        .filter(F.col("position") <= top)
        .select("topic_id", "term", (F.col("_score") / F.col("size")).alias("weight"), "position")
    )


def topic_names(terms: DataFrame, words: int = 4) -> DataFrame:
    """``(topic_id, name)`` such as ``3_python_error_list_file``."""
    ranked = F.array_sort(F.collect_list(F.struct("position", "term")))
    return (
        terms.filter(F.col("position") <= words)
        .groupBy("topic_id")
        .agg(F.transform(ranked, lambda p: p["term"]).alias("_terms"))
        .select(
            "topic_id",
            F.concat_ws("_", F.col("topic_id").cast("string"), F.array_join("_terms", "_")).alias("name"),
        )
    )


def topic_info(docs: DataFrame, names: DataFrame, topic: str = "topic_id") -> DataFrame:
    """Topics with document count and name, largest first."""
    counts = docs.groupBy(F.col(topic).alias("topic_id")).agg(F.count(F.lit(1)).alias("count"))
    return counts.join(names, "topic_id", "left").orderBy(F.desc("count"), "topic_id")


# ---- writing topics back ----


def dedup_keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last in order; repeated keys are combined before the shuffle."""
    rest = [c for c in df.columns if c not in (key, order)]
    return (
        df.groupBy(key)
        .agg(F.max(F.struct(order, *rest)).alias("_last"))
        .select(key, f"_last.{order}", *[f"_last.{c}" for c in rest])
    )


def topic_updates(
    assignments: DataFrame, labels: DataFrame, order: str, default: str = DEFAULT_TOPIC
) -> DataFrame:
    """``(id, new_topic)`` from cluster assignments and cluster labels, one row per id."""
    labelled = assignments.join(labels, "cluster_id", "left").select(
        "id", F.col(order), F.coalesce("label", F.lit(default)).alias("new_topic")
    )
    return dedup_keep_last(labelled, "id", order).select("id", "new_topic")


def apply_topics(fact: DataFrame, updates: DataFrame) -> DataFrame:
    """Rows with an update get its topic, the others keep theirs; row count is unchanged.

    ``updates`` holds one row per id. Rows without an id cannot match; their keys are made from
    their contents so they do not pile up in one partition.
    """
    columns = fact.columns
    key = F.coalesce(F.col("id"), F.concat(F.lit("\0"), F.xxhash64(*columns).cast("string")))
    matched = F.col("_new.new_topic")
    return (
        fact.withColumn("_key", key)
        .join(
            updates.select(F.col("id").alias("_key"), F.struct("new_topic").alias("_new")),
            "_key",
            "left",
        )
        .withColumn("topic", F.when(F.col("_new").isNotNull(), matched).otherwise(F.col("topic")))
        .select(*columns)
    )


def sample_fixed(df: DataFrame, k: int, key: str = "id", seed: int = SEED) -> DataFrame:
    """Exactly ``k`` rows, picked by a hash of key and seed: the same rows on every run."""
    lot = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_lot", lot).orderBy("_lot", key).limit(k).drop("_lot")
