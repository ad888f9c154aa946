"""The offline build: clean, assign topics, index, summarize, with Parquet between the steps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.clean import clean_records
from parley.operators.search import build_index, read_index, write_index
from parley.operators.summary import dataset_summary
from parley.operators.topics import (
    CHAT_STOP_WORDS,
    CLUSTERS,
    DIMENSIONS,
    apply_topics,
    cluster_embeddings,
    cluster_keywords,
    cluster_labels,
    dedup_keep_last,
    hashed_embeddings,
    keyword_lists,
    missing_embeddings,
    model_docs,
    topic_updates,
)
from parley.sources.buckets import fact_of, open_bucketed, rewrite_topics
from parley.sources.tables import add_embeddings, read_fact, write_fact, write_table


def build_corpus(raw: DataFrame, path: str, **clean_options) -> DataFrame:
    """Raw records to a fact table with keyword topics."""
    write_fact(clean_records(raw, **clean_options), f"{path}/fact")
    return read_fact(raw.sparkSession, f"{path}/fact")


def build_topics(
    spark: SparkSession,
    path: str,
    stop_words: Sequence[str],
    clusters: int = CLUSTERS,
    dimensions: int = DIMENSIONS,
    embed: Callable[[DataFrame], DataFrame] = hashed_embeddings,
    source: str = "fact",
    target: str = "fact_topics",
    batch_rows: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Cluster the texts, label the clusters, and write the fact table with the new topics.

    With ``batch_rows`` the clusters are fitted on batches of so many rows. With ``buckets`` the
    source and the target are bucketed tables (:mod:`parley.sources.buckets`) and the rewrite
    shuffles only ids and topics. ``embed`` maps (id, search_text) to (id, embedding) and sees only documents that are not in
    the cache yet.
    """
    fact = open_bucketed(spark, f"{path}/{source}", buckets) if buckets else read_fact(spark, f"{path}/{source}")
    docs = model_docs(fact)
    cache = f"{path}/embeddings"
    if _exists(spark, cache):
        docs_to_embed = missing_embeddings(docs, spark.read.parquet(cache))
    else:
        docs_to_embed = docs
    add_embeddings(embed(docs_to_embed), cache)
    vectors = dedup_keep_last(spark.read.parquet(cache), "id", "written")
    assigned = cluster_embeddings(vectors, clusters, dimensions, batch_rows=batch_rows).select("id", "cluster_id")
    write_table(assigned, f"{path}/clusters")
    assigned = spark.read.parquet(f"{path}/clusters")
    keywords = cluster_keywords(
        docs.join(assigned, "id"), stop_words=[*stop_words, *CHAT_STOP_WORDS]
    )
    labels = cluster_labels(keyword_lists(keywords))
    write_table(labels, f"{path}/labels")
    labels = spark.read.parquet(f"{path}/labels")
    updates = topic_updates(assigned, labels, order="cluster_id")
    if buckets:
        return fact_of(rewrite_topics(spark, f"{path}/{source}", f"{path}/{target}", updates, buckets))
    write_fact(apply_topics(fact, updates), f"{path}/{target}")
    return read_fact(spark, f"{path}/{target}")


def build_search(
    spark: SparkSession, path: str, stop_words: Sequence[str], stems: bool = True, source: str = "fact"
):
    """Write the full-text index of the fact table."""
    fact = read_fact(spark, f"{path}/{source}")
    write_index(build_index(fact, stop_words, stems), f"{path}/index")
    return read_index(spark, f"{path}/index")


def build_summary(spark: SparkSession, path: str, source: str = "fact") -> DataFrame:
    """Write the one-row summary, so reading it later costs nothing."""
    write_table(dataset_summary(read_fact(spark, f"{path}/{source}")), f"{path}/summary")
    return spark.read.parquet(f"{path}/summary")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The stored summary with the date range as text."""
    day = "yyyy-MM-dd HH:mm:ss"
    return spark.read.parquet(f"{path}/summary").select(
        "total_count",
        F.concat(
            F.date_format("start_date", day), F.lit(" to "), F.date_format("end_date", day)
        ).alias("date_range"),
        "model_json",
        "topic_json",
        "country_json",
    )


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
