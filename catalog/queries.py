"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog import params, views
from parley.functions import models
from parley.functions import text as tx
from parley.functions.filters import build_filters, more_words
from parley.functions.tokens import tokens
from parley.functions.topics import keyword_topic
from parley.operators import (
    annotate,
    anomaly,
    block_search,
    clean,
    density,
    freq,
    lengths,
    lookup,
    macro,
    minibatch,
    sandbox,
    search,
    sketches,
    style,
    summary,
    topics,
    users,
)
from parley.plans import build, incremental
from parley.session import shared_path
from parley.sources import buckets, interleave, readers, tables
from parley.streaming import ingest, watch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# ---- analytics ----


@query
def topic_stats(spark, sf):
    return macro.topic_stats(views.headers(spark, sf)).drop("total_conversations")


@query
def topic_stats_filtered(spark, sf):
    return macro.topic_stats(
        views.headers(spark, sf), models=["gpt-4o"], start="1997-01-01", end="1999-06-30", limit=3
    )


@query
def topic_stats_by_model(spark, sf):
    asked = ["gpt-4o", "o1", "no-such-model", "gpt-4o"]
    return macro.topic_stats_by_model(views.headers(spark, sf), asked, limit=3)


@query
def engagement_by_model(spark, sf):
    return macro.engagement(views.fact(spark, sf), "model", limit=5)


@query
def engagement_by_topic(spark, sf):
    return macro.engagement(views.fact(spark, sf), "topic", models=["gpt-4", "gpt-4o"])


@query
def trend_month(spark, sf):
    return macro.temporal_trends(views.headers(spark, sf), "month")


@query
def trend_week(spark, sf):
    return macro.temporal_trends(views.headers(spark, sf), "week", model="gpt-4")


@query
def trend_peak(spark, sf):
    trend = macro.temporal_trends(views.headers(spark, sf), "month", topic="Coding & Debugging")
    return macro.trend_peak(trend)


@query
def count_matches(spark, sf):
    return macro.count_rows(views.headers(spark, sf), topic="Creative Writing", model="gpt-3.5")


@query
def filter_builder(spark, sf):
    keep = build_filters(
        models=["gpt-4", "o1"], topic="Math & Logic", start="1997-01-01", end="1998-12-31", min_turns=5
    )
    return views.fact(spark, sf).filter(keep).select("id", "model_family", "timestamp", "turn_count")


@query
def power_users(spark, sf):
    return users.user_behavior(views.fact(spark, sf), "power_users")


@query
def specialists(spark, sf):
    return _rounded(users.user_behavior(views.fact(spark, sf), "topic_consistency"), "diversity")


@query
def length_outlier(spark, sf):
    return anomaly.anomalies(views.fact(spark, sf), "length_outlier", threshold=10.0)


@query
def length_outlier_one_model(spark, sf):
    return anomaly.length_outliers(views.fact(spark, sf), model="gpt-4", threshold=20.0, limit=5)


@query
def rare_topic(spark, sf):
    return anomaly.anomalies(views.doc_fact(spark, sf), "rare_topic")


@query
def dataset_summary(spark, sf):
    return summary.dataset_summary(views.with_country(views.headers(spark, sf), spark, sf))


@query
def summary_merged(spark, sf):
    """Three batches, one of them run twice, with the first two folded in between."""
    rows = views.with_country(views.headers(spark, sf), spark, sf)
    path = shared_path(spark, "growing")
    for number in (0, 1, 1):
        incremental.append_batch(rows.filter(F.col("key") % 3 == number), path, number)
    incremental.fold(spark, path, 1)
    incremental.append_batch(rows.filter(F.col("key") % 3 == 2), path, 2)
    return incremental.merged_summary(spark, path)


@query
def summary_row(spark, sf):
    """Written by the offline build and read as its summary row."""
    path = shared_path(spark, "corpus")
    tables.write_fact(views.with_country(views.headers(spark, sf), spark, sf), f"{path}/fact")
    build.build_summary(spark, path)
    return build.read_summary(spark, path)


@query
def dist_model(spark, sf):
    return summary.top_models(views.headers(spark, sf))


@query
def dist_topic(spark, sf):
    return summary.top_topics(views.headers(spark, sf))


@query
def dist_country(spark, sf):
    return summary.top_countries(views.with_country(views.headers(spark, sf), spark, sf))


# ---- search ----


@query
def search_filters(spark, sf):
    return search.search_conversations(
        views.doc_fact(spark, sf), topic="Creative Writing", model="gpt-4o", min_turns=3, limit=10
    )


@query
def search_bm25(spark, sf):
    found = search.search_conversations(
        views.doc_fact(spark, sf), params.SEARCH_QUERY, limit=50, stop_words=params.STOP_WORDS
    )
    return _rounded(found, "score")


@query
def search_bm25_filtered(spark, sf):
    found = search.search(
        views.doc_fact(spark, sf), params.SEARCH_QUERY, topic="Coding & Debugging", model="gpt-4o",
        min_turns=2, limit=20, stop_words=params.STOP_WORDS,
    )
    return _rounded(found, "score")


@query
def search_bm25_index(spark, sf):
    docs = views.doc_fact(spark, sf)
    path = shared_path(spark, "index")
    search.write_index(search.build_index(docs, params.STOP_WORDS), path)
    found = search.search_index(
        search.read_index(spark, path), docs, params.SEARCH_QUERY, limit=50,
        stop_words=params.STOP_WORDS,
    )
    return _rounded(found, "score")


@query
def search_bm25_stemmed(spark, sf):
    docs = views.doc_fact(spark, sf)
    path = shared_path(spark, "index")
    search.write_index(search.build_index(docs, params.STOP_WORDS, stems=True), path)
    found = search.search_index(
        search.read_index(spark, path), docs, params.SEARCH_QUERY, limit=50,
        stop_words=params.STOP_WORDS, stems=True,
    )
    return _rounded(found, "score")


_built: dict[tuple, block_search.BlockIndex] = {}


def _block_index(spark, sf, stems: bool) -> block_search.BlockIndex:
    """Built once for all questions of a session."""
    key = (spark.sparkContext.applicationId, sf, stems)
    if key not in _built:
        path = shared_path(spark, "blocks")
        _built[key] = block_search.write_blocks(views.doc_fact(spark, sf), path, params.STOP_WORDS, stems, blocks=16)
    return _built[key]


@query
def search_blocks(spark, sf):
    found = block_search.search_blocks(
        _block_index(spark, sf, False), views.doc_fact(spark, sf), params.SEARCH_QUERY, limit=50, stop_words=params.STOP_WORDS
    )
    return _rounded(found, "score")


@query
def search_blocks_filtered(spark, sf):
    found = block_search.search_blocks(
        _block_index(spark, sf, False), views.doc_fact(spark, sf), params.SEARCH_QUERY, topic="Coding & Debugging",
        model="gpt-4o", min_turns=2, limit=20, stop_words=params.STOP_WORDS,
    )
    return _rounded(found, "score")


@query
def search_blocks_stemmed(spark, sf):
    found = block_search.search_blocks(
        _block_index(spark, sf, True), views.doc_fact(spark, sf), params.SEARCH_QUERY, limit=50, stop_words=params.STOP_WORDS
    )
    return _rounded(found, "score")


@query
def block_maxima(spark, sf):
    """What the index says of each root: documents, and the largest saturation over all blocks."""
    index = _block_index(spark, sf, False)
    tops = index.maxima.groupBy("root").agg(F.max("top").alias("top"))
    return _rounded(tops.join(index.roots, "root").select(F.col("root").alias("term"), "doc_freq", "top"), "top")


@query
def search_stems(spark, sf):
    """Straight from the texts."""
    found = search.search(
        views.doc_fact(spark, sf), params.SEARCH_QUERY, limit=50, stop_words=params.STOP_WORDS, stems=True
    )
    return _rounded(found, "score")


@query
def count_bm25_stemmed(spark, sf):
    return search.count_matches(
        views.doc_fact(spark, sf), params.SEARCH_QUERY, model="gpt-4o", stop_words=params.STOP_WORDS, stems=True
    )


@query
def count_bm25(spark, sf):
    return search.count_matches(
        views.doc_fact(spark, sf), params.SEARCH_QUERY, model="gpt-4o", stop_words=params.STOP_WORDS
    )


@query
def tokenize(spark, sf):
    docs = views.documents(spark, sf)
    found = tokens(F.col("text"), params.STOP_WORDS)
    return docs.select("doc_id", found.alias("t")).select(
        "doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest")
    )


@query
def build_index(spark, sf):
    index = search.build_index(views.doc_fact(spark, sf), params.STOP_WORDS)
    return index.postings.select("term", "id", "length", "tf")


@query
def index_terms(spark, sf):
    index = search.build_index(views.doc_fact(spark, sf), params.STOP_WORDS)
    return index.terms.select("term", "doc_freq")


@query
def index_stats(spark, sf):
    index = search.build_index(views.doc_fact(spark, sf), params.STOP_WORDS)
    return _rounded(index.stats, "mean_length")


# ---- cleaning ----


def _clean_columns(rows: DataFrame) -> DataFrame:
    """Long texts as digests to keep the result small."""
    return rows.withColumns(
        {c: F.md5(c) for c in ("search_text", "first_turn", "full_content")}
    )


@query
def clean_records(spark, sf):
    return _clean_columns(clean.clean_records(views.raw(spark, sf)))


@query
def stream_ingest(spark, sf):
    path = shared_path(spark, "ingest")
    ingest.finish(
        ingest.stream_ingest(views.raw_stream(spark, sf), f"{path}/fact", f"{path}/checkpoint")
    )
    return _clean_columns(tables.read_fact(spark, f"{path}/fact"))


@query
def stream_totals(spark, sf):
    """What a watch has added up of an ingest: rows read and rows kept."""
    path = shared_path(spark, "watched")
    raw = watch.observed(views.raw_stream(spark, sf), "read")
    with watch.Watch(spark) as seen:
        rows = watch.observed(clean.clean_records(raw), "kept").writeStream.format("parquet").option("path", f"{path}/fact")
        query = rows.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
        totals = seen.totals(ingest.finish(query))
    counts = [(totals.rows, totals.observed["read.rows"], totals.observed["kept.rows"])]
    written = tables.read_fact(spark, f"{path}/fact").agg(F.count(F.lit(1)).alias("written"))
    return written.select(*[F.lit(n).cast("long").alias(c) for c, n in zip(("rows", "rows_read", "rows_kept"), counts[0], strict=True)], "written")


@query
def stream_once(spark, sf):
    """All records arrive, then all again in other files after a restart: each id is written once."""
    path = shared_path(spark, "once")
    docs = views.table(spark, sf, "documents")
    for _ in range(2):
        docs.write.mode("append").parquet(f"{path}/in")
        raw = views.raw_from(spark.readStream.schema(docs.schema).parquet(f"{path}/in"))
        ingest.finish(ingest.stream_batches(ingest.once(clean.clean_records(raw)), f"{path}/out", f"{path}/state"))
    return _clean_columns(tables.read_fact(spark, f"{path}/out/batch=*"))


@query
def resume_skip(spark, sf):
    done = views.table(spark, sf, "labels").select(F.md5(F.col("doc_id").cast("string")).alias("id"))
    return ingest.skip_done(views.doc_fact(spark, sf).select("id", "model_family", "topic"), done)


@query
def fact_written(spark, sf):
    """Half of the records written, the rest appended, and all read back."""
    path = shared_path(spark, "fact")
    fact = clean.clean_records(views.raw(spark, sf))
    half = F.substring("id", 1, 1) < "8"
    tables.write_fact(fact.filter(half), path)
    tables.append_fact(fact.filter(~half), path)
    return _clean_columns(tables.read_fact(spark, path))


@query
def fact_interleaved(spark, sf):
    """Written in interleaved order and read back."""
    path = shared_path(spark, "interleaved")
    interleave.write_interleaved(views.doc_fact(spark, sf), path)
    return tables.read_fact(spark, path).groupBy("topic", "model_family").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )


@query
def distinct_users(spark, sf):
    """Exact counts, and whether the ones from merged sketches are within their error."""
    fact = views.fact(spark, sf)
    exact = sketches.distinct_users(fact)
    fine = sketches.user_sketches(fact, ["topic", "model_family"])
    near = sketches.estimated_users(sketches.merged_sketches(fine, ["topic"])).withColumnRenamed("n_users", "near")
    off = F.abs(F.col("near") - F.col("n_users"))
    joined = exact.join(near.withColumnRenamed("topic", "t"), F.col("topic").eqNullSafe(F.col("t")))
    return joined.select("topic", "n_users", (off <= F.greatest(F.lit(1.0), sketches.ERROR * F.col("n_users"))).alias("within"))


@query
def conversation_by_id_written(spark, sf):
    """Through the written table, whose files have Bloom filters on the id."""
    path = shared_path(spark, "fact")
    tables.write_fact(clean.clean_records(views.raw(spark, sf)), path)
    found = lookup.conversation_by_id(tables.read_fact(spark, path), _some_id())
    return found.select("id", F.md5("full_content").alias("digest"))


@query
def topic_info_csv(spark, sf):
    path = shared_path(spark, "topics")
    counted = views.clustered_docs(spark, sf).groupBy(F.col("cluster_id").cast("int").alias("topic_id")).agg(
        F.count(F.lit(1)).alias("count"), F.concat(F.lit('a "b", '), F.min("source")).alias("name")
    )
    tables.write_csv(counted, path)
    return readers.read_topic_info(spark, path)


@query
def model_docs(spark, sf):
    docs = topics.model_docs(views.doc_fact(spark, sf))
    return docs.select(tx.short_id(F.col("id")).alias("short"), F.md5(tx.one_line(F.col("search_text"))).alias("digest"))


@query
def clean_whitespace(spark, sf):
    docs = views.documents(spark, sf)
    spaced = F.concat(F.lit(" \t"), F.replace("text", F.lit(" "), F.lit(" \r\n ")), F.lit("\n"))
    return docs.select("doc_id", F.md5(tx.clean_whitespace(spaced)).alias("digest"))


@query
def model_family(spark, sf):
    rows = views.headers(spark, sf).select("id", "model")
    return (
        models.with_model_family(rows)
        .groupBy("model", "model_family", "model_release_date")
        .agg(F.count(F.lit(1)).alias("count"))
    )


@query
def topic_keywords(spark, sf):
    docs = views.documents(spark, sf)
    return docs.select(
        "doc_id",
        keyword_topic(F.col("text")).alias("topic"),
        keyword_topic(F.col("text"), params.CORPUS_RULES).alias("corpus_topic"),
    )


@query
def conversation_by_id(spark, sf):
    fact = clean.clean_records(views.raw(spark, sf))
    found = lookup.conversation_by_id(fact, _some_id())
    return found.select("id", F.md5("full_content").alias("digest"))


@query
def conversation_content(spark, sf):
    fact = clean.clean_records(views.raw(spark, sf))
    found = lookup.conversation_content(fact, _some_id())
    return found.select(
        "id",
        "model",
        "topic",
        "message_count",
        F.md5("search_text").alias("digest"),
        F.posexplode("conversation").alias("position", "turn"),
    ).select(
        "id", "model", "topic", "message_count", "digest", "position", "turn.role", "turn.content"
    )


def _some_id() -> str:
    import hashlib

    return hashlib.md5(b"2").hexdigest()


# ---- corpus statistics ----


@query
def top_categories(spark, sf):
    return freq.top_categories(views.annotation_rows(spark, sf))


@query
def top_languages(spark, sf):
    return freq.top_languages(views.annotation_rows(spark, sf))


@query
def top_errors(spark, sf):
    return freq.top_errors(views.annotation_rows(spark, sf))


@query
def freq_report(spark, sf):
    return freq.freq_report(views.annotation_rows(spark, sf))


@query
def title_case(spark, sf):
    docs = views.documents(spark, sf)
    return docs.select("doc_id", F.md5(tx.title_case(F.col("text"))).alias("digest"))


@query
def length_profile(spark, sf):
    return lengths.length_profile_long(views.table(spark, sf, "conversations"))


@query
def length_profile_nested(spark, sf):
    return lengths.length_profile(views.raw(spark, sf))


@query
def length_describe(spark, sf):
    profile = lengths.length_profile_long(views.table(spark, sf, "conversations"))
    return _rounded(lengths.length_describe(profile), "mean", "std", "p50", "p75", "p90", "p95")


@query
def avg_words_by_topic(spark, sf):
    docs = views.documents(spark, sf)
    return _rounded(lengths.avg_words_by_topic(docs, "source", "text"), "avg_words")


@query
def model_bucket(spark, sf):
    rows = views.headers(spark, sf).groupBy("model").agg(F.count(F.lit(1)).alias("count"))
    return rows.select("model", models.model_bucket(F.col("model")).alias("bucket"), "count")


@query
def stratified_first_n(spark, sf):
    chosen = style.stratified_first_n(style.first_messages(views.raw(spark, sf)), n=100)
    return chosen.select("id", "model", F.md5("text").alias("digest"))


def _styled(spark, sf) -> DataFrame:
    return style.with_style(style.bucketed(style.first_messages(views.raw(spark, sf))))


@query
def style_features(spark, sf):
    styled = _styled(spark, sf).drop("text")
    return _rounded(styled, "lexical_diversity", "avg_word_len")


@query
def style_by_model(spark, sf):
    return _rounded(style.style_by_model(_styled(spark, sf)), *style.FEATURES)


@query
def style_extremes(spark, sf):
    found = style.style_extremes(style.style_by_model(_styled(spark, sf)))
    return _rounded(found, "longest_words", "coder_percent")


# ---- topics ----


@query
def normalize_vectors(spark, sf):
    unit = topics.normalize_vectors(views.table(spark, sf, "embeddings"))
    return _rounded(
        unit.select("vec_id", F.posexplode("embedding").alias("position", "value")), "value"
    )


@query
def pca(spark, sf):
    """What holds whatever the signs of the components: centred, uncorrelated with the first, and
    no more spread than the one before."""
    reduced = topics.pca(views.table(spark, sf, "embeddings")).select("vec_id", "reduced")
    rows = reduced.select(F.get("reduced", F.lit(0)).alias("first"), F.posexplode("reduced").alias("component", "value"))
    facts = rows.groupBy("component").agg(
        F.count(F.lit(1)).alias("n"),
        F.abs(F.round(F.avg("value"), 6)).alias("mean"),
        F.var_samp("value").alias("spread"),
        F.corr("first", "value").alias("with_first"),
    )
    before = Window.orderBy("component")  # a handful of rows
    return facts.select(
        "component", "n", "mean",
        (F.col("spread") <= F.coalesce(F.lag("spread").over(before), F.col("spread"))).alias("ordered"),
        F.when(F.col("component") == 0, F.abs(F.col("with_first") - 1) < 1e-6)
        .otherwise(F.abs(F.col("with_first")) < 1e-6).alias("uncorrelated"),
    )


@query
def kmeans(spark, sf):
    reduced = topics.pca(views.table(spark, sf, "embeddings"))
    clustered, centres = topics.kmeans_with_centres(reduced)
    known = F.col("cluster_id").between(0, topics.CLUSTERS - 1)
    return clustered.select("vec_id", topics.is_nearest(centres).alias("nearest"), known.alias("known"))


@query
def minibatch_kmeans(spark, sf):
    vectors = views.table(spark, sf, "embeddings")
    clustered = minibatch.minibatch_kmeans(vectors, 10, column="embedding", id="vec_id", batch_rows=256, steps=12, patience=None)
    return clustered.select("vec_id", "cluster_id")


@query
def density_topics(spark, sf):
    vectors = views.table(spark, sf, "embeddings").select("vec_id", F.slice("embedding", 1, 3).alias("start"))
    return density.density_topics(vectors, 0.06, 12, "start", "vec_id")


@query
def cluster_samples(spark, sf):
    samples = topics.cluster_samples(views.clustered_docs(spark, sf))
    return samples.select("cluster_id", F.posexplode("samples").alias("position", "text")).select(
        "cluster_id", "position", F.md5("text").alias("digest")
    )


@query
def cluster_keywords(spark, sf):
    return topics.cluster_keywords(views.clustered_docs(spark, sf), stop_words=params.STOP_WORDS)


@query
def cluster_keywords_whole_words(spark, sf):
    return topics.cluster_keywords(views.clustered_docs(spark, sf), top=3, pattern=topics.WORD)


@query
def long_prompts(spark, sf):
    messages = style.first_messages(views.raw(spark, sf)).filter(more_words(F.col("text"), 3))
    return messages.groupBy("model").agg(F.count(F.lit(1)).alias("count"))


@query
def cluster_keywords_chat(spark, sf):
    stop = [*params.STOP_WORDS, *topics.CHAT_STOP_WORDS]
    docs = views.clustered_docs(spark, sf).withColumn(
        "search_text", F.concat(F.lit("Please HELP me write code: "), "search_text")
    )
    return topics.cluster_keywords(docs, stop_words=stop)


@query
def cluster_labels(spark, sf):
    lists = topics.keyword_lists(topics.cluster_keywords(views.clustered_docs(spark, sf)))
    short = topics.keyword_labels(lists).withColumnRenamed("label", "keyword_label")
    return topics.cluster_labels(lists, params.CLUSTER_RULES).join(short, "cluster_id")


@query
def clean_label(spark, sf):
    docs = views.documents(spark, sf)
    answer = F.concat(F.lit(' "Label: '), "text", F.lit("'\nBecause it is so."))
    return docs.select("doc_id", F.md5(tx.clean_label(answer)).alias("digest"))


@query
def ngram_counts(spark, sf):
    docs = views.documents(spark, sf)
    return topics.ngram_counts(docs, "text", stop_words=params.STOP_WORDS)


def _merged(spark, sf) -> DataFrame:
    docs = views.clustered_docs(spark, sf).withColumnRenamed("cluster_id", "topic_id")
    return topics.merge_small_topics(docs, min_size=45)


@query
def ctfidf(spark, sf):
    return _rounded(
        topics.topic_terms(_merged(spark, sf), stop_words=params.STOP_WORDS, min_topics=2), "weight"
    )


@query
def topic_info(spark, sf):
    docs = _merged(spark, sf)
    return topics.topic_info(docs, topics.topic_names(topics.topic_terms(docs)))


@query
def dedup_keep_last(spark, sf):
    events = views.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return topics.dedup_keep_last(events, "user_id", "event_id")


@query
def topic_updates(spark, sf):
    docs = views.clustered_docs(spark, sf).select(
        F.col("source").alias("id"), "cluster_id", F.col("id").alias("seq")
    )
    labels = views.table(spark, sf, "embeddings").groupBy(F.col("label").alias("cluster_id")).agg(
        F.concat(F.lit("Topic "), F.first("label").cast("string")).alias("label")
    )
    return topics.topic_updates(docs, labels, order="seq")


@query
def apply_topics(spark, sf):
    quality = views.table(spark, sf, "labels").select(
        F.md5(F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("quality") == 1, "Good").otherwise("Poor").alias("new_topic"),
    )
    return topics.apply_topics(views.doc_fact(spark, sf), quality).select("id", "topic")


@query
def topics_rewritten(spark, sf):
    """Written in buckets, rewritten twice, and read from the files."""
    labels = views.table(spark, sf, "labels").withColumn("id", F.md5(F.col("doc_id").cast("string")))
    quality = labels.select("id", F.when(F.col("quality") == 1, "Good").otherwise("Poor").alias("new_topic"))
    toxic = labels.filter("toxic = 1").select("id", F.lit("Toxic").alias("new_topic"))
    path = shared_path(spark, "rewritten")
    buckets.write_bucketed(views.doc_fact(spark, sf), f"{path}/0", 8)
    buckets.rewrite_topics(spark, f"{path}/0", f"{path}/1", quality, 8)
    buckets.rewrite_topics(spark, f"{path}/1", f"{path}/2", toxic, 8)
    fact = buckets.fact_of(buckets.open_bucketed(spark, f"{path}/2", 8))
    return fact.select("id", "topic", "turn_count", F.md5("search_text").alias("digest"))


@query
def sample_fixed(spark, sf):
    return topics.sample_fixed(views.headers(spark, sf).select("id", "topic"), 100)


# ---- text, annotations, JSON, SQL ----


@query
def extract_code(spark, sf):
    texts = views.fenced_texts(spark, sf)
    return texts.select("doc_id", F.md5(tx.extract_code(F.col("text"))).alias("digest"))


@query
def text_before_code(spark, sf):
    return views.fenced_texts(spark, sf).select(
        "doc_id", tx.text_before_code(F.col("text")).alias("intro")
    )


@query
def extract_json(spark, sf):
    return views.fenced_texts(spark, sf).select(
        "doc_id", F.array_join(tx.json_objects(F.col("text")), "|").alias("objects")
    )


@query
def trim_middle(spark, sf):
    trimmed = tx.trim_middle(F.col("text"))
    docs = views.documents(spark, sf)
    return docs.select("doc_id", F.length(trimmed).alias("n"), F.md5(trimmed).alias("digest"))


@query
def parse_annotation(spark, sf):
    rows = views.answers(spark, sf)
    return annotate.parse_answers(rows).select("event_id", "category", "language", "error")


@query
def annotate_prompts(spark, sf):
    prompts = annotate.eligible_prompts(views.raw(spark, sf))
    answer = annotate.keyword_answer(
        F.col("prompt"), params.ANNOTATION_CATEGORIES, params.ANNOTATION_LANGUAGES
    )
    return annotate.annotations(prompts.withColumn("answer", answer))


@query
def annotations_csv(spark, sf):
    """Appended as CSV and read back; the text None is no gap."""
    path = shared_path(spark, "annotations")
    tables.write_csv(annotate_prompts(spark, sf), path, append=True)
    return readers.read_annotations(spark, path)


@query
def profile_json(spark, sf):
    events = views.table(spark, sf, "events").select("event_type", "event_id", "props")
    return readers.profile_json_items(events, "event_type", "event_id", "props")


@query
def profile_json_folder(spark, sf):
    """Through written files, each a list of the events of one range of 2,000 ids."""
    events = views.table(spark, sf, "events").select("event_id", "event_type", "user_id")
    record = F.to_json(F.struct("event_id", "event_type", "user_id"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("event_id", record.alias("record")))), lambda r: r["record"])
    lists = events.groupBy(F.floor(F.col("event_id") / 2000).alias("part")).agg(listed.alias("records"))
    path = shared_path(spark, "event-lists")
    text = F.concat(F.lit("["), F.array_join("records", ",\n"), F.lit("]")).alias("value")
    lists.select(text).write.option("maxRecordsPerFile", 1).text(path)
    return readers.profile_json(spark, path).select(
        F.get_json_object("first_item", "$.event_id").cast("long").alias("first_id"),
        F.get_json_object("first_item", "$.event_type").alias("first_type"),
        "num_items",
        "keys",
    )


@query
def json_records(spark, sf):
    rows = views.headers(spark, sf).select("id", "topic", "timestamp")
    return tables.json_records(rows)


@query
def guarded_sql(spark, sf):
    return sandbox.guarded_sql(
        spark,
        "SELECT topic, model_family, count(*) AS n, max(turn_count) AS longest FROM chats "
        "WHERE search_text LIKE '%ing%' AND topic <> 'General / Noise' AND turn_count > 3 "
        "GROUP BY topic, model_family ORDER BY n DESC, topic, model_family",
        {"chats": views.doc_fact(spark, sf)},
    )
