"""The given tables, and views of them in the shape of chat records and of the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.models import with_model_family

LANGUAGES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts, split as their files are."""
    return table(spark, sf_dir, "documents")


def _hash(c: Column) -> Column:
    return F.md5(c.cast("string"))


def _choose(number: Column, names: list[str | None]) -> Column:
    """The name at a position, the last one beyond the list."""
    chosen = F.lit(names[-1])
    for i, name in reversed(list(enumerate(names[:-1]))):
        chosen = F.when(number == i, F.lit(name)).otherwise(chosen)
    return chosen


MODELS = [
    "gpt-4o", "gpt-4o-mini", "gpt-4-0314", "gpt-4", "gpt-3.5-turbo", "gpt-3.5-turbo-0301", "o1-mini",
    "gpt-4.1-mini-2025-04-14", "unlisted-model",
]


def _topic(key: Column, mixed: Column) -> Column:
    part = mixed % 23
    return (
        F.when(key < 20, F.lit("Rare Niche"))
        .when(part == 0, F.lit(None))
        .when(part == 1, F.lit("General / Noise"))
        .when(part < 9, F.lit("Coding & Debugging"))
        .when(part < 14, F.lit("Creative Writing"))
        .when(part < 18, F.lit("Math & Logic"))
        .when(part < 21, F.lit("Advice & Life"))
        .otherwise(F.lit("General"))
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One conversation per order: id, model, family, time, user, topic."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = orders.select(
        k.alias("key"),
        F.col("o_custkey").alias("user_key"),
        _hash(k).alias("id"),
        _choose(k % 9, MODELS).alias("model"),
        F.when(k % 211 != 0, F.col("o_orderdate")).alias("timestamp"),
        _hash(F.col("o_custkey")).alias("hashed_ip"),
        _topic(k, k + F.col("o_custkey")).alias("topic"),
        F.concat_ws(
            " ", "o_orderpriority", F.lit("order"), k.cast("string"), "o_orderstatus"
        ).alias("search_text"),
    )
    return with_model_family(rows)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``headers`` with turn and token counts from the order's lines."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("key"))
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    )
    longer = F.when(F.col("key") % 1000 == 7, 40).otherwise(1)
    return (
        headers(spark, sf_dir)
        .join(lines, "key", "left")
        .withColumn("turn_count", (F.coalesce("lines", F.lit(1)) * longer).cast("int"))
        .withColumn("token_count", (F.coalesce("quantity", F.lit(0.0)) * 10).cast("int"))
        .drop("lines", "quantity")
    )


def with_country(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_key"), "c_nationkey"
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    return rows.join(customers.join(nations, "c_nationkey", "left"), "user_key", "left")


def doc_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One conversation per document, with the document as its text."""
    k = F.col("doc_id")
    rows = documents(spark, sf_dir).select(
        k.alias("key"),
        _hash(k).alias("id"),
        _choose(k % 9, MODELS).alias("model"),
        F.when(
            k % 211 != 0,
            F.lit("2024-01-01").cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), (k % 500_000).cast("int")),
        ).alias("timestamp"),
        _topic(k, k).alias("topic"),
        (1 + k % 13).cast("int").alias("turn_count"),
        F.col("text").alias("search_text"),
    )
    return with_model_family(rows)


def raw_from(documents: DataFrame) -> DataFrame:
    """One raw chat record per document; its lines are the turns, users and assistants in turn."""
    k = F.col("doc_id")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")

    def turn(line: Column, i: Column) -> Column:
        kind = (k + i) % 7
        content = (
            F.when(kind == 3, F.concat(F.lit("- "), line))
            .when(kind == 5, F.concat(F.lit("```\n"), line, F.lit("\n```")))
            .when(kind == 6, F.concat(F.lit("  "), line, F.lit(" \t ValueError: end ")))
            .otherwise(line)
        )
        role = F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
        return F.struct(role.alias("role"), content.alias("content"))

    lines = F.split("text", "\n")
    written = F.concat(
        F.lit("2024-"), two(1 + k % 12), F.lit("-"), two(1 + k % 28), F.lit(" "), two(k % 24),
        F.lit(":15:00"),
    )
    language = F.lit(None)
    for code, name in LANGUAGES.items():
        language = F.when(F.col("lang") == code, F.lit(name)).otherwise(language)
    return documents.select(
        _hash(k).alias("conversation_hash"),
        _choose(
            k % 7,
            [
                "gpt-4o-2024-08-06", "gpt-4-0314", "gpt-3.5-turbo-0613", "o1-mini", "unlisted-model",
                "gpt-4.1-mini-2025-04-14", None,
            ],
        ).alias("model"),
        F.when(k % 50 == 0, F.lit("not a time")).when(k % 50 != 1, written).alias("timestamp"),
        language.alias("language"),
        _hash(F.col("source")).alias("hashed_ip"),
        F.upper("lang").alias("country"),
        F.lit(None).cast("string").alias("state"),
        F.floor((F.size(lines) + 1) / 2).cast("int").alias("turn"),
        F.transform(lines, turn).alias("conversation"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(documents(spark, sf_dir))


def raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as a stream; the pattern matches the table as a file or as a folder."""
    schema = table(spark, sf_dir, "documents").schema
    return raw_from(spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]"))


def clustered_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the label of their embedding as cluster, -1 without one."""
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("search_text"),
        "source",
        F.coalesce("label", F.lit(-1)).alias("cluster_id"),
    )


def annotation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One annotation per event, with gaps, odd cases and placeholder values."""
    k = F.col("event_id")
    number = F.col("number")
    # Parsed once: a column of its own that several expressions use is not written into them.
    parsed = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").withColumn("number", parsed).select(
        F.col("event_type").alias("prompt_preview"),
        F.when(k % 17 != 0, F.concat(F.lit(" "), "event_type", F.lit(" c/c++ don't"))).alias("category"),
        _choose(
            number % 11,
            [
                "python", "c/c++", "None", "javaSCRIPT", None, "unknown", "SQL", "vba 6a", "null",
                "other", "r",
            ],
        ).alias("language"),
        F.when(number % 5 == 0, F.lit(None))
        .when(number % 5 == 1, F.lit("abc"))
        .when(number % 5 == 2, F.lit("Unknown"))
        .otherwise(F.concat(F.lit(" Error "), (number % 40).cast("string"), F.lit(": "), "event_type"))
        .alias("error"),
    )


def fenced_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an answer with code blocks and JSON around it."""
    k = F.col("doc_id")
    key = k.cast("string")
    newline = F.lit("\n")
    text = (
        F.when(
            k % 3 == 0,
            F.concat(
                F.lit(" Intro "), "source", F.lit(" \n```python\nx = "), key, F.lit("\n```\nthen\n```\n"),
                "text", F.lit("\n```\nend {\"k\": "), key, F.lit(", \"s\": \"v\"} and {bad}"),
            ),
        )
        .when(
            k % 3 == 1,
            F.concat(F.lit("```\n\ny = "), key, F.lit("\n\n``` {\"a\": {\"b\": 1}} {\"c\": [1, 2]} "), "text"),
        )
        .otherwise(F.concat("text", newline, F.lit("{}")))
    )
    return documents(spark, sf_dir).select("doc_id", text.alias("text"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model answer per event, from well formed to unreadable."""
    k = F.col("event_id")
    cat = F.concat(F.lit('{"cat": "'), "event_type", F.lit('", "lang": "L'), (k % 10).cast("string"))
    answer = (
        F.when(k % 6 == 0, F.concat(F.lit(" ```json\n"), cat, F.lit('", "err": "None"}\n``` ')))
        .when(k % 6 == 1, F.concat(cat, F.lit('", "err": null}')))
        .when(k % 6 == 2, F.concat(cat, F.lit('"}')))
        .when(k % 6 == 3, F.concat(F.lit("["), cat, F.lit('"}]')))
        .when(k % 6 == 4, F.concat(cat, F.lit('", "err": ')))
        .otherwise(F.lit("{}"))
    )
    return table(spark, sf_dir, "events").select(k, F.col("event_type").alias("prompt"), answer.alias("answer"))
