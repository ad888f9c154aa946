"""Writing style by model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.models import model_bucket
from parley.functions.text import style_features, words
from parley.functions.topn import first_n
from parley.operators.clean import first_user_message

FEATURES = ("word_count", "lexical_diversity", "avg_word_len", "has_code", "has_list")


def first_messages(raw: DataFrame, language: str = "English") -> DataFrame:
    """``(id, model, text)`` of the records in one language that open with a user message."""
    return (
        raw.filter(F.col("language") == language)
        .select(
            F.col("conversation_hash").alias("id"),
            "model",
            first_user_message(F.col("conversation")).alias("text"),
        )
        .filter(F.col("text").isNotNull())
    )


def bucketed(messages: DataFrame) -> DataFrame:
    """All messages, with the bucket of their model in its place."""
    return messages.withColumn("model", model_bucket(F.col("model")))


def stratified_first_n(messages: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The first ``n`` messages of each model bucket in record order."""
    return first_n(bucketed(messages), by=["model"], order=order, n=n)


def with_style(messages: DataFrame, text: str = "text") -> DataFrame:
    """Adds the features; the words are a column of their own so they are split once."""
    split = messages.withColumn("_words", words(F.col(text)))
    return split.withColumns(style_features(F.col(text), F.col("_words"))).drop("_words")


def style_by_model(styled: DataFrame) -> DataFrame:
    """Mean of each feature per model bucket."""
    return styled.groupBy("model").agg(*[F.avg(f).alias(f) for f in FEATURES])


def style_extremes(means: DataFrame) -> DataFrame:
    """Longest, most code-heavy and most repetitive bucket; the first in order among equals."""

    def most(column: str) -> Column:
        return F.min(F.struct((-F.col(column)).alias("v"), F.col("model")))

    repetitive = F.min(F.struct("lexical_diversity", "model"))
    return means.agg(
        most("word_count")["model"].alias("longest_model"),
        (-most("word_count")["v"]).alias("longest_words"),
        most("has_code")["model"].alias("coder_model"),
        (-most("has_code")["v"] * 100).alias("coder_percent"),
        repetitive["model"].alias("repetitive_model"),
    )
