"""From raw chat records to the fact table, one row at a time, without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.models import with_model_family
from parley.functions.text import clean_whitespace
from parley.functions.topics import TOPIC_KEYWORDS, keyword_topic
from parley.schemas import FACT, conform

CHARS_PER_TOKEN = 4


def user_texts(conversation: Column) -> Column:
    """Whitespace-cleaned contents of the user turns that have any content.

    A turn of spaces only has content, so it stays in the list as ''.
    """
    from_user = F.filter(conversation, lambda t: (t["role"] == "user") & (t["content"] != ""))
    return F.transform(from_user, lambda t: clean_whitespace(t["content"]))


def has_user_text(conversation: Column) -> Column:
    """Whether ``user_texts`` finds anything, without building the texts."""
    return F.exists(conversation, lambda t: (t["role"] == "user") & (t["content"] != ""))


def estimated_tokens(conversation: Column) -> Column:
    """A quarter of the characters of all turns, truncated."""
    chars = F.aggregate(
        conversation,
        F.lit(0).cast("long"),
        lambda total, t: total + F.coalesce(F.length(t["content"]), F.lit(0)),
    )
    return F.floor(chars / CHARS_PER_TOKEN).cast("int")


def parse_timestamp(c: Column) -> Column:
    """Timestamp without zone; NULL where the text is none."""
    return F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")


def clean_records(
    raw: DataFrame,
    language: str = "English",
    rules: Mapping[str, Sequence[str]] = TOPIC_KEYWORDS,
) -> DataFrame:
    """Records of one language that have user text, as fact rows. Works on streams too."""
    texts = F.col("_texts")
    kept = (
        raw.filter((F.col("language") == language) & has_user_text(F.col("conversation")))
        .withColumn("_texts", user_texts(F.col("conversation")))
        .withColumn("search_text", F.array_join(texts, " "))
        .withColumn("timestamp", parse_timestamp(F.col("timestamp")))
    )
    ts = F.col("timestamp")
    fact = with_model_family(kept).select(
        F.col("conversation_hash").alias("id"),
        "model",
        "model_release_date",
        "model_family",
        "timestamp",
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        "hashed_ip",
        "country",
        "state",
        F.col("turn").alias("turn_count"),
        estimated_tokens(F.col("conversation")).alias("token_count"),
        keyword_topic(F.col("search_text"), rules).alias("topic"),
        "search_text",
        F.substring(F.element_at(texts, 1), 1, 200).alias("first_turn"),
        F.to_json("conversation", {"ignoreNullFields": "false"}).alias("full_content"),
    )
    return conform(fact, FACT)


def first_user_message(conversation: Column) -> Column:
    """Content of the first turn if that turn is a user's and not empty, else NULL."""
    first = F.try_element_at(conversation, F.lit(1))
    return F.when((first["role"] == "user") & (first["content"] != ""), first["content"])


def counted(raw: DataFrame, fact: DataFrame):
    """Both sides observed: rows read and rows kept, available once an action has run."""
    from pyspark.sql import Observation

    read, kept = Observation("read"), Observation("kept")
    return (
        raw.observe(read, F.count(F.lit(1)).alias("rows")),
        fact.observe(kept, F.count(F.lit(1)).alias("rows")),
        read,
        kept,
    )
