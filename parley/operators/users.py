"""User segments by hashed address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.topics import NOISE_TOPIC

BEHAVIOURS = ("power_users", "topic_consistency")


def _per_user_topic(fact: DataFrame) -> DataFrame:
    """One row per user and topic; a user with many rows is combined before the shuffle."""
    return (
        fact.filter(F.col("topic") != NOISE_TOPIC)
        .groupBy("hashed_ip", "topic")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("turn_count").alias("turns"),
            F.count("turn_count").alias("n_turns"),
        )
    )


def _most_frequent():
    """Topic with the highest count, the first in order among equals."""
    return F.min(F.struct((-F.col("n")).alias("n"), F.col("topic")))["topic"]


def power_users(fact: DataFrame, limit: int = 10) -> DataFrame:
    """Users with the most conversations, their favourite topic and average turns."""
    mean_turns = F.try_divide(F.sum("turns"), F.sum("n_turns"))
    return (
        _per_user_topic(fact)
        .groupBy("hashed_ip")
        .agg(
            F.sum("n").alias("total_convos"),
            _most_frequent().alias("favorite_topic"),
            F.rint(mean_turns).cast("int").alias("avg_turns"),
        )
        .orderBy(F.desc("total_convos"), F.asc_nulls_last("hashed_ip"))
        .limit(limit)
    )


def specialists(fact: DataFrame, more_than: int = 10, limit: int = 10) -> DataFrame:
    """Recurring users by topics per conversation, the most focused first."""
    return (
        _per_user_topic(fact)
        .groupBy("hashed_ip")
        .agg(
            F.sum("n").alias("total_convos"),
            F.count(F.lit(1)).alias("distinct_topics"),
            _most_frequent().alias("main_interest"),
        )
        .filter(F.col("total_convos") > more_than)
        .withColumn("diversity", F.col("distinct_topics") / F.col("total_convos"))
        .orderBy("diversity", F.desc("total_convos"), F.asc_nulls_last("hashed_ip"))
        .limit(limit)
    )


def user_behavior(fact: DataFrame, kind: str = "power_users", limit: int = 10) -> DataFrame:
    if kind not in BEHAVIOURS:
        raise ValueError(f"kind must be one of {BEHAVIOURS}, not {kind!r}")
    return power_users(fact, limit) if kind == "power_users" else specialists(fact, limit=limit)
