"""Conversation lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.quantiles import exact_quantiles
from parley.functions.text import words

MULTI_TURN = 4
METRICS = ("num_turns", "user_turns", "assistant_turns", "total_chars")
PROBS = (0.5, 0.75, 0.9, 0.95)


def length_profile(raw: DataFrame, min_messages: int = 2) -> DataFrame:
    """Message counts, characters and a multi-turn flag per nested record; no shuffle."""
    turns = F.col("conversation")
    chars = F.aggregate(
        turns,
        F.lit(0).cast("long"),
        lambda total, t: total + F.coalesce(F.length(t["content"]), F.lit(0)),
    )
    return (
        raw.filter(F.size(turns) >= min_messages)
        .select(
            F.col("conversation_hash").alias("id"),
            F.size(turns).cast("long").alias("num_turns"),
            F.size(F.filter(turns, lambda t: t["role"] == "user")).cast("long").alias("user_turns"),
            F.size(F.filter(turns, lambda t: t["role"] == "assistant"))
            .cast("long")
            .alias("assistant_turns"),
            chars.alias("total_chars"),
        )
        .withColumn("is_multi_turn", F.col("num_turns") >= MULTI_TURN)
    )


def length_profile_long(turns: DataFrame, min_messages: int = 2) -> DataFrame:
    """The same from one row per turn; only sums move, so long conversations do no harm."""
    return (
        turns.groupBy(F.col("conv_id").alias("id"))
        .agg(
            F.count(F.lit(1)).alias("num_turns"),
            F.count_if(F.col("role") == "user").alias("user_turns"),
            F.count_if(F.col("role") == "assistant").alias("assistant_turns"),
            F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("total_chars"),
        )
        .filter(F.col("num_turns") >= min_messages)
        .withColumn("is_multi_turn", F.col("num_turns") >= MULTI_TURN)
    )


def length_describe(
    profile: DataFrame, metrics: Sequence[str] = METRICS, probs: Sequence[float] = PROBS
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quantiles, one row per metric.

    All metrics are reduced to (metric, value, frequency) in one scan; everything else works on
    that much smaller table.
    """
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("value")) for m in metrics]
    )
    counts = (
        profile.select(F.explode(pairs).alias("p"))
        .groupBy("p.metric", "p.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    value, n = F.col("value"), F.col("n")
    known = counts.filter(value.isNotNull())
    moments = known.groupBy("metric").agg(
        F.sum(n).alias("count"),
        (F.sum(value.cast("double") * n) / F.sum(n)).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # Around the mean, in a second pass over the counts: squares of large values lose the deviation.
    away = value.cast("double") - F.col("mean")
    around = (
        known.join(F.broadcast(moments.select("metric", "mean")), "metric")  # one row per metric
        .groupBy("metric")
        .agg(F.sum(away * away * n).alias("_squares"))
    )
    moments = moments.join(F.broadcast(around), "metric")  # one row per metric
    spread = F.col("_squares") / (F.col("count") - 1)
    quantiles = exact_quantiles(counts, "value", "n", probs, by=["metric"])
    wide = quantiles.groupBy("metric").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"p{round(p * 100)}")
            for p in probs
        ]
    )
    return moments.join(F.broadcast(wide), "metric").select(  # one row per metric
        "metric",
        "count",
        "mean",
        F.when(F.col("count") > 1, F.sqrt(spread)).alias("std"),
        "min",
        *[f"p{round(p * 100)}" for p in probs],
        "max",
    )


def avg_words_by_topic(docs: DataFrame, topic: str, text: str, limit: int = 10) -> DataFrame:
    """Topics with the longest texts, in words."""
    return (
        docs.select(F.col(topic).alias("topic_name"), F.size(words(F.col(text))).alias("n"))
        .groupBy("topic_name")
        .agg(F.avg("n").alias("avg_words"))
        .orderBy(F.desc("avg_words"), "topic_name")
        .limit(limit)
    )
