"""Aggregate views: topic shares, engagement, volume over time, match counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.filters import build_filters

INTERVALS = ("month", "week")


def _share(count: str, total: str):
    return (F.col(count).cast("double") * 100 / F.col(total)).cast("decimal(5,2)")


def topic_stats(
    fact: DataFrame,
    models: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    limit: int = 10,
) -> DataFrame:
    """Largest topics with count and share of all rows that pass the filter.

    One scan: the total is the sum of the topic counts, so both sides read the same shuffle.
    """
    counts = (
        fact.filter(build_filters(models=models, start=start, end=end))
        .groupBy("topic")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    total = counts.agg(F.sum("count").alias("total_conversations"))
    return (
        counts.crossJoin(F.broadcast(total))  # one row
        .select(
            "topic", "count", _share("count", "total_conversations").alias("percentage"),
            "total_conversations",
        )
        .orderBy(F.desc("count"), "topic")
        .limit(limit)
    )


def topic_stats_by_model(
    fact: DataFrame,
    models: Sequence[str],
    start: str | None = None,
    end: str | None = None,
    limit: int = 10,
) -> DataFrame:
    """Side-by-side topic shares of several model families from one grouped pass.

    A requested family without rows appears once with total 0 and no topic.
    """
    names = ", ".join("('" + m.replace("\\", "\\\\").replace("'", "\\'") + "')" for m in dict.fromkeys(models))
    asked = fact.sparkSession.sql(f"SELECT * FROM VALUES {names} AS m(model_family)")
    counts = (
        fact.filter(build_filters(models=models, start=start, end=end))
        .groupBy("model_family", "topic")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # From here on the rows are one per family and topic.
    family = Window.partitionBy("model_family")
    ranked = (
        counts.withColumn("total_conversations", F.sum("count").over(family))
        .withColumn("_rank", F.row_number().over(family.orderBy(F.desc("count"), "topic")))
        .filter(F.col("_rank") <= limit)
    )
    return asked.join(ranked, "model_family", "left").select(
        "model_family",
        F.coalesce("total_conversations", F.lit(0)).alias("total_conversations"),
        "topic",
        "count",
        _share("count", "total_conversations").alias("percentage"),
    )


def engagement(
    fact: DataFrame,
    group_by: str = "model",
    models: Sequence[str] | None = None,
    topic: str | None = None,
    min_count: int = 50,
    limit: int = 10,
) -> DataFrame:
    """Turns and tokens per model family or topic, for groups with more than ``min_count`` rows.

    Rows are first combined per group and turn count, so a group with a large share of the corpus
    is spread over many keys and the median only sees (turn count, frequency) pairs.
    """
    if group_by not in ("model", "topic"):
        raise ValueError(f"group_by must be 'model' or 'topic', not {group_by!r}")
    group = "model_family" if group_by == "model" else "topic"
    per_turns = (
        fact.filter(build_filters(models=models, topic=topic))
        .groupBy(F.col(group).alias("group_name"), "turn_count")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("token_count").alias("tokens"),
            F.count("token_count").alias("n_tokens"),
        )
    )
    turns = F.sum(F.col("turn_count") * F.col("n"))
    with_turns = F.sum(F.when(F.col("turn_count").isNotNull(), F.col("n")))
    return (
        per_turns.groupBy("group_name")
        .agg(
            F.sum("n").alias("total_convos"),
            _rounded(F.try_divide(turns, with_turns)).alias("avg_turns"),
            _rounded(F.percentile("turn_count", F.lit(0.5), F.col("n"))).alias("median_turns"),
            _rounded(F.try_divide(F.sum("tokens"), F.sum("n_tokens"))).alias("avg_total_tokens"),
            _rounded(F.try_divide(F.sum("tokens"), turns)).alias("avg_tokens_per_turn"),
        )
        .filter(F.col("total_convos") > min_count)
        .orderBy(F.desc("avg_total_tokens"), "group_name")
        .limit(limit)
    )


def _rounded(c):
    """Nearest integer, halves to even."""
    return F.rint(c).cast("int")


def temporal_trends(
    fact: DataFrame, interval: str = "month", topic: str | None = None, model: str | None = None
) -> DataFrame:
    """Conversations per month or week; rows without a timestamp form the last group."""
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {INTERVALS}, not {interval!r}")
    period = F.date_trunc(interval, "timestamp").cast("timestamp_ntz")
    return (
        fact.filter(build_filters(models=[model] if model else None, topic=topic))
        .groupBy(period.alias("period"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.asc_nulls_last("period"))
    )


def trend_peak(trend: DataFrame) -> DataFrame:
    """The busiest period, the earliest of equals."""
    return trend.filter(F.col("period").isNotNull()).orderBy(F.desc("count"), "period").limit(1)


def count_rows(fact: DataFrame, topic: str | None = None, model: str | None = None) -> DataFrame:
    """Number of rows that pass the filter, as one row."""
    keep = build_filters(models=[model] if model else None, topic=topic)
    return fact.filter(keep).agg(F.count(F.lit(1)).alias("matches"))
