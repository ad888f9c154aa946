"""Unusual conversations: much longer than average, or in rare topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.filters import build_filters
from parley.functions.text import snippet

KINDS = ("length_outlier", "rare_topic")


def length_outliers(
    fact: DataFrame, model: str | None = None, threshold: float = 10.0, limit: int = 10
) -> DataFrame:
    """Conversations with more turns than ``threshold`` times the filtered average."""
    rows = fact.filter(build_filters(models=[model] if model else None))
    average = rows.agg(F.coalesce(F.avg("turn_count"), F.lit(0.0)).alias("_average"))
    return (
        rows.crossJoin(F.broadcast(average))  # one row
        .filter(F.col("turn_count") > F.col("_average") * threshold)
        .select(
            "id",
            "model_family",
            F.col("turn_count").alias("metric_value"),
            F.col("_average").cast("int").alias("avg_benchmark"),
            snippet(F.col("search_text"), 100).alias("snippet"),
        )
        .orderBy(F.desc("metric_value"), "id")
        .limit(limit)
    )


def rare_topics(
    fact: DataFrame, model: str | None = None, below: int = 50, limit: int = 10
) -> DataFrame:
    """Conversations of topics with fewer than ``below`` rows in the whole table."""
    counts = fact.groupBy("topic").agg(F.count(F.lit(1)).alias("_n"))
    rare = counts.filter(F.col("_n") < below).select("topic")
    rows = fact.filter(build_filters(models=[model] if model else None, exclude_noise=False))
    return (
        rows.join(rare, "topic", "left_semi")
        .select("id", "model_family", "topic", snippet(F.col("search_text"), 100).alias("snippet"))
        .orderBy("id")
        .limit(limit)
    )


def anomalies(
    fact: DataFrame, kind: str = "length_outlier", model: str | None = None, threshold: float = 10.0
) -> DataFrame:
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")
    if kind == "length_outlier":
        return length_outliers(fact, model, threshold)
    return rare_topics(fact, model)
