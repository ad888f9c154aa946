"""What is in the table: one summary row, top values, schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.topics import NOISE_TOPIC


KINDS = (("model", "model_family"), ("topic", "topic"), ("country", "country"))


def partial_summary(fact: DataFrame) -> DataFrame:
    """``(kind, name, count, first, last)``: rows and time bounds of every model, topic and country.

    One scan and one shuffle: each row contributes its three values, which are combined per value
    before the shuffle; every row has exactly one 'model' entry, so those carry the totals.
    """
    entries = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(column).alias("name")) for kind, column in KINDS])
    return (
        fact.select("timestamp", F.explode(entries).alias("e"))
        .groupBy("e.kind", "e.name")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("timestamp").alias("first"),
            F.max("timestamp").alias("last"),
        )
    )


def merge_summaries(parts: DataFrame) -> DataFrame:
    """Partial summaries of disjoint sets of rows as that of all of them."""
    return parts.groupBy("kind", "name").agg(
        F.sum("count").alias("count"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def dataset_summary(fact: DataFrame, top: int = 10) -> DataFrame:
    """Row count, first and last timestamp, and top models, topics and countries as JSON lists."""
    return summary_of(partial_summary(fact), top)


def summary_of(values: DataFrame, top: int = 10) -> DataFrame:
    """The summary row of a (merged) partial summary."""
    listed = (F.col("kind") == "model") | (
        F.col("name").isNotNull() & ((F.col("kind") != "topic") | (F.col("name") != NOISE_TOPIC))
    )
    # Ranked by themselves, so that each task keeps its first few names of a kind only.
    order = Window.partitionBy("kind").orderBy(F.desc("count"), F.asc_nulls_last("name"))
    ranked = values.filter(listed).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    def top_list(kind: str) -> Column:
        keep = F.col("kind") == kind
        pairs = F.array_sort(F.collect_list(F.when(keep, F.struct("rank", "name", "count"))))
        shown = F.transform(pairs, lambda p: F.struct(p["name"].alias("name"), p["count"].alias("count")))
        return F.when(F.size(pairs) > 0, F.to_json(shown, {"ignoreNullFields": "false"}))

    in_total = F.col("kind") == "model"
    totals = values.agg(
        F.coalesce(F.sum(F.when(in_total, F.col("count"))), F.lit(0)).alias("total_count"),
        F.min(F.when(in_total, F.col("first"))).alias("start_date"),
        F.max(F.when(in_total, F.col("last"))).alias("end_date"),
    )
    lists = ranked.agg(
        top_list("model").alias("model_json"),
        top_list("topic").alias("topic_json"),
        top_list("country").alias("country_json"),
    )
    return totals.crossJoin(F.broadcast(lists))  # one row each


def top_values(
    df: DataFrame, column: str, keep: Column | None = None, limit: int = 10
) -> DataFrame:
    """Most frequent values of one column as ``(name, count)``."""
    rows = df if keep is None else df.filter(keep)
    return (
        rows.groupBy(F.col(column).alias("name"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last("name"))
        .limit(limit)
    )


def top_models(fact: DataFrame, limit: int = 10) -> DataFrame:
    return top_values(fact, "model_family", limit=limit)


def top_topics(fact: DataFrame, limit: int = 10) -> DataFrame:
    return top_values(fact, "topic", F.col("topic") != NOISE_TOPIC, limit)


def top_countries(fact: DataFrame, limit: int = 10) -> DataFrame:
    return top_values(fact, "country", F.col("country").isNotNull(), limit)


def table_schema(df: DataFrame) -> DataFrame:
    """Column names and types in order; touches no rows."""
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        fields, "position int, column_name string, column_type string"
    )
