"""Frequency reports over annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.text import strip_space, title_case

# Annotations that carry no information.
NO_LANGUAGE = ("None", "Other", "Unknown", "Null", "Nan")
NO_ERROR = ("None", "Other", "Unknown")

SECTIONS = {"category": "Top Categories", "language": "Top Languages", "error": "Top Errors"}


def _normalized(column: str, value: Column) -> Column:
    """Gaps filled, spaces stripped; categories and languages in title case."""
    filled = F.coalesce(value, F.lit("Other" if column == "category" else "None"))
    return strip_space(filled if column == "error" else title_case(filled))


def _listed(column: str, value: Column) -> Column:
    """Whether a normalized value belongs in the report."""
    if column == "language":
        return ~value.isin(*NO_LANGUAGE)
    if column == "error":
        return ~value.isin(*NO_ERROR) & (F.length(value) > 3)
    return F.lit(True)


def normalize_annotations(annotations: DataFrame) -> DataFrame:
    return annotations.select(*[_normalized(c, F.col(c)).alias(c) for c in SECTIONS])


def _top(annotations: DataFrame, column: str, limit: int) -> DataFrame:
    """Most frequent normalized values. Values are counted as written first, so the text work is
    done once per distinct value and not once per row."""
    written = annotations.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return (
        written.select(_normalized(column, F.col(column)).alias("value"), "n")
        .filter(_listed(column, F.col("value")))
        .groupBy("value")
        .agg(F.sum("n").alias("count"))
        .orderBy(F.desc("count"), "value")
        .limit(limit)
    )


def top_categories(annotations: DataFrame, limit: int = 15) -> DataFrame:
    return _top(annotations, "category", limit)


def top_languages(annotations: DataFrame, limit: int = 15) -> DataFrame:
    return _top(annotations, "language", limit)


def top_errors(annotations: DataFrame, limit: int = 15) -> DataFrame:
    return _top(annotations, "error", limit)


def freq_report(annotations: DataFrame, limit: int = 15) -> DataFrame:
    """The three lists as ``(section, position, value, count)``, from one scan."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in SECTIONS]
    )
    written = (
        annotations.select(F.explode(entries).alias("e"))
        .groupBy("e.kind", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    section = value = F.lit(None)
    listed = F.lit(False)
    for column, title in SECTIONS.items():
        this = F.col("kind") == column
        section = F.when(this, F.lit(title)).otherwise(section)
        value = F.when(this, _normalized(column, F.col("value"))).otherwise(value)
        listed = F.when(this, _listed(column, F.col("value"))).otherwise(listed)
    order = Window.partitionBy("section").orderBy(F.desc("count"), "value")
    return (
        written.withColumns({"section": section, "value": value})
        .filter(listed)
        .groupBy("section", "value")
        .agg(F.sum("n").alias("count"))
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= limit)
        .select("section", "position", "value", "count")
    )
