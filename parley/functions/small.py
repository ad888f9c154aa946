"""Membership and null-safe conditions for joins. Nothing here runs a job: adaptive execution
broadcasts a side that turns out to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def member_of(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """Adds the flag ``_member``: whether the row's value is among ``members`` (one column,
    distinct). NULL is no member."""
    name = members.columns[0]
    flags = members.filter(F.col(name).isNotNull())
    flags = flags.select(F.col(name).alias("_value"), F.lit(True).alias("_found"))
    joined = df.join(flags, df[column] == F.col("_value"), "left")
    return joined.withColumn("_member", F.coalesce("_found", F.lit(False))).drop("_value", "_found")


def null_safe(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality of the columns of two aliased tables, NULL equal to NULL."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition
