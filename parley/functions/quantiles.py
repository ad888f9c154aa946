"""Exact quantiles of integer columns without gathering a group's values in one task.

``percentile`` keeps every distinct value of a group in one hash map. Here the values are first
counted (map-side combined), the counts are summed over at most a few hundred thousand value
buckets of bounded relative width, and only the buckets that hold a wanted rank are opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.small import null_safe

BUCKET_BITS = 12


def _bucket(value: Column) -> Column:
    """Monotone bucket number: power of two of the size, then the leading bits."""
    size = F.abs(value)
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - BUCKET_BITS)
    leading = F.call_function("shiftright", size, shift)
    number = shift.cast("long") * (1 << BUCKET_BITS) + leading
    return F.when(value < 0, -number - 1).otherwise(number)


def exact_quantiles(
    counts: DataFrame, value: str, weight: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles per group, as rows ``(*by, prob, quantile)``.

    ``counts`` holds one row per group and distinct value with its number of occurrences.
    """
    by = list(by)
    bucketed = counts.filter(F.col(value).isNotNull()).select(
        *by,
        F.col(value).cast("long").alias("_value"),
        F.col(weight).alias("_weight"),
    )
    bucketed = bucketed.withColumn("_bucket", _bucket(F.col("_value")))

    group = Window.partitionBy(*by)
    upto = group.orderBy("_bucket")
    coarse = (
        bucketed.groupBy(*by, "_bucket")
        .agg(F.sum("_weight").alias("_in"))
        .withColumn("_end", F.sum("_in").over(upto))
        .withColumn("_total", F.sum("_in").over(group))
    )
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    hits = (
        coarse.select("*", wanted.alias("prob"))
        .withColumn("_pos", F.col("prob") * (F.col("_total") - 1))
        .filter(
            (F.col("_end") > F.floor("_pos")) & (F.col("_end") - F.col("_in") <= F.ceil("_pos"))
        )
        .select(*by, "_bucket", "prob", "_pos", (F.col("_end") - F.col("_in")).alias("_before"))
    )
    opened = bucketed.alias("v").join(
        hits.alias("h"),
        null_safe("v", "h", by) & (F.col("v._bucket") == F.col("h._bucket")),
    ).select(*[f"h.{c}" for c in by], "h._bucket", "prob", "_pos", "_before", "_value", "_weight")
    inside = Window.partitionBy(*by, "prob", "_bucket").orderBy("_value")
    ranked = opened.withColumn("_rank", F.col("_before") + F.sum("_weight").over(inside))
    low = F.min(F.when(F.col("_rank") > F.floor("_pos"), F.col("_value")))
    high = F.min(F.when(F.col("_rank") > F.ceil("_pos"), F.col("_value")))
    return (
        ranked.groupBy(*by, "prob", "_pos")
        .agg(low.alias("_low"), high.alias("_high"))
        .select(
            *by,
            "prob",
            (
                F.col("_low") + (F.col("_pos") - F.floor("_pos")) * (F.col("_high") - F.col("_low"))
            ).alias("quantile"),
        )
    )
