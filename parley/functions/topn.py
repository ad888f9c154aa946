"""First rows per group that hold when one group has a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def first_n(df: DataFrame, by: Sequence[str], order: str, n: int, salts: int = SALTS) -> DataFrame:
    """The first ``n`` rows of each group by a column that is unique and never NULL.

    Only keys are ranked and moved: each group is cut in ``salts`` slices, as a row among the
    first n of its group is among the first n of any slice of it, and the second ranking sees at
    most ``n * salts`` keys of a group. The rows are then found by their unique keys, which no
    group holds more of than any other.
    """
    by = list(by)
    sliced = Window.partitionBy(*by, "_salt").orderBy(order)
    whole = Window.partitionBy(*by).orderBy(order)
    chosen = (
        df.select(*by, order)
        .withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)))
        .withColumn("_rank", F.row_number().over(sliced))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= n)
    )
    return df.join(chosen.select(order), order, "left_semi")
