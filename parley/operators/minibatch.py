"""Mini-batch k-means: centres that follow small batches, at falling rates.

A step is one aggregate over one batch: the rows nearest to each centre, their number and their sum.
The centre moves towards their mean by their share of all rows it has ever seen, so early batches
move it far and late ones little. Only the batches that are stepped through are written, so fitting
costs the same on any number of rows; assigning is one projection over all of them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import md5
from math import ceil, log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.session import shared_path

BATCH_ROWS = 4096
STEPS = 100
PATIENCE = 10
LESS = 1e-9  # what counts as a lower cost, by the cost before
SHARE = 2.0  # of the newest batch in the smoothed cost, times rows per batch by rows in all


@dataclass
class Fit:
    """Centres by cluster id, rows each has seen, steps made, and the mean cost of each step."""

    centres: list[list[float]]
    seen: list[int]
    steps: int
    costs: list[float]


def lot(seed: int, key: Column, *more: Column) -> Column:
    """A number of 32 bits that depends on the seed and the key alone."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")), *more)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(seed: int, key: object, step: int) -> float:
    """The same kind of number between 0 and 1, for a key and a step of the seeding."""
    text = f"{seed}:{'' if key is None else key}:{step}"
    return (int(md5(text.encode()).hexdigest()[:8], 16) + 0.5) / 4294967296


def distances(vector: Column, centres: Column) -> Column:
    """Squared distances to each of the centres."""

    def one(centre: Column) -> Column:
        return F.aggregate(F.zip_with(vector, centre, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)

    return F.transform(centres, one)


def _constant(centres: Sequence[Sequence[float]]) -> Column:
    """One constant of the plan, not an expression for every number."""
    return F.from_json(F.lit(json.dumps([list(c) for c in centres])), "array<array<double>>")


def _nearest(found: Column) -> Column:
    return (F.array_position(found, F.array_min(found)) - 1).cast("int")


def usable(column: str) -> Column:
    """Whether a vector is there and all its components are numbers."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def spread_starts(rows: Sequence[tuple[object, np.ndarray]], k: int, seed: int) -> list[np.ndarray]:
    """``k`` of the rows, each drawn with odds in proportion to the squared distance from those
    before: the greatest ``ln(u) / distance`` wins, for a hashed ``u``; ties go to the smaller key.
    Fewer if there are fewer different rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    keys, x = [r[0] for r in rows], np.array([r[1] for r in rows])
    chosen: list[np.ndarray] = []
    apart = np.ones(len(rows))
    for step in range(min(k, len(rows))):
        weight = np.array([log(uniform(seed, key, step)) for key in keys])
        able = apart > 0
        if not able.any():
            break
        lots = np.where(able, weight / np.where(able, apart, 1), -np.inf)
        chosen.append(x[int(np.argmax(lots))])
        own = ((x - chosen[-1]) ** 2).sum(axis=1)
        apart = own if step == 0 else np.minimum(apart, own)
    return chosen


def fit(
    df: DataFrame,
    k: int,
    seed: int,
    column: str,
    id: str,
    batch_rows: int = BATCH_ROWS,
    steps: int = STEPS,
    patience: int | None = PATIENCE,
) -> Fit:
    """Rows are dealt to batches of about ``batch_rows`` by a hash of seed and id, whatever their
    order; a step takes the next batch, and the first follows the last. Starts are drawn from the
    first batch, which is the only data that the driver holds. With ``patience``, fitting ends when
    the smoothed cost has not fallen for so many steps."""
    spark = df.sparkSession
    rows = df.filter(usable(column)).select(
        F.col(id).alias("id"), F.transform(column, lambda x: x.cast("double")).alias("v"), lot(seed, F.col(id)).alias("lot")
    )
    total = rows.count()
    if not total:
        return Fit([], [], 0, [])
    batches = max(1, ceil(total / batch_rows))
    used = rows.withColumn("batch", F.col("lot") % batches).filter(F.col("batch") < steps)
    path = shared_path(spark, "batches")
    used.select("id", "v", "batch").repartition("batch").write.partitionBy("batch").parquet(path)
    dealt = spark.read.schema(T.StructType([*used.schema.fields[:2], T.StructField("batch", T.LongType())])).parquet(path)
    first = dealt.filter("batch = 0").select("id", "v").collect()
    starts = spread_starts([(r[0], np.array(r[1])) for r in first], k, seed)
    dims = len(starts[0]) if starts else 0
    found = Fit([list(map(float, s)) for s in starts], [0] * len(starts), 0, [])
    share = min(1.0, SHARE * batch_rows / (total + 1))
    smoothed = best = None
    since = 0
    while found.steps < steps and starts:
        near = dealt.filter(F.col("batch") == found.steps % batches)
        near = near.select("v", distances(F.col("v"), _constant(found.centres)).alias("d"))
        near = near.select("v", F.array_min("d").alias("cost"), _nearest(F.col("d")).alias("c"))
        sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dims)]
        moved = near.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("cost"), *sums).collect()
        for row in moved:
            seen = found.seen[row.c] + row.n
            found.centres[row.c] = [
                x + (row[f"s{i}"] - x * row.n) / seen for i, x in enumerate(found.centres[row.c])
            ]
            found.seen[row.c] = seen
        found.steps += 1
        if not moved:
            continue
        cost = sum(r.cost for r in moved) / sum(r.n for r in moved)
        found.costs.append(cost)
        smoothed = cost if smoothed is None else smoothed * (1 - share) + cost * share
        best, since = (smoothed, 0) if best is None or smoothed < best * (1 - LESS) else (best, since + 1)
        if patience is not None and since >= patience:
            break
    return found


def assign(df: DataFrame, centres: Sequence[Sequence[float]], column: str) -> DataFrame:
    """Adds ``cluster_id``, that of the nearest centre, ties to the smaller; NULL without a vector."""
    if not centres:
        return df.withColumn("cluster_id", F.lit(None).cast("int"))
    vector = F.transform(column, lambda x: x.cast("double"))
    return df.withColumn("cluster_id", F.when(usable(column), _nearest(distances(vector, _constant(centres)))))


def minibatch_kmeans(
    df: DataFrame,
    k: int = 50,
    seed: int = 42,
    column: str = "reduced",
    id: str = "id",
    batch_rows: int = BATCH_ROWS,
    steps: int = STEPS,
    patience: int | None = PATIENCE,
) -> DataFrame:
    """Adds ``cluster_id``; see :func:`fit` and :func:`assign`. Ids should be distinct: rows that
    share one share a batch. Vectors have equal lengths."""
    return assign(df, fit(df, k, seed, column, id, batch_rows, steps, patience).centres, column)
