"""A layout for filters on any of several columns: rows sorted by interleaved bits.

Sorted by topic, then family, then time, a table can skip files for a topic but not for a time.
Here the rank bits of all columns are interleaved (a Z-order curve), so each file and row group
holds a narrow range of every column, and a filter on one of them alone skips most of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.schemas import FACT, conform
from parley.sources.tables import FILTER_COLUMNS, ROWS_PER_GROUP

BITS = 5  # of each column's rank: 32 ranges
PREFIX = 7  # bytes of a text that decide its rank


def _number(name: str, kind: T.DataType) -> Column:
    """A number in the order of the column; texts by their first bytes."""
    c = F.col(name)
    if isinstance(kind, T.StringType):
        front = F.hex(F.substring(F.encode(c, "utf-8"), 1, PREFIX))
        return F.conv(F.rpad(front, 2 * PREFIX, "0"), 16, 10).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def _rank(number: Column, bounds: Sequence[float]) -> Column:
    """How many of the bounds are not above; 0 for NULL."""
    steps = F.array(*[F.lit(float(b)) for b in bounds])
    return F.coalesce(F.size(F.filter(steps, lambda b: b <= number)), F.lit(0)).cast("long")


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of all ranks in turn, highest first."""
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(reversed(ranks)):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + place))
    return key


def interleave_key(df: DataFrame, columns: Sequence[str] = FILTER_COLUMNS, bits: int = BITS) -> Column:
    """The sort key of the columns. Runs one aggregate over ``df``: the quantiles that bound the ranks,
    ``2 ** bits - 1`` numbers per column, are all that reaches the driver."""
    numbers = [_number(c, df.schema[c].dataType) for c in columns]
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(n, shares).alias(f"b{i}") for i, n in enumerate(numbers)]).first()
    ranks = [F.when(n.isNull(), 0).otherwise(_rank(n, b or ())) for n, b in zip(numbers, found, strict=True)]
    return interleaved([r.cast("long") for r in ranks], bits)


def write_interleaved(fact: DataFrame, path: str, columns: Sequence[str] = FILTER_COLUMNS, files: int | None = None) -> None:
    """Create or replace the fact table in interleaved order. The range shuffle goes by the key and
    then by the id, so that rows with equal keys (one topic, one day) are cut into many files too."""
    rows = conform(fact, FACT)
    rows = rows.withColumn("__key", interleave_key(rows, columns))
    rows = rows.repartitionByRange(files, "__key", "id") if files else rows.repartitionByRange("__key", "id")
    (
        rows.sortWithinPartitions("__key", *columns)
        .drop("__key")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#id", "true")
        .option("parquet.bloom.filter.expected.ndv#id", str(ROWS_PER_GROUP))
        .parquet(path)
    )
