"""Writing and reading the tables of a built corpus.

Layout of a corpus folder: ``fact``, ``summary``, ``index/…``, ``embeddings``. Every write goes
to its own folder, so a lost job is simply run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.schemas import FACT, conform
from parley.session import shared_path

# Distinct ids a Bloom filter is sized for; row groups of long texts hold far fewer rows.
ROWS_PER_GROUP = 200_000

FILTER_COLUMNS = ("topic", "model_family", "timestamp")


def write_fact(fact: DataFrame, path: str) -> None:
    """Create or replace the fact table, grouped and sorted by the columns people filter on.

    Readers then skip row groups by their minima and maxima, and by a Bloom filter when they look
    for one id. Rebalancing needs no sampling pass over the input, and adaptive execution cuts
    the partition of a topic with a large share of the rows into many files.
    """
    grouped = conform(fact, FACT).hint("rebalance", *[F.col(c) for c in FILTER_COLUMNS[:2]])
    (
        grouped.sortWithinPartitions(*FILTER_COLUMNS)
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#id", "true")
        .option("parquet.bloom.filter.expected.ndv#id", str(ROWS_PER_GROUP))
        .parquet(path)
    )


def append_fact(fact: DataFrame, path: str) -> None:
    conform(fact, FACT).write.mode("append").parquet(path)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# A header, doubled quotes, and texts with the white space they have.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """A folder of CSV files, each with a header."""
    df.write.mode("append" if append else "overwrite").options(**CSV).csv(path)


def add_embeddings(embeddings: DataFrame, path: str) -> None:
    """Grow the embedding cache, keyed by id; ``written`` tells later vectors from earlier ones."""
    stamped = embeddings.withColumn("written", F.current_timestamp())
    stamped.write.mode("append").parquet(path)


def json_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON text with ISO timestamps."""
    options = {
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS",
        "ignoreNullFields": "false",
    }
    return df.select(F.to_json(F.struct("*"), options).alias("record"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once below the shared folder and read from there: an intermediate
    that outlives lost executors and cuts the lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
