"""Written intermediate tables: they cut the lineage and survive the loss of executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parley.session import shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once as Parquet into the shared folder and read from there."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
