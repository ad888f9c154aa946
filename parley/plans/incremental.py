"""A corpus that grows by batches, with a summary that is merged instead of counted anew.

Every batch has a number. Its rows and their partial summary are written to folders of that number,
so a batch that is run twice replaces itself and counts once. Now and then the partial summaries are
folded into one; those of later batches are read beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley.operators.summary import merge_summaries, partial_summary, summary_of
from parley.schemas import FACT, conform

PARTS = "kind string, name string, count bigint, first timestamp_ntz, last timestamp_ntz"


def append_batch(fact: DataFrame, path: str, number: int) -> None:
    """Write a batch of fact rows and its partial summary. The summary comes second and is computed
    from the written rows, so what it counts is what is there."""
    rows = f"{path}/batches/batch={number}"
    conform(fact, FACT).write.mode("overwrite").parquet(rows)
    written = fact.sparkSession.read.schema(FACT).parquet(rows)
    partial_summary(written).write.mode("overwrite").parquet(f"{path}/summaries/batch={number}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches."""
    return spark.read.schema(FACT).parquet(f"{path}/batches").select(*FACT.fieldNames())


def merged_parts(spark: SparkSession, path: str) -> DataFrame:
    """The partial summary of all batches: the last fold, and the batches after it."""
    parts = spark.read.schema(f"{PARTS}, batch long").parquet(f"{path}/summaries").select(
        "kind", "name", "count", "first", "last", "batch"
    )
    upto = _folded(spark, path)
    if upto is None:
        return merge_summaries(parts)
    folded = spark.read.schema(PARTS).parquet(f"{path}/folded/upto={upto}")
    later = parts.filter(F.col("batch") > upto).drop("batch")
    return merge_summaries(folded.unionByName(later))


def fold(spark: SparkSession, path: str, upto: int) -> None:
    """Fold the partial summaries of the batches up to a number, none of which will change any more.
    Earlier folds stay until they are deleted, so readers are not disturbed."""
    earlier = _folded(spark, path)
    parts = spark.read.schema(f"{PARTS}, batch long").parquet(f"{path}/summaries").filter(F.col("batch") <= upto)
    if earlier is not None and earlier <= upto:
        before = spark.read.schema(PARTS).parquet(f"{path}/folded/upto={earlier}")
        parts = parts.filter(F.col("batch") > earlier).drop("batch").unionByName(before)
    else:
        parts = parts.drop("batch")
    merge_summaries(parts).write.mode("overwrite").parquet(f"{path}/folded/upto={upto}")


def merged_summary(spark: SparkSession, path: str, top: int = 10) -> DataFrame:
    """The summary row of all batches. What it reads grows with the names, not with the rows."""
    return summary_of(merged_parts(spark, path), top)


def stream_appends(
    fact: DataFrame, path: str, checkpoint: str, continuous: str | None = None
) -> StreamingQuery:
    """Append every micro-batch of a stream of fact rows under its number."""
    writer = fact.writeStream.foreachBatch(lambda batch, number: append_batch(batch, path, number))
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def _folded(spark: SparkSession, path: str) -> int | None:
    """The greatest number that a complete fold covers."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/folded")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    done = [
        int(s.getPath().getName().removeprefix("upto="))
        for s in files.listStatus(folder)
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    ]
    return max(done, default=None)
