"""Fact tables bucketed by conversation, so that rewriting a column moves no conversation.

A row's bucket follows from its id, and the files of a bucket are read by one task. Updates are
dealt to the same buckets, meet the rows where these lie, and the result is written bucket by
bucket: only the updates, two short columns, are ever shuffled. Within a bucket rows are sorted by
the columns people filter on, so readers still skip row groups.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.schemas import FACT, conform
from parley.sources.tables import FILTER_COLUMNS

BUCKETS = 200
KEY = "bucket_key"


def _key(columns: list[str]) -> Column:
    """The id; rows without one are spread by their contents and match no update."""
    return F.coalesce(F.concat(F.lit("="), F.col("id")), F.concat(F.lit("-"), F.xxhash64(*columns).cast("string")))


def _save(rows: DataFrame, path: str, buckets: int) -> DataFrame:
    """Spark records buckets in its catalog, under a name of this session's own."""
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = rows.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, KEY).sortBy(*FILTER_COLUMNS).saveAsTable(name)
    return rows.sparkSession.table(name)


def write_bucketed(fact: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Create or replace a bucketed fact table; one shuffle of the rows, the last they need.

    A bucket is about the table's size by ``buckets`` and one task's work, whatever the topics'
    shares are."""
    rows = conform(fact, FACT)
    keyed = rows.withColumn(KEY, _key(rows.columns))
    return _save(keyed.repartition(buckets, KEY), path, buckets)


def open_bucketed(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """A bucketed fact table that some session has written with the same number of buckets."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FACT.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {KEY} string) USING parquet "
        f"CLUSTERED BY ({KEY}) SORTED BY ({', '.join(FILTER_COLUMNS)}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def with_topics(bucketed: DataFrame, updates: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows with the topics of ``updates`` (``id``, ``new_topic``, one row per id); rows without
    an update keep theirs. The updates are shuffled to the rows' buckets and hashed there, so the
    rows are neither shuffled nor sorted. An update to NULL clears the topic; updates of a NULL id
    match nothing."""
    known = updates.filter(F.col("id").isNotNull()).select(
        F.concat(F.lit("="), "id").alias(KEY), F.struct("new_topic").alias("_new")
    )
    joined = bucketed.join(known.repartition(buckets, KEY).hint("shuffle_hash"), KEY, "left")
    topic = F.when(F.col("_new").isNotNull(), F.col("_new.new_topic")).otherwise(F.col("topic"))
    return joined.withColumn("topic", topic).select(*bucketed.columns)


def rewrite_topics(
    spark: SparkSession, source: str, target: str, updates: DataFrame, buckets: int = BUCKETS
) -> DataFrame:
    """Write the bucketed table at ``source`` with new topics to ``target``, bucketed alike. The
    source stays as it is, so a job that is lost is run again."""
    return _save(with_topics(open_bucketed(spark, source, buckets), updates, buckets), target, buckets)


def fact_of(bucketed: DataFrame) -> DataFrame:
    return bucketed.select(*FACT.fieldNames())
