"""Bucketed fact tables: same rows as the plain rewrite, without moving them."""

import re

import pytest
from pyspark.sql import functions as F
from test_clean import RECORDS, record

from parley.operators.clean import clean_records
from parley.operators.topics import apply_topics
from parley.plans import build
from parley.schemas import FACT, RAW, conform
from parley.sources import buckets


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture
def fact(spark):
    rows = spark.range(300).select(
        F.when(F.col("id") % 11 != 0, F.md5((F.col("id") % 250).cast("string"))).alias("id"),
        F.concat(F.lit("topic "), (F.col("id") % 3).cast("string")).alias("topic"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("search_text"),
        (F.col("id") % 7).cast("int").alias("turn_count"),
    )
    return conform(rows, FACT)


@pytest.fixture
def updates(spark):
    rows = [(None, "never")] + [(i, f"new {i % 4}" if i % 5 else None) for i in range(0, 400, 3)]
    known = spark.createDataFrame([(None if i is None else str(i), t) for i, t in rows], "n string, new_topic string")
    return known.select(F.md5("n").alias("id"), "new_topic")


def exchanges(df):
    """Exchanges by the tables below them: text columns moved, and key columns."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    return [line for line in lines if "Exchange" in line], plan


def test_same_rows_as_the_plain_rewrite(spark, fact, updates, tmp_path):
    buckets.write_bucketed(fact, f"{tmp_path}/a", 4)
    out = buckets.rewrite_topics(spark, f"{tmp_path}/a", f"{tmp_path}/b", updates, 4)
    wanted = rows_of(apply_topics(fact, updates))
    assert rows_of(buckets.fact_of(out)) == wanted
    assert rows_of(buckets.fact_of(buckets.open_bucketed(spark, f"{tmp_path}/b", 4))) == wanted
    assert rows_of(buckets.fact_of(buckets.open_bucketed(spark, f"{tmp_path}/a", 4))) == rows_of(fact)


def test_only_updates_are_shuffled(spark, fact, updates, tmp_path):
    buckets.write_bucketed(fact, f"{tmp_path}/a", 4)
    table = buckets.open_bucketed(spark, f"{tmp_path}/a", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved, plan = exchanges(buckets.with_topics(table, updates, 4))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(moved) == 1 and "ShuffledHashJoin" in plan
    # The fact's side has no exchange: the scan is the join's child, but for projections.
    side = re.search(r"ShuffledHashJoin.*\n((?:[ :+\-]*(?:Project|Filter|ColumnarToRow|FileScan|\*).*\n)+)", plan)
    assert side and "Bucketed: true" in side.group(1) and "Exchange" not in side.group(1)


def test_files_are_one_bucket_each_and_sorted(spark, fact, updates, tmp_path):
    import pyarrow.parquet as pq

    buckets.write_bucketed(fact, f"{tmp_path}/a", 4)
    buckets.rewrite_topics(spark, f"{tmp_path}/a", f"{tmp_path}/b", updates, 4)
    files = sorted((tmp_path / "b").glob("*.parquet"))
    assert len(files) == 4
    for f in files:
        topics = pq.read_table(f).column("topic").to_pylist()
        assert topics == sorted(topics, key=lambda t: (t is not None, t))


def test_build_with_buckets(spark, tmp_path):
    words = ["python code error", "sql select table", "poem story rhyme"]
    records = [record(f"{i:03d}", [("user", f"{words[i % 3]} {words[i % 3]} question {i}")]) for i in range(60)]
    fact = clean_records(spark.createDataFrame(records + RECORDS, RAW))
    plain, path = f"{tmp_path}/plain", f"{tmp_path}/buckets"
    build.build_corpus(spark.createDataFrame(records + RECORDS, RAW), plain)
    buckets.write_bucketed(fact, f"{path}/fact", 4)
    wanted = build.build_topics(spark, plain, ["question"], clusters=3, dimensions=2)
    got = build.build_topics(spark, path, ["question"], clusters=3, dimensions=2, buckets=4)
    assert got.columns == wanted.columns and got.count() == wanted.count() == 64
    assert got.filter("topic = 'SQL Database'").count() == wanted.filter("topic = 'SQL Database'").count() >= 20
