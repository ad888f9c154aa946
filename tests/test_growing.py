"""Batches with a merged summary, and totals of streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_clean import raw

from parley.operators.clean import clean_records
from parley.operators.summary import dataset_summary
from parley.plans import incremental
from parley.schemas import FACT, RAW, conform
from parley.streaming import ingest, watch


def fact(spark, low, high, shift=0):
    rows = spark.range(low, high).select(
        F.col("id").cast("string"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("m"), (F.col("id") % 4).cast("string"))).alias("model_family"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("t"), (F.col("id") % 13 + shift).cast("string"))).alias("topic"),
        F.lit("FR").alias("country"),
        F.when(F.col("id") % 7 != 0, F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.col("id").cast("int"))).alias("timestamp"),
    )
    return conform(rows, FACT)


def test_merged_equals_recount(spark, tmp_path):
    path = str(tmp_path)
    batches = {0: fact(spark, 0, 50), 1: fact(spark, 50, 51), 2: fact(spark, 300, 300), 3: fact(spark, 60, 200, 2)}
    for number, rows in batches.items():
        incremental.append_batch(rows, path, number)
        got = incremental.merged_summary(spark, path).collect()
        assert got == dataset_summary(incremental.read_batches(spark, path)).collect()
    assert got[0].total_count == 191 == incremental.read_batches(spark, path).count()


def test_a_batch_run_again_counts_once(spark, tmp_path):
    path = str(tmp_path)
    incremental.append_batch(fact(spark, 0, 90), path, 0)
    incremental.append_batch(fact(spark, 90, 95), path, 1)
    incremental.append_batch(fact(spark, 90, 120), path, 1)
    assert incremental.merged_summary(spark, path).first().total_count == 120


def test_folds(spark, tmp_path):
    path = str(tmp_path)
    for number in range(4):
        incremental.append_batch(fact(spark, 30 * number, 30 * number + 30), path, number)
        if number in (1, 2):
            incremental.fold(spark, path, number)
            incremental.fold(spark, path, number)
    assert incremental._folded(spark, path) == 2
    assert incremental.merged_summary(spark, path).collect() == dataset_summary(fact(spark, 0, 120)).collect()
    incremental.fold(spark, path, 0)  # an earlier one changes nothing
    assert incremental.merged_summary(spark, path).first().total_count == 120


def many_files(spark, folder, n):
    spark.range(n * 3).repartitionByRange(n, "id").select(F.col("id").cast("string").alias("text")).write.parquet(folder)
    return spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).parquet(folder)


def test_watch_sees_more_batches_than_the_query_keeps(spark, tmp_path):
    stream = watch.observed(many_files(spark, f"{tmp_path}/in", 12), "read")
    kept = watch.observed(stream.filter("cast(text as int) % 2 = 0"), "kept")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    try:
        with watch.Watch(spark) as seen:
            query = ingest.finish(ingest.stream_batches(kept, f"{tmp_path}/out", f"{tmp_path}/mark"))
            totals = seen.totals(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (totals.batches, totals.rows, totals.error) == (12, 36, None)
    assert totals.observed == {"read.rows": 36, "kept.rows": 18}
    assert ingest.progress(query)["batches"] <= 4


def test_watch_tells_of_failures_and_keeps_runs_apart(spark, tmp_path):
    stream = many_files(spark, f"{tmp_path}/in", 2)
    with watch.Watch(spark) as seen:
        good = ingest.finish(ingest.stream_batches(stream, f"{tmp_path}/a", f"{tmp_path}/m1"))
        bad = ingest.stream_batches(stream.select(F.raise_error(F.col("text")).cast("string").alias("x")), f"{tmp_path}/b", f"{tmp_path}/m2")
        with pytest.raises(Exception, match="USER_RAISED|exception"):
            bad.awaitTermination()
        assert seen.totals(good).rows == 6 and seen.totals(good).error is None
        assert seen.totals(bad).error


def test_stream_appends(spark, tmp_path):
    path = str(tmp_path / "corpus")
    raw(spark).repartition(3).write.parquet(f"{tmp_path}/raw")
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/raw")
    ingest.finish(incremental.stream_appends(clean_records(stream), path, f"{tmp_path}/mark"))
    wanted = dataset_summary(clean_records(raw(spark))).collect()
    assert incremental.merged_summary(spark, path).collect() == wanted
