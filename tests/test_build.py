from types import SimpleNamespace

import pytest
from test_clean import RECORDS, raw, record

from parley.operators.clean import clean_records
from parley.plans import build
from parley.schemas import RAW
from parley.session import shared_path
from parley.sources import readers, tables
from parley.streaming import ingest


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, target, mark = (str(tmp_path / p) for p in ("raw", "fact", "mark"))
    raw(spark).repartition(3).write.parquet(source)
    expected = rows_of(clean_records(raw(spark)))
    stream = readers.read_raw(spark, source, streaming=True, files_per_trigger=1)
    query = ingest.finish(ingest.stream_ingest(stream, target, mark))
    assert ingest.progress(query)["rows"] == len(RECORDS)
    assert rows_of(tables.read_fact(spark, target)) == expected
    more = spark.createDataFrame([record("new", [("user", "hello again")])], RAW)
    more.write.mode("append").parquet(source)
    stream = readers.read_raw(spark, source, streaming=True)
    ingest.finish(ingest.stream_ingest(stream, target, mark))
    fact = tables.read_fact(spark, target)
    assert fact.count() == len(expected) + 1
    assert ingest.skip_done(fact, clean_records(raw(spark))).count() == 1
    assert readers.read_raw(spark, source).count() == len(RECORDS) + 1


def test_batches_and_csv(spark, tmp_path):
    source = str(tmp_path / "raw")
    raw(spark).repartition(2).write.parquet(source)
    stream = readers.read_raw(spark, source, streaming=True, files_per_trigger=1)
    ingest.finish(ingest.stream_batches(clean_records(stream), str(tmp_path / "out"), str(tmp_path / "m1")))
    assert spark.read.parquet(str(tmp_path / "out")).drop("batch").count() == 4
    slim = readers.read_raw(spark, source, streaming=True).select("conversation_hash", "language")
    ingest.finish(ingest.stream_csv(slim, str(tmp_path / "csv"), str(tmp_path / "m2")))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == len(RECORDS)


def test_whole_build(spark, tmp_path):
    path = str(tmp_path / "corpus")
    words = ["python code error", "sql select table", "poem story rhyme"]
    records = [record(f"{i:03d}", [("user", f"{words[i % 3]} {words[i % 3]} question {i}")]) for i in range(60)]
    fact = build.build_corpus(spark.createDataFrame(records + RECORDS, RAW), path)
    assert fact.count() == 64
    stop = ["question"]
    topics = build.build_topics(spark, path, stop, clusters=3, dimensions=2)
    assert topics.count() == 64
    assert topics.filter("topic = 'SQL Database'").count() >= 20
    first = rows_of(topics.select("id", "topic"))
    again = build.build_topics(spark, path, stop, clusters=3, dimensions=2)  # embeddings are cached
    assert rows_of(again.select("id", "topic")) == first
    index = build.build_search(spark, path, stop)
    assert index.stats.first().n_docs == 64
    build.build_summary(spark, path, source="fact_topics")
    summary = build.read_summary(spark, path).first()
    assert summary.total_count == 64
    assert summary.date_range == "2024-05-06 07:08:09 to 2024-05-06 07:08:09"


def test_shared_path_follows_the_session(spark):
    assert shared_path(spark, "x") != shared_path(spark, "x")
    settings = {"spark.checkpoint.dir": "hdfs://shared/folder/"}
    cluster = SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master="yarn"))
    assert shared_path(cluster, "x").startswith("hdfs://shared/folder/x-")
    del settings["spark.checkpoint.dir"]
    settings["spark.sql.warehouse.dir"] = "hdfs://warehouse"
    assert shared_path(cluster, "x").startswith("hdfs://warehouse/scratch/x-")


@pytest.mark.parametrize("bad", ["nothing"])
def test_missing_cache_is_no_error(spark, tmp_path, bad):
    assert not build._exists(spark, str(tmp_path / bad))
