"""Interleaved layout, kept sketches of users, and streams that take each id once."""

import datetime as dt
import glob
import shutil

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from parley.operators import sketches
from parley.schemas import FACT, conform
from parley.sources import interleave, tables
from parley.streaming import ingest


def fact(spark, n):
    k = F.col("id")
    return conform(
        spark.range(n).select(
            F.md5(k.cast("string")).alias("id"),
            F.when(k % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.lpad((F.hash(k) % 50 + 50).cast("string"), 3, "0"))).alias("topic"),
            F.when(k % 101 != 0, F.concat(F.chr(F.lit(97) + F.pmod(F.hash(k, F.lit(1)), F.lit(12))), F.lit("-family"))).alias("model_family"),
            F.when(k % 97 != 0, F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.pmod(F.hash(k, F.lit(2)), F.lit(100)))).alias("timestamp"),
            F.when(k % 89 != 0, F.concat(F.lit("u"), F.pmod(F.hash(k, F.lit(3)), F.lit(4000)).cast("string"))).alias("hashed_ip"),
        ),
        FACT,
    )


def _met(path, column, low, high):
    """Share of files whose bounds of the column meet the range."""
    files = glob.glob(f"{path}/*.parquet")
    met = 0
    for f in files:
        groups = pq.ParquetFile(f)
        names = [groups.metadata.row_group(0).column(i).path_in_schema for i in range(groups.metadata.num_columns)]
        at = names.index(column)
        stats = [groups.metadata.row_group(i).column(at).statistics for i in range(groups.num_row_groups)]
        met += any(s.has_min_max and s.min <= high and low <= s.max for s in stats)
    return met / len(files), len(files)


def test_every_filter_skips_files(spark, tmp_path):
    rows = fact(spark, 20_000)
    path, plain = str(tmp_path / "z"), str(tmp_path / "plain")
    interleave.write_interleaved(rows, path, files=32)
    day = (dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2))
    for column, low, high in [("timestamp", *day), ("topic", "t070", "t071"), ("model_family", "c-family", "c-family")]:
        share, files = _met(path, column, low, high)
        assert files == 32 and share <= 0.6, (column, share)
    by_topic = rows.repartitionByRange(32, "topic", "model_family").sortWithinPartitions("topic", "timestamp")
    by_topic.write.parquet(plain)
    assert _met(plain, "timestamp", *day)[0] > 0.9
    back = tables.read_fact(spark, path)
    assert back.exceptAll(rows).isEmpty() and back.count() == 20_000
    found = back.filter(F.col("timestamp").between(*day))
    assert "PushedFilters: [IsNotNull(timestamp)" in found._jdf.queryExecution().toString()
    assert found.count() == rows.filter(F.col("timestamp").between(*day)).count()


def test_odd_tables_are_interleaved(spark, tmp_path):
    empty = fact(spark, 0)
    interleave.write_interleaved(empty, str(tmp_path / "empty"))
    assert tables.read_fact(spark, str(tmp_path / "empty")).count() == 0
    same = fact(spark, 50).withColumns({c: F.lit(None).cast(FACT[c].dataType) for c in tables.FILTER_COLUMNS})
    interleave.write_interleaved(same, str(tmp_path / "null"))
    assert tables.read_fact(spark, str(tmp_path / "null")).count() == 50


def test_bits_take_turns(spark):
    ranks = [F.lit(0b101).cast("long"), F.lit(0b011).cast("long")]
    assert spark.range(1).select(interleave.interleaved(ranks, 3)).first()[0] == 0b100111


def test_distinct_users(spark):
    rows = fact(spark, 20_000)
    want = {}
    for r in rows.select("topic", "hashed_ip").collect():
        want.setdefault(r.topic, set()).add(r.hashed_ip)
    want = {t: len(u - {None}) for t, u in want.items()}
    assert {r.topic: r.n_users for r in sketches.distinct_users(rows).collect()} == want
    near = {r.topic: r.n_users for r in sketches.distinct_users(rows, approximate=True).collect()}
    assert near.keys() == want.keys()
    assert all(abs(near[t] - n) <= max(1, sketches.ERROR * n) for t, n in want.items())


def test_sketches_merge(spark):
    rows = fact(spark, 20_000)
    fine = ["topic", "model_family"]
    half = F.substring("id", 1, 1) < "8"
    kept = sketches.user_sketches(rows.filter(half), fine).union(sketches.user_sketches(rows.filter(~half), fine))
    total = sketches.estimated_users(sketches.merged_sketches(kept)).first().n_users
    exact = rows.select("hashed_ip").dropna().distinct().count()
    assert abs(total - exact) <= sketches.ERROR * exact
    merged = {r.topic: r.n_users for r in sketches.estimated_users(sketches.merged_sketches(kept, ["topic"])).collect()}
    whole = {r.topic: r.n_users for r in sketches.distinct_users(rows, approximate=True).collect()}
    assert merged.keys() == whole.keys()
    assert all(abs(merged[t] - whole[t]) <= max(1, 2 * sketches.ERROR * whole[t]) for t in whole)


def test_files_delivered_again_add_nothing(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    k = F.col("id")
    ids = lambda low, high: spark.range(low, high).select(
        F.when(k % 10 != 0, k.cast("string")).alias("id"), F.concat(F.lit("v"), k.cast("string")).alias("v"),
        (F.lit(dt.datetime(2024, 1, 1)) - F.make_dt_interval(k.cast("int"))).alias("timestamp"),
    )

    def run():
        rows = spark.readStream.schema(ids(0, 1).schema).parquet(source)
        ingest.finish(ingest.stream_batches(ingest.once(rows), out, state), 120)
        return sorted((r.id or "", r.v) for r in spark.read.parquet(out).collect())

    def want(high):
        return sorted((str(i) if i % 10 else "", f"v{i}") for i in range(high))

    ids(0, 100).coalesce(1).write.parquet(source)
    assert run() == want(100)
    first = glob.glob(f"{source}/*.parquet")[0]
    shutil.copy(first, f"{source}/again.parquet")
    ids(50, 130).coalesce(1).write.mode("append").parquet(source)
    assert run() == want(130)
    assert run() == want(130)
