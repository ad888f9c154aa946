"""Search by block maxima: the same rows as without, from fewer postings."""

import random

import pytest
from pyspark.sql import functions as F

from parley.operators import block_search, search

STOP = ["the"]
QUERIES = ["rare", "common", "rare common", "running the middles", "common middle other rare", "absent", "the", ""]


@pytest.fixture(scope="module")
def fact(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        n = int(rng.paretovariate(0.8) * 4)
        words = [rng.choice(["common", "the", "other", "filler", "run", "running", "ran", f"w{chr(97 + i % 26)}"]) for _ in range(min(n, 400))]
        if i % 9 == 0:
            words += ["middle"] * (1 + i % 4)
        if i % 60 == 0:
            words[: i % 7] = ["rare"] * (1 + i % 3)
        rows.append((f"d{i:03d}", f"m{i % 2}", "General / Noise" if i % 7 == 0 else "ab"[i % 3 == 0], i % 8, None, " ".join(words) if i % 50 else None))
    schema = "id string, model_family string, topic string, turn_count int, timestamp timestamp_ntz, search_text string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def indexes(spark, fact, tmp_path_factory):
    out = {}
    for stems in (False, True):
        path = str(tmp_path_factory.mktemp("blocks"))
        written = block_search.write_blocks(fact, path, STOP, stems, blocks=4)
        assert block_search.read_blocks(spark, path, stems).stats.collect() == written.stats.collect()
        out[stems] = written
    return out


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("stems", [False, True])
def test_same_rows_as_scanning_the_texts(fact, indexes, stems, monkeypatch):
    monkeypatch.setattr(block_search, "SEEDS", 3)
    for query in QUERIES:
        for limit in (2, 7):
            wanted = rows_of(search.search(fact, query, limit=limit, stop_words=STOP, stems=stems))
            got = rows_of(block_search.search_blocks(indexes[stems], fact, query, limit=limit, stop_words=STOP))
            assert got == wanted, (query, limit)


def test_same_rows_with_filters(fact, indexes):
    for options in ({"topic": "a"}, {"model": "m1", "min_turns": 3}, {"topic": "nothing"}):
        wanted = rows_of(search.search(fact, "common rare", limit=4, stop_words=STOP, **options))
        assert rows_of(block_search.search_blocks(indexes[False], fact, "common rare", limit=4, stop_words=STOP, **options)) == wanted


def test_blocks_and_classes_are_left_out(fact, indexes, monkeypatch):
    monkeypatch.setattr(block_search, "SEEDS", 4)
    index = indexes[False]
    blocks, postings = block_search.surviving(index, ["common", "rare"], 3, fact.select("id"))
    every = block_search.bounds(index, ["common", "rare"])
    assert 0 < blocks.count() < 0.5 * every.count()
    mine = postings.filter(F.col("root").isin("common", "rare"))
    assert mine.count() < 0.8 * index.postings.filter(F.col("root").isin("common", "rare")).count()
    assert "PartitionFilters: [isnotnull(class" in mine._jdf.queryExecution().toString() or "class#" in mine._jdf.queryExecution().toString()


def test_empty_table(spark, fact, tmp_path):
    index = block_search.write_blocks(fact.limit(0), str(tmp_path), STOP)
    assert block_search.search_blocks(index, fact, "common", stop_words=STOP).count() == 0
