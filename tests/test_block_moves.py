"""What the index by blocks makes of rows that share an id, and stems of whole texts."""

import pytest
from pyspark.sql import functions as F

from parley.functions.stem import porter_stem, stem_texts
from parley.operators import block_search

ROWS = [
    ("a", "one two one three one"), ("a", "two two four five one"), ("b", "one one"), ("b", "one one"),
    ("c", "Six, six: seven"), ("d", ""), ("e", None), ("f", "the"),
]


@pytest.fixture(scope="module")
def fact(spark):
    df = spark.createDataFrame(ROWS, "id string, search_text string")
    return df.withColumns({"model_family": F.lit("m"), "topic": F.lit("t"), "turn_count": F.lit(2)})


POSTINGS = {
    ("one", "a", 5, 4, 0), ("two", "a", 5, 3, 0), ("three", "a", 5, 1, 3), ("four", "a", 5, 1, 2), ("five", "a", 5, 1, 3),
    ("one", "b", 2, 4, 0), ("six", "c", 3, 2, 0), ("seven", "c", 3, 1, 2),
}


def test_blocks_of_rows_with_one_id(spark, fact, tmp_path):
    index = block_search.write_blocks(fact, str(tmp_path), ["the"], blocks=2)
    assert tuple(index.stats.first()) == (5, 17 / 5)
    assert {(r.root, r.id, r.length, r.tf) for r in index.postings.collect()} == {(t, i, n, tf) for t, i, n, tf, _ in POSTINGS}
    assert {r.root: r.doc_freq for r in index.roots.collect()}["one"] == 2
    tops = {r.root: r.top for r in index.maxima.collect() if r.root != "one"}
    assert tops["six"] == pytest.approx(2 * 2.2 / (2 + 1.2 * (0.25 + 0.75 * 3 / 3.4)))


def test_stems_of_whole_texts(spark):
    words = "caresses ponies relational hopping a of hopping generalizations".split()
    df = spark.createDataFrame([(" ".join(words),), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(stem_texts(F.col("t"))).collect()] == [" ".join(map(porter_stem, words)), "", None]
