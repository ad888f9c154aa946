"""What near-duplicates send between tasks."""

import random
import re

from parley.llm import key_filter, ordered_minhash


def test_texts_do_not_move_to_be_told_apart(spark, monkeypatch):
    """With no table small enough to be broadcast, only the two texts of a pair move."""
    moved, plain = [], ordered_minhash.stored

    def watched(df, name):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = df._jdf.queryExecution().explainString(mode)
        if re.search(r"\) Exchange\nInput \[\d+\]: \[[^\]]*\btext#", plan):
            moved.append(name)
        return plain(df, name)

    monkeypatch.setattr(ordered_minhash, "stored", watched)
    rng = random.Random(15)
    words = [[f"m{rng.randrange(10**6)}" for _ in range(60)] for _ in range(40)]
    rows = [(i, " ".join(w)) for i, w in enumerate(words)] + [(40 + i, " ".join([*w[:-1], "end"])) for i, w in enumerate(words[:10])]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ordered_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.doc_id: r.class_id for r in out} == {i: i % 40 for i, _ in rows}
    assert not moved


def test_full_filter_loses_nothing(spark, monkeypatch, documents, corpus):
    """A filter that holds far more ids than it was asked for leaves the classes as they are."""
    from tests.llm import brute

    monkeypatch.setattr(key_filter, "FILTER_BITS", 64)
    got = {r.doc_id: r.class_id for r in ordered_minhash.near_duplicates(documents).collect()}
    assert got == brute.near_duplicate_classes(corpus)
