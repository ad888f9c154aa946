"""Passages of over 50 words in the pipeline."""

import random

import corpus_pipeline
from parley.llm import passages, suffixes
from tests.llm.conftest import prose

SCHEMA = "doc_id long, text string, n_chars long"


def words(rng, n):
    return " ".join(f"q{rng.randrange(9000)}" for _ in range(n))


def cut(docs):
    return sorted((str(r.doc_id), r.text) for r in docs.select("doc_id", "text").collect())


def test_passages_too_short_for_the_byte_stage(spark):
    rng = random.Random(51)
    passage, short = words(rng, 51), words(rng, 50)
    assert len(passage) < suffixes.LENGTH
    heads = [words(rng, 30) for _ in range(5)]
    rows = [
        (1, f"{heads[0]}\n\n{passage} \t{heads[1]}"),
        (2, f"{passage}\n{heads[2]}"),
        (None, passage),
        (3, f"{heads[3]} {short}"),
        (4, f"{heads[4]}  {short}"),
        (5, None),
        (6, ""),
    ]
    docs = spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in rows], SCHEMA).repartition(3)
    out = corpus_pipeline.repeated_strings(spark, docs, "")
    assert out.columns == docs.columns and out.filter("n_chars <> length(text)").count() == 0
    want = [("1", f"{heads[0]}\n\n \t{heads[1]}"), ("2", f"\n{heads[2]}"), *[(str(i), t) for i, t in rows[3:]]]
    assert sorted((i, t or "") for i, t in cut(out)) == sorted((i, t or "") for i, t in want)


def test_windows_of_words_by_brute_force(spark):
    rng = random.Random(5)
    pool = [words(rng, n) for n in (51, 52, 60, 75, 140)]
    texts = [" ".join([prose(rng, rng.randrange(40)), *rng.sample(pool, rng.randrange(3)), words(rng, 5)]) for _ in range(40)]
    texts.append(" ".join([words(rng, 80)] * 2))  # twice in one row only
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    holders = {}
    for i, t in enumerate(texts):
        w = t.split()
        for k in range(len(w) - 50):
            holders.setdefault(tuple(w[k : k + 51]), set()).add(i)
    want = []
    for i, t in enumerate(texts):
        w = t.split()
        gone = set()
        for k in range(len(w) - 50):
            if len(holders[tuple(w[k : k + 51])]) > 1:
                gone |= set(range(k, k + 51))
        want.append((str(i), [x for k, x in enumerate(w) if k not in gone]))
    got = [(i, t.split()) for i, t in cut(passages.cut_passages(docs))]
    assert got == sorted(want) and sum(len(w) < len(t.split()) for (_, w), t in zip(want, texts, strict=True)) > 20
