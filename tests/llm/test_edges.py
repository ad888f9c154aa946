"""Odd tables for each operator: nothing, NULLs everywhere, repeated rows, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import (
    chat,
    decontaminate,
    licenses,
    maxent,
    ordered_minhash,
    packing,
    quality,
    registry,
    substrings,
    suffixes,
    urls,
)
from parley.llm.registry import END_ID, tokenizer_path
from tests.llm import brute

LONG = " ".join(f"word{i}" for i in range(60))

# Columns that the operators add or use inside, in the input.
CLASHING = ["notices", "quality", "repeats", "items", "host", "path", "rule", "verdict", "n_words", "kept", "key", "id",
            "doc", "part", "uid", "bucket", "class_id", "score", "held_out", "windows", "cores", "__key", "a", "b"]


def table(spark, rows):
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *CLASHING) for i, t in rows], f"doc_id long, text string, {extra}")


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def outcomes(spark, docs):
    """The number of rows that each operator returns for a table of documents."""
    items = benchmark(spark, [(1, LONG), (None, None)])
    return {
        1: licenses.find_notices(docs).count(),
        2: quality.assess(docs).count(),
        4: ordered_minhash.near_duplicates(docs).count(),
        5: decontaminate.find_items(docs, items).count(),
        6: maxent.score_texts(docs).count(),
        7: substrings.remove_repeats(docs).count(),
        10: suffixes.remove_repeats(docs).count(),
    }


def test_empty_tables(spark):
    docs = table(spark, [])
    assert set(outcomes(spark, docs).values()) == {0}
    assert packing.pack(docs, tokenizer_path(), END_ID).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.repair(turns).count() == 0
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    rules = urls.rule_table(spark, registry.URL_RULES)
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert urls.judge(pages, rules.limit(0)).first().verdict == "allow"
    none = decontaminate.find_items(table(spark, [(1, LONG)]), benchmark(spark, []))
    assert none.first()["items"] == []
    assert ordered_minhash.keep_one(docs).count() == 0


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None, None), (None, LONG), (1, None), (1, LONG), (1, LONG), (2, LONG), (2, ""), (3, LONG + " x"), (-5, "y " + LONG)]
    return table(spark, rows), rows


def test_null_and_repeated_rows(spark, odd):
    docs, rows = odd
    assert set(outcomes(spark, docs).values()) == {len(rows)}


def test_clashing_columns_stay_or_are_replaced(spark, odd):
    docs, _ = odd
    for out, own in (
        (licenses.find_notices(docs), "notices"), (quality.assess(docs), "quality"),
        (substrings.remove_repeats(docs), "repeats"), (suffixes.remove_repeats(docs), "repeats"),
        (decontaminate.find_items(docs, benchmark(spark, [(1, LONG)])), "items"),
    ):
        assert sorted(out.columns) == sorted(docs.columns)
        kept = [c for c in CLASHING if c != own]
        assert out.select(*kept).distinct().collect() == [tuple(kept)]


def test_ids_of_near_duplicates(spark, odd):
    docs, _ = odd
    got = sorted(map(tuple, ordered_minhash.near_duplicates(docs).collect()), key=str)
    assert all((i is None) == (c is None) for i, c in got)
    rows = [(1, LONG), (1, LONG), (2, LONG), (3, LONG + " x"), (-5, "y " + LONG), (7, None), (8, " "), (None, LONG)]
    docs = table(spark, rows)
    got = dict(map(tuple, ordered_minhash.near_duplicates(docs).collect()))
    assert got == {1: -5, 2: -5, 3: -5, -5: -5, 7: 7, 8: 7, None: None}
    kept = ordered_minhash.keep_one(docs).select("doc_id").collect()
    assert sorted(str(r.doc_id) for r in kept) == ["-5", "7", "None"]


def test_ids_of_repeated_passages(spark, odd):
    docs, _ = odd
    out = substrings.remove_repeats(docs).collect()
    removed = sorted((str(r.doc_id), r.repeats.n_removed) for r in out)
    assert removed == sorted([("None", 0), ("None", 0), ("1", 0), ("1", 60), ("1", 60), ("2", 60), ("2", 0), ("3", 60), ("-5", 0)])


def test_bytes_of_equal_rows_remove_each_other(spark):
    text = "z" + LONG * 2
    out = suffixes.remove_repeats(table(spark, [(None, text), (None, text), (4, None)])).orderBy("doc_id").collect()
    assert [r.repeats.n_removed for r in out] == [len(text), len(text), 0]
    assert out[2].repeats.n_bytes == 0 and out[2].repeats.spans == []


def test_pieces_of_odd_rows(spark, odd):
    docs, rows = odd
    out = packing.pack(docs, tokenizer_path(), END_ID, length=32).collect()
    assert sum(p.length for p in out) == sum(p.doc_tokens for p in out if p.start == 0)
    assert sum(p.start == 0 for p in out) == len(rows)
    assert sum(p.doc_tokens == 1 for p in out) == 3


def test_odd_turns(spark):
    rows = [(None, None, None, None)] * 3 + [(1, 1, "user", "a"), (1, 1, "user", "a"), (1, 1, "assistant", "b")]
    out = chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    # Ties go by role, then by text: the assistant's turn comes first here.
    first = out.filter("conv_id = 1").orderBy("position", "piece").collect()
    assert [r.role for r in first] == ["user", "assistant", "user", "user", "assistant"]
    assert [r.action for r in first] == ["insert", "keep", "keep", "merge", "insert"]
    assert out.filter("conv_id is null and action <> 'insert'").count() == 3


# ---- the pipeline, stage by stage ----


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    documents = documents.withColumn("text", F.concat("text", F.lit(".")))
    documents = documents.withColumn("n_chars", F.length("text").cast("long"))
    first = documents.filter("length(text) > 300").orderBy("doc_id").first()
    item = " ".join(first.text.split()[3:20])
    benchmark(spark, [(7, item)]).write.parquet(f"{folder}/benchmark.parquet")
    documents.write.parquet(f"{folder}/documents.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(folder))
        path = f"{folder}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        seen.append((name, docs, spark.read.parquet(path)))
        docs = seen[-1][2]
    return seen, item, str(folder)


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_and_columns(stages):
    seen, _, _ = stages
    assert [n for n, _, _ in seen] == ["quality rules", "near duplicates", "repeated strings", "benchmark leaks", "packing"]
    for name, docs, out in seen[:-1]:
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert out.filter("n_chars <> length(text)").count() == 0


def test_quality_stage(stages):
    _, docs, out = stages[0][0]
    before, after = texts(docs), texts(out)
    for i, t in before.items():
        w = brute.words(t)
        if len(w) < 10:
            assert i not in after
        elif len(set(w)) > 0.9 * len(w) and "." in t.split("\n")[0]:
            assert after[i] == t


def test_near_duplicate_stage(stages):
    _, docs, out = stages[0][1]
    before = texts(docs)
    kept = set(brute.near_duplicate_classes(list(before.items())).values())
    assert texts(out) == {i: before[i] for i in kept}


def test_repeated_string_stage(stages):
    _, docs, out = stages[0][2]
    before = texts(docs)
    want = {}
    for i, r in zip(before, brute.repeated_bytes(list(before.values())), strict=True):
        t = before[i] if not r[1] else r[3].decode("utf-8", "ignore")
        if t or not r[1]:
            want[i] = t
    assert texts(out) == want


def test_leak_stage(stages):
    seen, item, _ = stages
    _, docs, out = seen[3]
    wanted = decontaminate.shingles_of(item.encode())
    clean = {i: t for i, t in texts(docs).items()
             if len(wanted & decontaminate.shingles_of(t.encode())) < 0.8 * len(wanted)}
    assert texts(out) == clean and len(clean) < docs.count()


def test_run_is_the_stages(spark, stages):
    seen, _, folder = stages
    _, docs, out = seen[4]
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.columns == columns
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert out.agg(F.sum("length")).first()[0] == out.filter("start = 0").agg(F.sum("doc_tokens")).first()[0]
