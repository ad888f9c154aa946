import json

import pytest
from pyspark.sql import functions as F

from parley.operators import annotate, freq
from parley.operators.sandbox import ForbiddenStatement, check_read_only, guarded_rows, guarded_sql
from parley.schemas import ANNOTATION, RAW
from parley.sources import readers, tables


def test_parse_answers(spark):
    cases = {
        '```json\n{"cat": "Coding", "lang": "SQL", "err": "None"}\n```': ("Coding", "SQL", "None"),
        '{"cat": "Math"}': ("Math", "None", "None"),
        '{"cat": null, "lang": null}': (None, None, "None"),
        "[1, 2]": ("Error", "None", "None"),
        '{"cat": "x"': ("Error", "None", "None"),
        "hello": ("Error", "None", "None"),
        "": ("Error", "None", "None"),
        "{}": ("Other", "None", "None"),
        '"text"': ("Error", "None", "None"),
    }
    df = spark.createDataFrame([(a,) for a in [*cases, None]], "answer string")
    for r in annotate.parse_answers(df).collect():
        assert (r.category, r.language, r.error) == cases.get(r.answer, ("Error", "None", "None")), r


def test_eligible_prompts_and_hook(spark):
    def raw(key, turns, language="English"):
        return (key, None, None, language, None, None, None, 1, turns)

    rows = [
        raw("a", [("user", "write code now")]),
        raw("b", [("assistant", "write code now")]),
        raw("c", [("user", "short")]),
        raw("d", [("user", "x" * 10_000)]),
        raw("e", [("user", "bonjour monde")], "French"),
        raw("f", [("user", None)]),
        raw("g", []),
        raw("h", [("user", "y" * 9_999)]),
    ]
    prompts = annotate.eligible_prompts(spark.createDataFrame(rows, RAW))
    assert {r.id for r in prompts.collect()} == {"a", "h"}
    strict = annotate.eligible_prompts(
        spark.createDataFrame(rows, RAW), count_tokens=lambda p: F.length(p), max_tokens=100
    )
    assert {r.id for r in strict.collect()} == {"a"}

    def load_model():
        return lambda texts: [json.dumps({"cat": "Coding", "lang": t[:5]}) for t in texts]

    answers = annotate.external_answers(prompts.filter("id = 'a'"), load_model)
    found = annotate.annotations(answers).first()
    assert tuple(found) == ("write code now", "Coding", "write", "None")


def test_frequencies(spark):
    rows = [("p", None, "c/c++", " Some Error "), ("p", "coding ", None, "abc"), ("p", " Coding", "null", None),
            ("p", "coding", "C/C++", "Some Error"), ("p", "OTHER", "unknown", "Unknown")]
    df = spark.createDataFrame(rows, ANNOTATION)
    assert [tuple(r) for r in freq.top_categories(df).collect()] == [("Coding", 3), ("Other", 2)]
    assert [tuple(r) for r in freq.top_languages(df).collect()] == [("C/C++", 2)]
    assert [tuple(r) for r in freq.top_errors(df).collect()] == [("Some Error", 2)]
    report = sorted(tuple(r) for r in freq.freq_report(df, limit=1).collect())
    assert report == [("Top Categories", 1, "Coding", 3), ("Top Errors", 1, "Some Error", 2), ("Top Languages", 1, "C/C++", 2)]
    assert freq.normalize_annotations(df).filter("language = 'C/C++'").count() == 2


def test_annotation_csv_round_trip(spark, tmp_path):
    rows = [('say "hi",\nplease', "None", None, "x"), ("p", "Coding", "nan", "NULL")]
    path = str(tmp_path / "annotations")
    tables.write_csv(spark.createDataFrame(rows, ANNOTATION), path)
    tables.write_csv(spark.createDataFrame(rows[:1], ANNOTATION), path, append=True)
    back = [tuple(r) for r in readers.read_annotations(spark, path).collect()]
    assert sorted(back, key=str) == sorted(rows + rows[:1], key=str)


def test_profile_json(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([{"b": 1, "a": None}, {"a": 2, "c": {"x": 1}}]))
    (tmp_path / "two.json").write_text(json.dumps([{"z": "q"}], indent=2))
    (tmp_path / "no.txt").write_text("x")
    rows = readers.profile_json(spark, str(tmp_path / "*.json")).collect()
    assert [(r.file, r.num_items) for r in rows] == [("one.json", 2), ("two.json", 1)]
    assert set(rows[0]["keys"].split(", ")) == {"a", "b"}
    assert json.loads(rows[0].first_item) == {"b": 1, "a": None}


READS = [
    "SELECT 1", " with x as (select 1 as a) select * from x;", "VALUES (1)", "select 'drop table x' as s",
    "select updated_at from (select 1 as updated_at)", "select 1 -- delete", "(select 1)",
    "select * from chats where n in (select max(n) from CHATS)", "with a as (select 1 as n), b as (select * from a) select * from b",
    "select n, row_number() over (order by n) r from chats group by n having n > 1 order by 1 limit 3",
]
WRITES = [
    "DROP TABLE chats", "select 1; drop table x", "insert into chats values (1)", "create table t as select 1",
    "with x as (select 1) insert into t select * from x", "SET a=b", "cache table chats", "", "explain drop table chats",
    "select reflect('java.lang.System', 'exit', 1)", "/* x */ delete from chats",
    "describe chats", "show tables", "select * from other", "select * from text.`/etc/hostname`", "select * from range(9)",
    "select 1 -- x\r, java_method('java.lang.System', 'exit', '1')", "select r'\\', java_method('a', 'b') , 'x'",
    "select system.builtin.reflect('a', 'b')", "select (select max(n) from other)", "select * from chats where exists (select 1 from other)",
    "with chats2 as (select * from other) select * from chats2", "select transform(array(1), x -> reflect('a', 'b'))",
]


@pytest.mark.parametrize("sql", READS)
def test_reads_pass(spark, sql):
    check_read_only(spark, sql, ["chats"])


@pytest.mark.parametrize("sql", WRITES)
def test_writes_are_refused(spark, sql):
    with pytest.raises(ForbiddenStatement):
        check_read_only(spark, sql, ["chats"])


def test_views_of_the_caller_stay(spark):
    spark.range(3).createOrReplaceTempView("kept")
    assert guarded_sql(spark, "select * from kept", {"kept": spark.range(5)}).count() == 5
    assert spark.table("kept").count() == 3
    spark.catalog.dropTempView("kept")


def test_guarded_sql_caps_rows(spark):
    chats = spark.range(100).toDF("turn_count")
    assert guarded_sql(spark, "select * from chats where turn_count > 5", {"chats": chats}).count() == 20
    rows, truncated = guarded_rows(spark, "select * from chats order by turn_count", {"chats": chats}, 3)
    assert [r["turn_count"] for r in rows] == [0, 1, 2] and truncated
    rows, truncated = guarded_rows(spark, "select * from chats where turn_count < 3", {"chats": chats}, 3)
    assert len(rows) == 3 and not truncated
    assert not spark.catalog.tableExists("chats")


def test_json_records(spark):
    df = spark.sql("select 'a' as id, cast(null as string) as topic, timestamp_ntz'2024-01-02 03:04:05' as t")
    assert tables.json_records(df).first().record == '{"id":"a","topic":null,"t":"2024-01-02T03:04:05.000"}'


def test_csv_keeps_white_space(spark, tmp_path):
    rows = [("  a, b ", "Coding", "None", 'say "x"\n '), ("tab\t", None, "Python", None)]
    table = spark.createDataFrame(rows, ANNOTATION)
    tables.write_csv(table, str(tmp_path), append=True)
    tables.write_csv(table.limit(0), str(tmp_path), append=True)
    assert sorted(map(tuple, readers.read_annotations(spark, str(tmp_path)).collect())) == sorted(rows)
