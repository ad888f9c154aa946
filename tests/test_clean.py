from datetime import date, datetime

from pyspark.sql import functions as F

from parley.functions.models import MODELS, model_bucket, with_model_family
from parley.functions.topics import keyword_topic
from parley.operators.clean import clean_records, counted
from parley.operators.lookup import conversation_by_id, conversation_content
from parley.schemas import FACT, RAW

LONG = "z" * 300


def record(key, turns, model="gpt-4o", ts="2024-05-06 07:08:09", language="English", turn=1):
    return (key, model, ts, language, "ip", "Chile", None, turn, turns)


RECORDS = [
    record("a", [("system", "s"), ("user", " Write  a\n script "), ("assistant", "ok"), ("user", "more")]),
    record("b", [("user", "   "), ("user", "hello"), ("user", None)], model="nobody", ts="junk"),
    record("c", [("user", ""), ("assistant", "x")]),
    record("d", [("user", "bonjour")], language="French"),
    record("e", [("user", "no language")], language=None),
    record("f", [("user", LONG)], model=None, ts=None),
    record("g", []),
    record("h", [("user", "x")], ts="2024-05-06T07:08:09"),
]


def raw(spark):
    return spark.createDataFrame(RECORDS, RAW)


def test_clean_records(spark):
    fact = clean_records(raw(spark))
    assert fact.schema.simpleString() == FACT.simpleString()
    rows = {r.id: r for r in fact.collect()}
    assert set(rows) == {"a", "b", "f", "h"}
    a = rows["a"]
    assert a.search_text == "Write a script more" and a.first_turn == "Write a script"
    assert a.topic == "Coding & Debugging"  # 'script' is a keyword of two topics; the first wins
    assert a.token_count == len("s Write  a\n script okmore") // 4
    assert (a.model_family, a.model_release_date) == ("gpt-4o", date(2024, 5, 13))
    assert (a.timestamp, a.year, a.month, a.day, a.hour) == (datetime(2024, 5, 6, 7, 8, 9), 2024, 5, 6, 7)
    b = rows["b"]
    assert b.search_text == " hello" and b.first_turn == ""
    assert (b.model_family, b.model_release_date, b.timestamp, b.year) == ("other", None, None, None)
    assert rows["f"].first_turn == "z" * 200 and rows["f"].model is None
    assert rows["f"].model_family == "other"
    assert rows["h"].timestamp == datetime(2024, 5, 6, 7, 8, 9)


def test_lookup(spark):
    fact = clean_records(raw(spark))
    content = conversation_content(fact, "a").collect()
    assert len(content) == 1 and content[0].message_count == 4
    assert [tuple(t) for t in content[0].conversation][0] == ("system", "s")
    assert conversation_by_id(fact, "missing").count() == 0


def test_counters(spark):
    source = raw(spark)
    read_side, _, read, _ = counted(source, source)
    read_side, kept_side, read, kept = counted(source, clean_records(source))
    assert kept_side.count() == kept.get["rows"] == 4


def test_models(spark):
    df = spark.createDataFrame([(m,) for m, _, _ in MODELS] + [("x",), (None,)], "model string")
    found = {r.model: (r.model_family, r.model_release_date) for r in with_model_family(df).collect()}
    for name, family, released in MODELS:
        assert found[name] == (family, date.fromisoformat(released))
    assert found["x"] == found[None] == ("other", None)


def test_model_bucket(one):
    names = ["gpt-4o-mini", "gpt-3.5-turbo-0301", "o1-preview", "o1", "gpt-4-turbo", None, "llama"]
    buckets = ["gpt-4o", "gpt-3.5-turbo", "o1", "gpt-4", "gpt-4", "gpt-4", "gpt-4"]
    assert one(model_bucket, names) == buckets


def test_keyword_topics(one):
    texts = ["JavaScript", "my character", "solve it", "nothing here", "tell me a story about code"]
    topics = ["Coding & Debugging", "Creative Writing", "Math & Logic", "General", "Coding & Debugging"]
    assert one(keyword_topic, texts) == topics
    assert one(lambda c: keyword_topic(c, {"A": ["x"], "B": ["x", "y"]}, "none"), ["xy", "Y", "z"]) == [
        "A", "B", "none",
    ]


def test_projection_drops_unused_lookup(spark, capsys):
    df = with_model_family(spark.createDataFrame([("gpt-4", 1)], "model string, n int")).select("n")
    df.explain()
    assert "map(" not in capsys.readouterr().out
    assert df.select(F.sum("n")).first()[0] == 1
