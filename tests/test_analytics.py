from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parley.functions.filters import build_filters
from parley.operators import anomaly, macro, summary, users

SCHEMA = (
    "id string, model_family string, topic string, timestamp timestamp_ntz, hashed_ip string, "
    "country string, turn_count int, token_count int, search_text string"
)


def row(i, family="gpt-4", topic="A", ts=datetime(2024, 1, 1), ip="u", turns=2, tokens=10, country="Chile"):
    return (f"{i:05d}", family, topic, ts, ip, country, turns, tokens, f"text {i}")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def fact(spark):
    rows = []
    for i in range(300):
        topic = [None, "General / Noise", "A", "B", "A", "C"][i % 6]
        ts = None if i % 50 == 0 else datetime(2024, 1 + i % 4, 1 + i % 28, i % 24)
        rows.append(
            row(i, ["gpt-4", "o1", "gpt-4o"][i % 3], topic, ts, f"u{i % 7}", 1 + i % 5, i, ["Chile", None][i % 2])
        )
    rows.append(row(999, topic="B", turns=400))
    return frame(spark, rows).cache()


def test_filters(spark, fact):
    everything = fact.count()
    assert fact.filter(build_filters(exclude_noise=False, models=[], topic="", start="", min_turns=0)).count() == everything
    assert fact.filter(build_filters()).count() == fact.filter("topic <> 'General / Noise'").count()
    days = frame(spark, [row(1, ts=datetime(2024, 1, 2)), row(2, ts=datetime(2024, 1, 2, 0, 0, 1)), row(3, ts=None)])
    kept = days.filter(build_filters(start="2024-01-01", end="2024-01-02"))
    assert [r.id for r in kept.collect()] == ["00001"]


def test_topic_stats(fact):
    rows = macro.topic_stats(fact).collect()
    assert [r.topic for r in rows] == ["A", "B", "C"]
    assert abs(sum(float(r.percentage) for r in rows) - 100) < 0.05
    assert macro.topic_stats(fact, models=["none"]).count() == 0
    assert macro.topic_stats(fact, limit=1).count() == 1


def test_topic_stats_by_model(fact):
    rows = macro.topic_stats_by_model(fact, ["o1", "it's", "o1"], limit=2).collect()
    assert {r.model_family for r in rows} == {"o1", "it's"}
    missing = [r for r in rows if r.model_family == "it's"]
    assert [(r.total_conversations, r.topic, r["count"]) for r in missing] == [(0, None, None)]


def test_engagement_rounds_half_to_even(spark):
    rows = [row(i, turns=2 + i % 2, tokens=7) for i in range(60)] + [row(100 + i, "o1") for i in range(50)]
    result = macro.engagement(frame(spark, rows)).collect()
    assert len(result) == 1  # a group of exactly 50 is left out
    r = result[0]
    assert (r.avg_turns, r.median_turns, r.avg_total_tokens, r.avg_tokens_per_turn) == (2, 2, 7, 3)
    with pytest.raises(ValueError):
        macro.engagement(frame(spark, rows), "country")


def test_trends(fact):
    rows = macro.temporal_trends(fact).collect()
    assert rows[-1].period is None and rows[0].period == datetime(2024, 1, 1)
    assert sum(r["count"] for r in rows) == fact.filter(build_filters()).count()
    assert macro.trend_peak(macro.temporal_trends(fact)).first().period is not None
    with pytest.raises(ValueError):
        macro.temporal_trends(fact, "day")


def test_users(spark):
    rows = [row(i, ip="x", topic="AB"[i % 2]) for i in range(12)] + [row(50 + i, ip="y", topic="C") for i in range(11)]
    rows += [row(80 + i, ip=None) for i in range(3)] + [row(90, ip="z", topic="General / Noise")]
    df = frame(spark, rows)
    top = users.power_users(df).collect()
    assert [(r.hashed_ip, r.total_convos, r.favorite_topic) for r in top] == [("x", 12, "A"), ("y", 11, "C"), (None, 3, "A")]
    special = users.specialists(df).collect()
    assert [(r.hashed_ip, r.distinct_topics, r.main_interest) for r in special] == [("y", 1, "C"), ("x", 2, "A")]
    with pytest.raises(ValueError):
        users.user_behavior(df, "other")


def test_anomalies(spark, fact):
    out = anomaly.length_outliers(fact, threshold=10.0).collect()
    assert [r.id for r in out] == ["00999"] and out[0].metric_value == 400
    assert anomaly.length_outliers(fact, model="none").count() == 0
    df = frame(spark, [row(i, topic="big") for i in range(50)] + [row(60 + i, topic="few") for i in range(3)] + [row(99, topic=None)])
    assert [r.topic for r in anomaly.rare_topics(df).collect()] == ["few"] * 3
    assert anomaly.rare_topics(df, model="o1").count() == 0
    with pytest.raises(ValueError):
        anomaly.anomalies(df, "other")


def test_summary(spark, fact):
    s = summary.dataset_summary(fact).first()
    assert s.total_count == fact.count()
    assert s.topic_json.startswith('[{"name":"A","count":')
    assert "null" not in s.country_json
    empty = summary.dataset_summary(fact.filter(F.lit(False))).first()
    assert (empty.total_count, empty.model_json) == (0, None)
    assert [r.column_name for r in summary.table_schema(fact).orderBy("position").collect()] == fact.columns
