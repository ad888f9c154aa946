import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from parley.functions.quantiles import exact_quantiles
from parley.functions.filters import more_words
from parley.functions.small import member_of
from parley.functions.topn import first_n
from parley.operators.lengths import length_describe, length_profile, length_profile_long
from parley.schemas import RAW

PROBS = (0.0, 0.1, 0.5, 0.75, 0.9, 0.95, 1.0)


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    groups = {
        "hot": np.concatenate([np.full(5000, 3), rng.integers(0, 10**7, 1500)]),
        "wide": rng.integers(-(10**12), 10**12, 777),
        "tiny": np.array([5, 9]),
        "single": np.array([-4]),
        None: np.array([1, 2, 3, 4]),
    }
    rows = [(g, int(v)) for g, vs in groups.items() for v in vs]
    counts = spark.createDataFrame(rows, "g string, v long").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    found = {(r.g, r.prob): r.quantile for r in exact_quantiles(counts, "v", "n", PROBS, ["g"]).collect()}
    assert len(found) == len(groups) * len(PROBS)
    for g, vs in groups.items():
        for p in PROBS:
            assert abs(found[g, p] - np.quantile(vs, p)) <= 1e-9 * max(1, abs(np.quantile(vs, p)))


def test_quantiles_without_groups(spark):
    counts = spark.createDataFrame([(1, 3), (10, 1), (None, 4)], "v int, n long")
    found = {r.prob: r.quantile for r in exact_quantiles(counts, "v", "n", (0.5, 1.0)).collect()}
    assert found == {0.5: 1.0, 1.0: 10.0}


def test_first_n_with_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 5}", i) for i in range(3000)] + [(None, 5000 + i) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, i int")
    found = sorted((r.g or "", r.i) for r in first_n(df, ["g"], "i", 7).collect())
    pdf = pd.DataFrame(rows, columns=["g", "i"]).fillna({"g": ""})
    expected = sorted(map(tuple, pdf.sort_values("i").groupby("g").head(7).itertuples(index=False)))
    assert found == expected


def test_membership(spark):
    df = spark.createDataFrame([(i % 10, i) for i in range(50)] + [(None, 99)], "k int, i int")
    members = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    flagged = member_of(df, "k", members)
    assert flagged.columns == ["k", "i", "_member"] and flagged.count() == 51
    assert sorted(r.i for r in flagged.filter("_member").collect()) == [i for i in range(50) if i % 10 in (1, 3)]
    assert member_of(df, "k", members.filter("k > 5")).filter("_member").count() == 0


def test_deviation_of_large_values(spark):
    rows = [(10**9 + i % 2,) for i in range(1000)]
    r = length_describe(spark.createDataFrame(rows, "v long"), metrics=["v"]).first()
    assert np.isclose(r["std"], np.std([v for v, in rows], ddof=1)) and np.isclose(r["mean"], 10**9 + 0.5)


def test_more_words(spark):
    df = spark.createDataFrame([("a b c",), (" a  b c\nd ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(more_words(F.col("t"), 3)).collect()] == [False, True, False, False]


def test_lengths(spark):
    turns = [(c, t, ["user", "assistant", "system"][t % 3], "x" * (c + t)) for c in range(1, 8) for t in range(c)]
    long = length_profile_long(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    nested = {}
    for c, _, role, text in turns:
        nested.setdefault(str(c), []).append((role, text))
    raw = [(k, None, None, None, None, None, None, 1, v) for k, v in nested.items()]
    other = length_profile(spark.createDataFrame(raw, RAW))
    as_text = long.withColumn("id", F.col("id").cast("string"))
    assert sorted(map(tuple, as_text.collect())) == sorted(map(tuple, other.collect()))
    pdf = long.toPandas()
    assert len(pdf) == 6 and pdf.is_multi_turn.sum() == 4
    expected = pdf.total_chars.describe(percentiles=[0.5, 0.75, 0.9, 0.95])
    r = length_describe(long).filter("metric = 'total_chars'").first()
    got = [r["count"], r["mean"], r["std"], r["min"], r["p50"], r["p75"], r["p90"], r["p95"], r["max"]]
    assert np.allclose(got, expected.to_numpy())
