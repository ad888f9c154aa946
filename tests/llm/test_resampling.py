"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from parley.llm import resampling

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
SCHEMA = "doc_id long, text string, score string, rank string, id string"


def words(text):
    return re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def grams(text, most):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def buckets(text, most, size):
    return Counter(zlib.crc32(g.encode()) % size for g in grams(text, most))


def plain(docs, target, percent=10, least=20, most=1, size=10_000, seed=2024):
    s, t = (sum((buckets(x, most, size) for x in xs), Counter()) for xs in ([x for _, x in docs], target))
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (s.total() + size) / ((s[b] + 1) * (t.total() + size)))) for b in range(size)
    ]
    rows = []
    for i, text in docs:
        found = buckets(text, most, size)
        n = found.total()
        weight = math.floor(Fraction(sum(gain[b] * k for b, k in found.items()), n)) if n else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(words(text)), n, weight, score))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, -r[3], r[2]))
    drawn = able[: percent * len(able) // 100]
    return Counter(
        [(*r, k + 1) for k, r in enumerate(drawn)]
        + [(*r, None) for r in able[len(drawn) :]]
        + [(*r, None) for r in rows if r[1] < least]
    )


def table(spark, rows):
    return spark.createDataFrame([(i, t, "s", "r", "x") for i, t in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("options", [{}, {"percent": 35, "most": 3, "buckets": 512, "least_words": 3, "seed": 5}])
def test_as_plain(spark, corpus, options):
    target = [t for _, t in corpus[:9]] + [None, ""]
    got = resampling.draw(table(spark, corpus), spark.createDataFrame([(t,) for t in target], "text string"), **options)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    own = {"least_words": "least", "buckets": "size"}
    assert Counter(map(tuple, got.collect())) == plain(corpus, target, **{own.get(k, k): v for k, v in options.items()})


def test_null_and_repeated_rows(spark):
    long = " ".join(f"Word{i % 7}" for i in range(30))
    docs = [(None, None), (None, long), (None, long), (1, long), (1, long), (1, long + " é"), (2, ""), (3, "--"), (-4, long)] * 5
    for target in ([long], []):
        got = resampling.draw(table(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"), percent=50)
        assert Counter(map(tuple, got.collect())) == plain(docs, target, percent=50)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert resampling.draw(table(spark, []), none).count() == 0


def test_rows_drawn(spark, corpus):
    docs = table(spark, corpus)
    ranks = resampling.draw(docs, docs.limit(3), percent=20)
    got = resampling.drawn(docs, ranks)
    assert got.columns == docs.columns
    wanted = {r.doc_id for r in ranks.filter("rank is not null").collect()}
    assert sorted(map(tuple, got.collect())) == sorted((*r, "s", "r", "x") for r in corpus if r[0] in wanted)
    assert wanted


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_pieces_and_grams(monkeypatch, size):
    text = "The quick-brown ÉCOLE fox_9 jumps\x7fover " + "x" * 20 + " ünïcode 42"
    data = memoryview(text.encode())
    assert [w.decode() for p in resampling.pieces(data, size) for w in p] == words(text)
    monkeypatch.setattr(resampling.pieces, "__defaults__", (size,))
    for most in (1, 2, 4):
        n, found = resampling.features(data, most)
        assert n == len(words(text))
        assert found == Counter(zlib.crc32(g.encode()) for g in grams(text, most))
