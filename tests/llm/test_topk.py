"""Best inner products against all pairs."""

import math
import random
import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parley.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string, uid string"


def plain(rows, k, every):
    """rows: (id, vector). Counter of (query_id, rank, vec_id, score)."""
    able = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for n, (q, a) in enumerate(able):
        if q is None or q % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b, strict=False)), i is None, i or 0, i) for m, (i, b) in enumerate(able) if m != n]
        out.update((q, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:k]))
    return out


def found(spark, rows, k=5, every=5, parts=5):
    df = spark.createDataFrame([(i, v, 1, "r", "s", "u") for i, v in rows], SCHEMA).repartition(parts)
    out = topk.top_k(df, F.col("vec_id") % every == 0, k)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert dict(out.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    return Counter(map(tuple, out.collect()))



def near(a):
    """As 32-bit floats have them."""
    return None if a is None else [None if c is None else struct.unpack("f", struct.pack("f", c))[0] for c in a]


@pytest.fixture(scope="module")
def clustered():
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(150)]  # copies of a query's neighbour
    return [(i, near(v)) for i, v in rows]


@pytest.mark.parametrize("block, batch, chunk", [(1024, 512, 256), (8, 16, 256), (3, 2, 7), (1, 1, 1)])
def test_as_plain(spark, clustered, monkeypatch, block, batch, chunk):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "BATCH_ROWS", batch)
    rows = clustered if block > 1 else clustered[::9]
    assert found(spark, rows) == plain(rows, 5, 5)


def test_blocks_below_the_kth_are_not_met(spark, clustered, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 4)
    seen = []
    keep = topk.stored

    def spying(df, name):
        out = keep(df, name)
        if name == "pairs":
            seen.append(out.agg(F.sum(F.size("picks"))).first()[0] or 0)
        elif name == "blocks":
            seen.append(out.count())
        return out

    monkeypatch.setattr(topk, "stored", spying)
    assert found(spark, clustered, k=2, every=10, parts=1) == plain(clustered, 2, 10)
    n_queries = sum(i % 10 == 0 for i, _ in clustered)
    assert sum(seen[1:]) < 0.6 * seen[0] * n_queries


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (0, [1.0, -2.0]), (5, None), (10, [1.0, None]), (15, [nan, 1.0]), (20, [inf]), (None, [3.0, 1.0]),
            (None, [1.0, -2.0]), (25, []), (30, [0.5]), (3, [1.0, -2.0, 9.0]), (-5, [-1.0, 2.0]), (4, [1.0, -2.0])]
    assert found(spark, rows) == plain(rows, 5, 5)
    assert found(spark, rows[:1]) == Counter()
    assert found(spark, [(1, [1.0]), (5, [-1.0])]) == Counter({(5, 1, 1, -65536): 1})


def test_empty_table(spark):
    assert found(spark, []) == Counter()


def test_great_components(spark):
    rows = [(i, near([s * 5e6, 5e6 + i, s * 7.0])) for i, s in enumerate((1, -1, 1, 1, -1, 1, 1, 1, -1, 1, 1))]
    assert found(spark, rows, k=3) == plain(rows, 3, 5)
