"""Mini-batch k-means against a plain version."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.operators import minibatch, topics


def hashed(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def plain(rows, k, seed, batch_rows, steps, patience=None):
    """(centres, seen, steps made) for rows (id, vector)."""
    rows = sorted(rows)
    n = max(1, math.ceil(len(rows) / batch_rows))
    batches = [[r for r in rows if hashed(f"{seed}:{r[0]}") % n == b] for b in range(n)]
    centres = []
    for step in range(min(k, len(batches[0]))):
        best = None
        for i, v in batches[0]:
            apart = min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres), default=1.0)
            if apart > 0:
                lot = math.log((hashed(f"{seed}:{i}:{step}") + 0.5) / 2**32) / apart
                if best is None or lot > best[0]:
                    best = (lot, v)
        if best is None:
            break
        centres.append(np.array(best[1]))
    seen, smoothed, best, since = [0] * len(centres), None, None, 0
    for step in range(steps):
        groups, costs = {}, []
        for _, v in batches[step % n]:
            far = [((np.array(v) - c) ** 2).sum() for c in centres]
            costs.append(min(far))
            groups.setdefault(int(np.argmin(far)), []).append(v)
        for c, vs in groups.items():
            seen[c] += len(vs)
            centres[c] = centres[c] * (1 - len(vs) / seen[c]) + np.sum(vs, axis=0) / seen[c]
        if costs:
            cost, share = np.mean(costs), min(1.0, 2 * batch_rows / (len(rows) + 1))
            smoothed = cost if smoothed is None else smoothed * (1 - share) + cost * share
            best, since = (smoothed, 0) if best is None or smoothed < best * (1 - 1e-9) else (best, since + 1)
            if patience is not None and since >= patience:
                return centres, seen, step + 1
    return centres, seen, steps


def groups(n, k, dims, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 10, (k, dims))
    own = rng.integers(0, k, n)
    return [(int(i), [float(x) for x in middle[g] + rng.normal(0, 0.3, dims)]) for i, g in enumerate(own)], own


@pytest.mark.parametrize("batch_rows, steps, patience", [(64, 12, None), (10_000, 6, None), (40, 60, 3), (300, 40, 4)])
def test_equals_plain(spark, batch_rows, steps, patience):
    rows, _ = groups(500, 7, 3)
    df = spark.createDataFrame(rows, "id long, reduced array<double>").repartition(4)
    centres, seen, made = plain(rows, 7, 5, batch_rows, steps, patience)
    got = minibatch.fit(df, 7, 5, "reduced", "id", batch_rows, steps, patience)
    assert got.steps == made and got.seen == seen
    assert np.allclose(got.centres, centres, rtol=0, atol=1e-9)
    near = [int(np.argmin([((np.array(v) - c) ** 2).sum() for c in centres])) for _, v in rows]
    out = minibatch.assign(df, got.centres, "reduced").orderBy("id").collect()
    assert [r.cluster_id for r in out] == near


def test_separated_groups_are_recovered(spark):
    rows, own = groups(1500, 6, 5, seed=4)
    df = spark.createDataFrame(rows, "id long, reduced array<double>")
    out = {r.id: r.cluster_id for r in minibatch.minibatch_kmeans(df, 6, batch_rows=256).collect()}
    pairs = {(int(own[i]), c) for i, c in out.items()}
    assert len(pairs) == 6 == len({c for _, c in pairs}) and len(out) == 1500


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 1.0]), (1, [1.0, 1.0]), (None, [5.0, 5.0]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [1.0, 1.5])]
    df = spark.createDataFrame([(i, v, "c") for i, v in rows], "id long, reduced array<double>, cluster string")
    out = minibatch.minibatch_kmeans(df, 5).collect()
    assert sorted(r.cluster_id is None for r in out) == [False] * 4 + [True] * 3
    assert len({r.cluster_id for r in out}) == 4
    assert minibatch.minibatch_kmeans(df.limit(0), 5).count() == 0
    assert {r.cluster_id for r in minibatch.minibatch_kmeans(df.filter("id = 2"), 5).collect()} == {None}


def test_in_the_build(spark):
    rows, _ = groups(200, 4, 8)
    df = spark.createDataFrame([(str(i), v) for i, v in rows], "id string, embedding array<double>")
    out = topics.cluster_embeddings(df, 4, 3, batch_rows=50)
    assert out.groupBy("cluster_id").count().count() == 4
    assert out.filter(F.col("cluster_id").isNull()).count() == 0
