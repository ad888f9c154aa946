"""Topics by density against a comparison of all pairs."""

import math
import random
from collections import Counter

import pytest

from parley.functions.components import components
from parley.operators import density


def plain(rows, eps, min_points):
    """(cluster, core) of each row (id, vector)."""
    def squared(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    near = [[j for j, (_, w) in enumerate(rows) if squared(v, w) <= eps * eps] for _, v in rows]
    core = [len(n) >= min_points for n in near]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, n in enumerate(near):
        for j in n:
            if core[i] and core[j]:
                group[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if core[i]:
            least[find(i)] = min(key, least.get(find(i), key))
    out = []
    for i, n in enumerate(near):
        others = [(squared(rows[i][1], rows[j][1]), rows[j][0], j) for j in n if core[j]]
        to = i if core[i] else min(others)[2] if others else None
        out.append((rows[i][0], None if to is None else least[find(to)], core[i]))
    return Counter(out)


def blobs(seed, n, dims, spread=0.12):
    rng = random.Random(seed)
    middles = [[rng.uniform(0, 2) for _ in range(dims)] for _ in range(4)]
    rows = [[rng.gauss(m, spread) for m in rng.choice(middles)] for _ in range(n)]
    rows += [[rng.uniform(-1, 3) for _ in range(dims)] for _ in range(n // 5)]
    rows += [rows[0]] * (n // 6)
    return list(enumerate(rows))


def frame(spark, rows, dims=None):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "id long, reduced array<double>, cell string, cluster string").repartition(4)


@pytest.mark.parametrize("dims, eps, min_points", [(1, 0.02, 4), (2, 0.1, 5), (3, 0.2, 8), (3, 0.2, 1), (4, 0.3, 12), (2, 0.4, 40)])
def test_equals_all_pairs(spark, dims, eps, min_points):
    rows = blobs(dims, 300, dims)
    got = Counter(map(tuple, density.density_clusters(frame(spark, rows), eps, min_points).collect()))
    wanted = plain(rows, eps, min_points)
    assert got == wanted
    assert min_points == 1 or any(c is None for _, c, _ in wanted)


def test_dense_cells_that_boxes_leave_open(spark):
    """Two crowds along a diagonal line, near at one end only, and two that are not."""
    line = [(i, [0.0 + 0.02 * (i % 7), 0.0 + 0.09 * (i % 7)]) for i in range(70)]
    for shift in (0.6, 0.62, 0.65, 0.7):
        rows = line + [(100 + i, [v[0] + 0.1, v[1] + shift]) for i, v in line]
        got = Counter(map(tuple, density.density_clusters(frame(spark, rows), 0.15, 5).collect()))
        assert got == plain(rows, 0.15, 5)


def test_topics_by_size(spark):
    rows = [(i, [0.0, 0.01 * i]) for i in range(5)] + [(10 + i, [5.0, 0.01 * i]) for i in range(9)] + [(30, [9.0, 9.0]), (31, None), (32, [math.nan, 1.0])]
    got = dict(map(tuple, density.density_topics(frame(spark, rows), 0.5, 3).collect()))
    assert got == {**{i: 1 for i in range(5)}, **{10 + i: 0 for i in range(9)}, 30: -1, 31: -1, 32: -1}


def test_odd_tables(spark):
    assert density.density_topics(frame(spark, []), 0.5, 3).count() == 0
    assert density.density_topics(frame(spark, [(1, None)]), 0.5, 3).collect() == [(1, -1)]
    same = [(7, [1.0, 2.0])] * 50 + [(3, [1.0, 2.0])]
    assert Counter(map(tuple, density.density_clusters(frame(spark, same), 0.1, 5).collect())) == {(7, 3, True): 50, (3, 3, True): 1}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 50), (70, 70)] + [(100, i) for i in range(101, 120)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    wanted = {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50, 70: 70, **{i: 100 for i in range(100, 120)}}
    assert got == wanted
