"""Gradient steps of the language model against their plain form, and what they cost."""

import time

import numpy as np

from parley.llm import maxent


def test_find(monkeypatch):
    rng = np.random.default_rng(21)
    for n in (1, 2, 3, 1000):
        hashes = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64) >> np.uint64(rng.integers(0, 60)))
        words = maxent.Lexicon(hashes, np.ones(len(hashes), np.int64), np.arange(len(hashes)), n, n)
        top = np.array([0, 1, (1 << 64) - 1], np.uint64)
        asked = np.concatenate([hashes, hashes + np.uint64(1), hashes - np.uint64(1), top, rng.integers(0, 1 << 64, 500, dtype=np.uint64)])
        where = {h: i for i, h in enumerate(hashes.tolist())}
        assert words.find(asked).tolist() == [where.get(h, -1) for h in asked.tolist()]


def test_sums_of_rows():
    rng = np.random.default_rng(22)
    for size in (1, 7, 1 << 16, 1 << 17):
        rows = np.minimum(rng.zipf(1.3, 5000) - 1, size - 1)
        gradient = rng.normal(size=(5000, 33)).astype(np.float32)
        at, sums = maxent._added_rows(rows, gradient, size)
        wanted = np.zeros((size, 33))
        np.add.at(wanted, rows, gradient.astype(np.float64))
        assert at.tolist() == np.unique(rows).tolist()
        np.testing.assert_allclose(sums, wanted[at], rtol=1e-4, atol=1e-3)


def test_a_step_costs_less_than_its_plain_form():
    """Rows that stand a few times each, as features of contexts do."""
    rng = np.random.default_rng(23)
    weight, seen = np.zeros((8192, 33), np.float32), np.ones((8192, 33), np.float32)
    gradient = rng.normal(size=(4096, 33)).astype(np.float32)
    rows = rng.integers(0, 8192, 4096) * rng.integers(0, 2, 4096)

    def plain():
        order = np.argsort(rows, kind="stable")
        heads = np.flatnonzero(np.diff(rows[order], prepend=-1))
        return np.add.reduceat(gradient[order], heads, axis=0)

    def cpu(run):
        times = []
        for _ in range(15):
            began = time.thread_time()
            run()
            times.append(time.thread_time() - began)
        return min(times)

    trainer = maxent.Trainer.__new__(maxent.Trainer)
    assert cpu(lambda: trainer._update(weight, seen, rows, gradient)) < 1.5 * cpu(plain)
    assert cpu(lambda: maxent._added_rows(rows, gradient, 8192)) < cpu(plain)
