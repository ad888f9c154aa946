import random

import pytest

from tests.llm.brute import SCHEMA


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), vocabulary)}x{rng.randrange(60)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(id, text) with copies, near copies, shared passages, repeated lines, and odd texts."""
    rng = random.Random(7)
    texts = [prose(rng, rng.randrange(1, 260)) for _ in range(90)]
    for _ in range(12):
        texts.append(rng.choice(texts))
    base = prose(rng, 180)
    for _ in range(25):
        w = base.split(" ")
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    passage = prose(rng, 90)
    for _ in range(15):
        texts.append(f"{prose(rng, rng.randrange(0, 60))} {passage}\n{prose(rng, rng.randrange(0, 60))}")
    line = prose(rng, 70)
    texts += ["\n".join([line] * 3), "a" * 900, "ab " * 400, "é" * 500 + " ñ", "", "   \n\t", None, "x", "MIT License"]
    texts += [None, "", "two words", "Two  Words", prose(rng, 6000)]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in corpus]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)
