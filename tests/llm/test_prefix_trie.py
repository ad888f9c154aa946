"""The prefix trie against a plain one."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from parley.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, low string, g string"
WORD = "[^\x20\x09-\x0D]+"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain(rows, every=None, most=4):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, digest(r or "", x or ""), (r or "", x or "")))
    convs = {c: [e[3] for e in sorted(v)] for c, v in convs.items()}
    if every:
        own, convs = convs, {}
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % most
            sign = -1 if c < 0 else 1
            convs[c] = own.get(c - sign * (abs(c) % every), [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(re.findall(WORD, p[-1][1])) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        above = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), above, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def found(spark, rows, parts=5, **options):
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(parts)
    out = trie.prefix_trie(df, **options)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(map(tuple, out.collect()))


def talk(rng, n, kinds=3):
    return [(rng.choice(("user", "assistant")), "w " * rng.randrange(4) + rng.choice("ab"[:kinds])) for _ in range(n)]


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(11)
    rows = []
    for c in range(150):
        rows += [(c, t, *x) for t, x in enumerate(talk(rng, rng.randrange(1, 7)))]
    copy = talk(rng, 5)
    for c in range(200, 300):
        rows += [(c, t, *x) for t, x in enumerate(copy[: rng.choice((5, 5, 5, 4, 2))])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("every", [None, 20, 7])
def test_as_plain(spark, conversations, every):
    assert found(spark, conversations, every=every) == plain(conversations, every)


@pytest.mark.parametrize("sizes", [trie.Sizes(block=40), trie.Sizes(block=10, last=100), trie.Sizes(2, 30, 200)])
def test_small_blocks_and_segments(spark, conversations, sizes):
    rows = [r for r in conversations if r[0] % 3 or r[0] > 220]
    assert found(spark, rows, every=20, parts=3, sizes=sizes) == plain(rows, 20)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, None, None, None), (1, 0, "user", None), (1, 0, None, "user"),
            (-3, 1, "user", "a b"), (-3, 1, "user", "a b"), (-23, 5, "user", "a b"), (40, 1, "r", "t"), (45, 1, "r", ""), (45, 2, "r", "t")]
    for every in (None, 20):
        assert found(spark, rows, every=every) == plain(rows, every)


def test_turnless_conversations(spark):
    rows = [(c, 1, "user", "alone") for c in range(1, 19)]
    got = found(spark, rows, every=20)
    assert got == plain(rows, 20)
    assert any(d == 0 and sha != hashlib.sha256().hexdigest() for _, d, *_, sha in got)


def test_empty_table(spark):
    assert found(spark, []) == found(spark, [], every=20) == Counter()


def test_long_conversations(spark):
    long = [("user", f"turn {i}") for i in range(2600)]
    rows = [(c, t, *x) for c, v in {7: long, 3: long, 9: long[:1024], 8: long[:2048] + [("user", "other")], 5: long[:1500]}.items()
            for t, x in enumerate(v)]
    rows += [(4, t, "user", f"else {t}") for t in range(3000)]
    # The plain version holds every prefix; this one compares counts by depth instead.
    got = found(spark, rows, parts=3)
    by = {(c, d): (p, n, k, l, s) for c, d, p, n, k, l, s, _ in got}
    assert len(got) == len(by) == 1 + 2600 + 1 + 3000
    assert by[3, 0] == (None, 6, 2, 3, 2 * (4 * 1024 + 3 * 476 + 2 * 548 + 552))
    assert by[3, 1024] == (3, 5, 1, 2, 2 * (4 + 3 * 476 + 2 * 548 + 552))
    assert by[3, 2048][:4] == (3, 3, 2, 2)
    assert by[8, 2049] == (3, 1, 0, 1, 0) and by[3, 2600] == (3, 2, 0, 1, 2)
    assert by[4, 1025] == (4, 1, 1, 1, 0) and by[4, 3000] == (4, 1, 0, 1, 0)
