"""Each operator against a plain version, on a table of odd texts."""

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.llm import (
    chat,
    decontaminate,
    licenses,
    maxent,
    ordered_minhash,
    packing,
    quality,
    substrings,
    suffixes,
    urls,
)
from parley.llm.registry import END_ID, tokenizer_path
from parley.llm.words import sliding_min, word_chunks
from tests.llm import brute
from tests.llm.conftest import prose


# ---- words ----


def test_words_and_their_hashes(corpus):
    texts = [t for _, t in corpus]
    chunks = list(word_chunks(pa.array(texts), chunk_bytes=500))
    hashes = np.concatenate([c.hashes for c in chunks])
    words = [w for t in texts for w in brute.words(t)]
    assert len(hashes) == len(words)
    seen = {}
    for w, h in zip(words, hashes.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_sliding_minimum():
    v = np.random.default_rng(0).integers(0, 50, 200)
    for width in (1, 2, 7, 64, 200):
        assert sliding_min(v, width).tolist() == [v[i : i + width].min() for i in range(200 - width + 1)]
    assert len(sliding_min(v, 201)) == 0


# ---- 1 ----

PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]


def test_exact_notices(spark):
    rng = random.Random(5)
    pieces = ["MIT", "license", "Apache", "General", "PUBLIC", "license", "mit\nlicense", "é", "x9", "gnu"]
    rows = [(i, "".join(rng.choice(pieces) + rng.choice([" ", "-", "\n", "  ", ""]) for _ in range(30))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "mit license"), (63, "MITlicense"), (64, "mit license mit license")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.notices for r in licenses.find_notices(docs).collect()}
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(t))
        want = sorted(
            (k, label) for label, p in PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()
        )
        exact = [s for s in out[i].spans if not licenses.NOTICES[s.notice][2]]
        assert out[i].n_words == len(w)
        assert sorted((s.first, s.label) for s in exact) == want


def test_notices_with_errors():
    found = licenses.scan(b"Text. Relesed under teh MIT-License, as it is. Mozila Public Licence")
    assert {s["label"]: s["errors"] for s in found["spans"]} == {"mit": 0, "mpl": 2} | {"mit": 0}
    fuzzy = [s for s in found["spans"] if s["errors"]]
    assert any(s["label"] == "mit" and s["first"] == 1 for s in fuzzy)
    assert licenses.scan(b"nothing to see here")["spans"] == []


def test_every_error_within_the_bound_is_found():
    rng = random.Random(1)
    for n, (_, phrase, errors) in enumerate(licenses.NOTICES):
        for _ in range(15 if errors else 0):
            text = list(phrase)
            for _ in range(errors):
                text[rng.randrange(1, len(text) - 1)] = rng.choice("abcxyz")
            found = licenses.scan(f"some words {''.join(text)} and more".encode())
            assert n in {s["notice"] for s in found["spans"]}


def test_no_notice_of_many_is_lost():
    for phrase in ("all rights reserved", "all rights reservd", "mozilla public license", "mozila public licence"):
        for between in (" ", ". ", " and so on "):
            found = licenses.scan((between.join([phrase] * 1000)).encode())["spans"]
            assert len(found) == 1000
            width = len((phrase + between).replace(".", "").split())
            assert [s["first"] for s in found] == list(range(0, 1000 * width, width))


def test_matches_do_not_overlap_and_equal_a_plain_search():
    notices = (("x", "ab cd ef gh", 2),)
    rng = random.Random(3)
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            copy = list("ab cd ef gh")
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice("xyz")
            parts.append("".join(copy) + rng.choice(["", " far away"]))
        text = " ".join(parts)
        got = [(s["first"], s["errors"]) for s in licenses.scan(text.encode(), notices)["spans"]]
        place = 0
        for part in parts:  # as long as only letters are exchanged, each copy is found at its place
            wrong = sum(x != y for x, y in zip(part, "ab cd ef gh", strict=False))
            if wrong <= 2:
                assert any(e <= wrong and abs(first - place) <= 1 for first, e in got), (text, got)
            place += len(part.split())
        spans = licenses.scan(text.encode(), notices)["spans"]
        assert len({s["first"] for s in spans}) == len(spans)


def test_near_misses_take_time_in_proportion():
    began = time.process_time()
    found = licenses.scan(b"all rights reservd " * 25_000)["spans"]
    found += licenses.scan(b"all rights resrvd " * 25_000)["spans"]
    assert len(found) == 25_000
    assert time.process_time() - began < 20


# ---- 2 ----


def test_quality_measures(documents, corpus):
    out = {r.doc_id: r.quality for r in quality.assess(documents).collect()}
    for i, t in corpus:
        w, q = brute.words(t), out[i]
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        covered = {k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(5)} if len(w) < 700 else None
        lines = [x for x in (t or "").split("\n") if brute.words(x)]
        assert (q.n_words, q.word_chars, q.n_dup_lines) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)))
        if covered is not None:
            assert q.n_repeat_words == len(covered)
            assert q.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_lines_that_fail_go(spark):
    good = "This is a plain line of ordinary prose, long enough to be kept as it is."
    more = "Another line says something else, with words of its own and a full stop."
    bad = "one | two | three | four"
    docs = spark.createDataFrame(
        [(1, f"{good}\n{bad}\n{more}", 7), (2, f"{bad}\n{bad}.\n{good}", 8), (3, None, 9), (4, f"{good}\n\nAll rights reserved.", 1)],
        "doc_id long, text string, quality int",
    )
    out = {r.doc_id: r for r in quality.clean(docs).collect()}
    assert out[1].text == f"{good}\n{more}" and out[1].quality == 7
    assert out[4].text == f"{good}\n"
    assert 3 not in out


# ---- 3 ----


def _cheapest(roles):
    best = None

    def walk(i, state, cost, turns):
        nonlocal best
        if i == len(roles):
            if state != chat.FINAL:
                cost += chat.INSERT * (1 + len(chat.PATHS[state, chat.FINAL]))
            best = min(best or (cost, turns), (cost, turns))
            return
        if state:
            walk(i + 1, state, cost + chat.MERGE + chat.RELABEL * (roles[i] != state), turns)
        insert(i, state, cost, turns, 0)

    def insert(i, state, cost, turns, empty):
        for s in chat.NEXT[state]:
            walk(i + 1, s, cost + chat.RELABEL * (roles[i] != s), turns + 1)
            if empty < 2:
                insert(i, s, cost + chat.INSERT, turns + 1, empty + 1)

    walk(0, 0, 0, 0)
    return best


def _repair(roles, cuts):
    parts = [p for p in np.split(np.array(roles), cuts) if len(p)]
    states, turns = chat.states_at_cuts([chat.segment_matrix(list(p)) for p in parts])
    out = []
    for i, p in enumerate(parts):
        out += chat.resolve([int(x) for x in p], states[i], states[i + 1], turns[i], i == len(parts) - 1)
    return out


def test_repair_is_the_cheapest():
    rng = random.Random(2)
    for _ in range(150):
        roles = [rng.randrange(4) for _ in range(rng.randrange(1, 6))]
        out = _repair(roles, sorted(rng.sample(range(len(roles)), rng.randrange(0, len(roles)))))
        empty = sum(len(d["before"]) + len(d["after"]) for d in out)
        cost = chat.INSERT * empty + sum(
            chat.MERGE * (d["action"] == "merge") + chat.RELABEL * (r == 0 or chat.ROLES[r - 1] != d["role"])
            for r, d in zip(roles, out, strict=True)
        )
        turns = sum(d["action"] != "merge" for d in out) + sum(len(d["before"]) for d in out)
        assert (cost, turns) == _cheapest(roles)


def test_costs_of_many_segments():
    # Same-role turns in segments of 2**16: 2**21 merges in all, more than a cost can hold in one number.
    same = [chat.segment_matrix([3])]
    for _ in range(16):
        same.append(chat.product(same[-1], same[-1]))
    states, turns = chat.states_at_cuts([chat.segment_matrix([2, 3]), *[same[-1]] * 32, chat.segment_matrix([2, 3, 2])])
    assert states == [0] + [3] * 33 + [2]
    assert turns == [0] + [2] * 33 + [5]


def test_repaired_conversations_are_legal(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT_ROWS", 3)
    rng = random.Random(4)
    rows = [
        (rng.choice([None, 1, 2, 3, 4]), rng.choice([None, *range(9)]), rng.choice(["user", "Assistant", "system", "bot", None, " user "]),
         rng.choice([None, "", "hello", "text"]), 5)
        for _ in range(150)
    ]
    rows += [(9, 1, "user", "same", 5)] * 40
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position int")
    out = chat.repair(turns).toPandas().sort_values(["conv_id", "position", "piece"])
    assert (out.action != "insert").sum() == len(rows)
    for _, x in out.groupby("conv_id", dropna=False):
        starts = x[x.action != "merge"]
        assert list(starts.position) == list(range(len(starts)))
        state = 0
        for r in starts.role:
            assert chat.ROLES.index(r) + 1 in chat.NEXT[state]
            state = chat.ROLES.index(r) + 1
        assert state == chat.FINAL
        text = "".join(x.rendered)
        assert len(re.findall(r"<\|im_start\|>(?:system|user|assistant)\n.*?<\|im_end\|>\n", text, re.S)) == len(starts)
        assert text.endswith("<|im_end|>\n")


def test_known_repairs(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "user", "q")]
    out = chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    text = {}
    for r in out.orderBy("conv_id", "position", "piece").collect():
        text[r.conv_id] = text.get(r.conv_id, "") + r.rendered
    assert text[1] == "<|im_start|>user\na\n\nb<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
    assert text[2] == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"


# ---- 4 ----


def test_alignment_in_the_band():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.sample(range(60), rng.randrange(1, 40))
        b = [x for x in a if rng.random() < 0.93]
        for _ in range(rng.randrange(0, 4)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(100, 200))
        if not b:
            continue
        m = brute.lcs(a, b)
        share = m / (len(a) + len(b) - m)
        got = ordered_minhash.similarity(np.array(a, np.uint64), np.array(b, np.uint64), 0.6)
        assert got == pytest.approx(share if share >= 0.6 else 0)


def test_near_duplicates(documents, corpus):
    got = {r.doc_id: r.class_id for r in ordered_minhash.near_duplicates(documents).collect()}
    assert got == brute.near_duplicate_classes(corpus)


def test_repetitions_count(spark):
    rng = random.Random(12)
    rows = []
    for i in range(0, 40, 4):
        words = [f"p{i}q{rng.randrange(10**6)}" for _ in range(60)]
        once, many = " ".join(words), " ".join(words * 100)
        rows += [(i, once), (i + 1, many), (i + 2, " ".join(words * 99)), (i + 3, once + " end")]
    out = ordered_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in out} == {i: i // 4 * 4 + (i % 4 in (1, 2)) for i, _ in rows}


def test_rows_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(13)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[1]), (6, texts[2]), (6, texts[0] + " x"), (7, texts[3]), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, ordered_minhash.near_duplicates(docs).collect()))
    assert got == [(5, 5), (5, 5), (5, 5), (6, 5), (6, 6), (7, 7), (7, 7)]
    kept = [r.text for r in ordered_minhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([*texts[:4], None], key=str)


def test_near_copies_are_found(spark):
    """Scattered edits of one word and moved blocks; the pairs at 0.8 or more by the plain rule."""
    rng = random.Random(14)
    rows, wanted = [], {}
    for i in range(0, 400, 2):
        words = [f"v{rng.randrange(10**5)}" for _ in range(rng.randrange(80, 300))]
        near = list(words)
        for at in rng.sample(range(len(near)), len(near) // 50):
            near[at] = "edited"
        if i % 4:
            near = near[30:] + near[:30] if len(near) > 240 else near
        rows += [(i, " ".join(words)), (i + 1, " ".join(near))]
        x, y = brute.shingles(rows[-2][1]), brute.shingles(rows[-1][1])
        m = brute.lcs(x, y)
        wanted[i + 1] = i if m >= 0.8 * (len(x) + len(y) - m) else i + 1
    out = ordered_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: r.class_id for r in out if r.doc_id % 2}
    linked = [k for k, v in wanted.items() if v != k]
    assert len(linked) > 100 and sum(got[k] == wanted[k] for k in linked) >= 0.99 * len(linked)
    assert all(got[k] == k for k in wanted if wanted[k] == k)


def test_one_of_each_class_stays(documents, corpus):
    kept = sorted(r.doc_id for r in ordered_minhash.keep_one(documents).collect())
    assert kept == sorted(set(brute.near_duplicate_classes(corpus).values()))


# ---- 5 ----


def test_containment(spark, documents, corpus):
    rng = random.Random(3)
    items = []
    for n in range(30):
        w = brute.words(rng.choice(corpus)[1])
        k = rng.randrange(5, 60)
        a = rng.randrange(max(1, len(w) - k + 1))
        part = w[a : a + k]
        if part and rng.random() < 0.4:
            part[rng.randrange(len(part))] = "other"
        items.append((n, " ".join(part).upper()))
    items += [(90, None), (91, ""), (None, "some words that nobody has written here"), (92, "too short"), (0, items[0][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 300):
        out = decontaminate.find_items(documents, table, block_bytes=block).collect()
        got = {r.doc_id: sorted((x.item, x.containment) for x in r.items) for r in out}
        for i, t in corpus:
            own = decontaminate.shingles_of((t or "").encode())
            want = []
            for n, s in items:
                wanted = decontaminate.shingles_of((s or "").encode())
                if n is not None and wanted and len(wanted & own) >= 0.8 * len(wanted):
                    want.append((n, len(wanted & own) / len(wanted)))
            assert got[i] == sorted(want)


# ---- 6 ----


def test_unigram_scores(documents, corpus, monkeypatch):
    for frequent in (1 << 18, 50):
        monkeypatch.setattr(maxent, "FREQUENT", frequent)
        out = maxent.score_texts(documents).collect()
        want = brute.unigram_scores(corpus)
        for r in out:
            held, n, known, total, score = want[r.doc_id]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
            assert r.base_score == pytest.approx(score)
            assert r.score < 0


def test_probabilities_add_up(monkeypatch):
    monkeypatch.setattr(maxent, "SHORT", 64)
    monkeypatch.setattr(maxent, "CLASSES", 2)
    monkeypatch.setattr(maxent.Model, "shapes", ((4, 2048, 3), (2, 512, 32), (3,), (2, 32)))
    rng = np.random.default_rng(0)
    hashes = np.sort(rng.integers(0, 1 << 63, 100).astype(np.uint64))
    counts = np.sort(rng.integers(1, 500, 100))[::-1].copy()
    words = maxent.Lexicon(hashes, counts, np.arange(100), int(counts.sum()) + 40, 130)
    model = maxent.Model.unigram(words)
    model.outer += rng.normal(size=model.outer.shape).astype(np.float32)
    model.inner += rng.normal(size=model.inner.shape).astype(np.float32)
    one = maxent.Events(np.arange(-1, 64), [np.full(65, 9)] * 4, [np.full(65, 3)] * 2)
    p = 10 ** maxent.log_probability(model, one)
    assert p.sum() == pytest.approx(1, abs=1e-4)


def _many_tokens():
    """1,024 tokens of the short list, 100 others with counts, and 60 more in four hashed classes."""
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 1184).astype(np.uint64))
    rng.shuffle(hashes)
    counts = np.sort(rng.integers(2, 500, 1124))[::-1].copy()
    frequent, tail = hashes[:1124], hashes[1124:]
    at = np.argsort(frequent)
    sizes = np.bincount((tail >> np.uint64(20)).astype(int) & 3, minlength=4)
    words = maxent.Lexicon(frequent[at], counts[at], at, int(counts.sum()) + 60, 1184, sizes, sizes)
    return words, frequent, tail


def test_context_tells_rare_tokens_apart():
    words, frequent, tail = _many_tokens()
    pairs = [*zip(frequent[:80], frequent[1030:1110], strict=True), *zip(frequent[80:84], tail[:4], strict=True)]
    text = np.array([t for _ in range(60) for pair in pairs for t in pair], dtype=np.uint64)

    def seen(tokens):
        return maxent.events(tokens, np.array([0, len(tokens)]), words.find(tokens), words)

    trainer = maxent.Trainer(maxent.Model.unigram(words))
    trainer.learn(seen(text))
    right = maxent.log_probability(trainer.model, seen(text[:160]))[1::2]
    swapped = text[:160].copy()
    swapped[1::2] = np.roll(swapped[1::2], 2)
    wrong = maxent.log_probability(trainer.model, seen(swapped))[1::2]
    assert (right > wrong + 0.3).mean() > 0.9


def test_probabilities_of_all_tokens_add_up():
    words, frequent, tail = _many_tokens()
    rng = np.random.default_rng(2)
    model = maxent.Model.unigram(words)
    for w in (model.outer, model.inner, model.branches):
        w += rng.normal(size=w.shape).astype(np.float32)
    unknown = np.arange(4, dtype=np.uint64) << np.uint64(20)
    tokens = np.concatenate([frequent, tail, unknown])
    texts = np.stack([np.full(len(tokens), frequent[5]), tokens], axis=1).ravel()
    e = maxent.events(texts, np.arange(0, len(texts) + 1, 2), words.find(texts), words)
    p = 10 ** maxent.log_probability(model, e)[1::2]
    shares = np.concatenate([np.ones(1124), np.full(60, 1 + maxent.SMOOTHING), np.full(4, maxent.SMOOTHING)])
    scales = np.where(np.arange(len(tokens)) < 1124, 1, words.tail_scales[words.tail_class(tokens)])
    assert (p * shares / scales).sum() == pytest.approx(1, abs=1e-3)


def test_buckets_grow_with_the_vocabulary():
    sizes = []
    for distinct in (1000, 10**6, 10**7, 10**9):
        n = np.zeros(0, np.int64)
        words = maxent.Lexicon(n.view(np.uint64), n, n, 10**9, distinct)
        sizes.append((words.buckets, words.inner_buckets, words.tree_buckets, maxent.tail_classes(distinct)))
    assert sizes[0] == (maxent.BUCKETS, maxent.INNER_BUCKETS, maxent.TREE_BUCKETS, 1)
    assert all(a <= b for x, y in zip(sizes, sizes[1:]) for a, b in zip(x, y)) and len(set(sizes)) == 4


def test_context_helps(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        w, at = [], rng.randrange(40)
        for _ in range(60):
            at = (at * 7 + rng.randrange(2)) % 40
            w.append(f"t{at}")
        rows.append((i, " ".join(w)))
    out = maxent.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out")
    r = out.agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
    assert r.s > 0.85 * r.b


# ---- 7 ----


def test_seed_extend(documents, corpus):
    out = substrings.remove_repeats(documents).withColumn("sha", F.sha2("repeats.kept", 256)).collect()
    got = {r.doc_id: (r.repeats.n_words, r.repeats.n_removed, r.sha) for r in out}
    assert got == brute.seed_extend(corpus)
    assert all(sum(s.last - s.first + 1 for s in r.repeats.spans) == r.repeats.n_removed for r in out)


# ---- 8 ----


def test_tokens_are_those_of_the_tokenizer(corpus):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    odd = ["Don't, e.g. STOP. It's 3.5% <|endoftext|>x y<|ENDOFTEXT|>", "J\u030c e\u0301, A\u0300.", "İstanbul ΣΑΣ ß", "a.\nb,\tc. \x0bd\x1ce\xa0f\u2028g"]
    texts = [t or "" for _, t in corpus] + odd
    own = packing.WordIds(path, limit=50)
    got = [np.frombuffer(x, "<u4").tolist() for i in range(0, len(texts), 7) for x in own.ids([t.encode() for t in texts[i : i + 7]])]
    assert got == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_hilbert_keys_are_a_walk():
    bits, dims = 3, 3
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
    keys = packing.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packing(documents, corpus):
    from tokenizers import Tokenizer

    pieces = packing.pack(documents, tokenizer_path(), END_ID, length=64).collect()
    encoded = Tokenizer.from_file(tokenizer_path()).encode_batch([t or "" for _, t in corpus], add_special_tokens=False)
    want = {i: [*e.ids, END_ID] for (i, _), e in zip(corpus, encoded, strict=True)}
    sequences, parts = {}, {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        own = sequences.setdefault(p.sequence_id, [])
        assert p.offset == len(own) and p.doc_tokens == len(want[p.doc_id])
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        own += ids
        parts.setdefault(p.doc_id, []).append((p.start, ids))
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(len(s) == 64 for i, s in sequences.items() if i < len(sequences) - 1)
    for i, ids in want.items():
        assert [x for _, part in sorted(parts[i]) for x in part] == ids
    assert zlib.crc32(b"") == 0


# ---- 9 ----


def test_url_rules(spark):
    rng = random.Random(8)
    hosts = ["a.org", "b.a.org", "org", "xorg", "example.org", "www.example.org", "EXAMPLE.org", "a.com", "", "com.", ".org"]
    paths = ["", "/", "/en", "/en/1", "/en/12/x", "/es/", "/es", "/ES/1", "/de/", "/fr/x", "/é/1"]
    pages = [(i, f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/es/', '#x', '?a://b/'])}") for i in range(300)]
    pages += [(300, None), (301, ""), (302, "example.org/es/"), (303, "http:/x"), (None, "http://a.org/"), (1, pages[1][1])]
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("block", "com", ""),
             ("allow", "a.com", "/"), ("allow", "a.org", "/en"), ("block", "org", "/é/"), ("allow", "org", "/"), (None, "x", "y")]
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    df = spark.createDataFrame([(i, u, "kept") for i, u in pages], "page_id long, url string, rule string")
    out = urls.judge(df, table).collect()
    assert len(out) == len(pages)

    def want(u):
        m = re.search("://([^/?#]*)([^?#]*)", u or "")
        host, path = (brute.lower(m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
                if v and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fits)[3] if fits else None, max(fits)[4] if fits else "allow")

    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in out)
    assert got == sorted((str(i), *(str(x) for x in want(u))) for i, u in pages)


# ---- 10 ----


@pytest.mark.parametrize("length", [8, 24, 40])
def test_interval_expansion(length):
    rng = random.Random(length)
    base = bytes(rng.choices(b"ab", k=300))
    for _ in range(40):
        contexts = []
        for _ in range(rng.randrange(1, 10)):
            a = rng.randrange(200)
            x = bytearray(base[a : a + length + rng.randrange(25)])
            if rng.random() < 0.5:
                x[rng.randrange(len(x))] = rng.choice([0, 99, 255])
            contexts.append(bytes(x))
        counts = np.array([rng.choice([1, 1, 2]) for _ in contexts])
        seen = {}
        for c, n in zip(contexts, counts, strict=True):
            for i in range(len(c) - length + 1):
                seen[c[i : i + length]] = seen.get(c[i : i + length], 0) + n
        for c, flags in zip(contexts, suffixes.repeated_windows(contexts, counts, length), strict=True):
            assert flags.tolist() == [seen[c[i : i + length]] > 1 for i in range(len(c) - length + 1)]


@pytest.mark.parametrize("hot", [1 << 21, 2000])
def test_repeated_bytes(documents, corpus, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_BYTES", hot)
    out = {r.doc_id: r.repeats for r in suffixes.remove_repeats(documents).collect()}
    for (i, _), want in zip(corpus, brute.repeated_bytes([t for _, t in corpus]), strict=True):
        r = out[i]
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want


def test_bytes_of_rows_that_share_an_id(spark):
    rng = random.Random(3)
    passage = prose(rng, 150)
    rows = []
    for i in [None, None, None, 7, 7, -5]:
        rows.append((i, f"{prose(rng, rng.randrange(80, 300))} {passage} {prose(rng, rng.randrange(0, 90))}"))
    rows += [(None, passage), (7, prose(rng, 100)), (None, None), (7, "")]
    out = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    got = sorted((str(r.doc_id), r.text or "", r.repeats.n_removed, bytes(r.repeats.kept)) for r in out)
    want = brute.repeated_bytes([t for _, t in rows])
    assert got == sorted((str(i), t or "", w[1], w[3]) for (i, t), w in zip(rows, want, strict=True))
    assert sum(w[1] > 0 for w in want) == 7


def test_sections_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SECTION", 3000)
    text = prose(random.Random(9), 3000)
    rows = [(1, text + text[500:2500]), (2, text[4000:9000]), (3, "short")]
    out = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    for r, want in zip(out, brute.repeated_bytes([t for _, t in rows]), strict=True):
        assert (r.repeats.n_bytes, r.repeats.n_removed, len(r.repeats.spans), bytes(r.repeats.kept)) == want


def test_pieces_follow_the_turns_beyond_many_conversations(spark):
    """A long conversation across partitions, among more short ones than a segment has turns."""
    import pyspark.sql.functions as F

    short = spark.range(280_000).select(F.when(F.col("id") < 140_000, F.col("id")).otherwise(F.col("id") + 1000).alias("conv_id"), F.lit(0).cast("long").alias("turn"))
    long = spark.range(120_000).select(F.lit(140_500).cast("long").alias("conv_id"), F.col("id").alias("turn"))
    turns = short.union(long).select("*", F.lit("user").alias("role"), F.lit("x").alias("text"))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = chat.repair(turns).filter("conv_id = 140500 and action <> 'insert'").select("position", "piece", "turn")
        rows = sorted(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert [r[2] for r in rows] == list(range(120_000))
    assert [r[1] for r in rows] == [-1, *range(1, 120_000)]


def test_windows_longer_than_512_bytes():
    rng = random.Random(8)
    for _ in range(10):
        base = bytes(rng.choice(b"ab") for _ in range(1400))
        other = base[:700] + b"z" + base[701:]
        texts = [base, other, b"q" + base[:950], base[300:1300]]
        got = suffixes.repeated_windows(texts, np.ones(4, dtype=np.int64), 900)
        every = Counter(t[i : i + 900] for t in texts for i in range(len(t) - 899))
        assert [list(f) for f in got] == [[every[t[i : i + 900]] > 1 for i in range(len(t) - 899)] for t in texts]
