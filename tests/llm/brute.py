"""Plain versions of what the operators compute, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = "[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(WORD, text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def classes(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def shingles(text, k=5):
    w = words(lower(text))
    if len(w) < k:
        return [tuple(w)] if w else []
    seen, out = Counter(), []
    for i in range(len(w) - k + 1):
        seen[tuple(w[i : i + k])] += 1
        out.append((*w[i : i + k], seen[tuple(w[i : i + k])]))
    return out


def near_duplicate_classes(docs, least=0.8):
    """docs: (id, text) with distinct ids."""
    seqs = {i: shingles(t) for i, t in docs}
    ids = sorted(seqs)
    links = []
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = seqs[a], seqs[b]
            if words(lower(dict(docs)[a])) == words(lower(dict(docs)[b])):
                links.append((a, b))
            elif set(x) & set(y) and min(len(x), len(y)) >= least * max(len(x), len(y)):
                m = lcs(x, y)
                if m >= least * (len(x) + len(y) - m):
                    links.append((a, b))
    return classes(links, ids)


def seed_extend(docs, length=13):
    """{id: (n_words, n_removed, sha)} for distinct ids."""
    first = {}
    for i, t in sorted(docs):
        w = words(t)
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k : k + length]), i)
    out = {}
    for i, t in docs:
        w, gone = words(t), set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < i:
                gone.update(range(k, k + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def repeated_bytes(texts, length=400):
    """[(n_bytes, n_removed, n_spans, kept)] for a list of texts."""
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def unigram_scores(docs):
    """{id: (held_out, n_tokens, n_known, train_tokens, score)} for distinct ids."""
    tokens = {i: [*words(lower(t)), None] for i, t in docs}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in tokens}
    c = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    return {
        i: (held[i], len(t), sum(w in c for w in t), n,
            sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
        for i, t in tokens.items()
    }
