"""Search for short license notices with a bounded number of errors.

A notice found with at most k errors holds at least one of any k + 1 pieces of its phrase
unchanged. So an automaton over all pieces of all notices runs through the text once, each piece
found names the small part of the text where its notice could stand, and the regex library's
bounded-error matching decides there. Notices with no errors allowed are one piece: the phrase.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.arrow import small_batches

# Label, phrase in lower-case words, errors allowed.
NOTICES = (
    ("mit", "mit license", 0),
    ("apache", "apache license", 0),
    ("gpl", "general public license", 0),
    ("mit", "released under the mit license", 3),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    ("apache", "licensed under the apache license", 3),
    ("gpl", "licensed under the gnu general public license", 4),
    ("lgpl", "gnu lesser general public license", 3),
    ("bsd", "redistribution and use in source and binary forms", 4),
    ("mpl", "mozilla public license", 2),
    ("cc", "licensed under cc by", 1),
    ("cc", "creative commons attribution", 2),
    ("unlicense", "this is free and unencumbered software released into the public domain", 6),
    ("proprietary", "all rights reserved", 1),
)

# A-Z to a-z, all other ASCII but 0-9 and a-z to a space; bytes of other characters stay.
_SPACED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

RESULT = (
    "struct<n_words:bigint,spans:array<struct<label:string,notice:int,first:bigint,last:bigint,"
    "errors:int,score:double>>>"
)


def pieces(phrase: str, errors: int) -> list[tuple[int, str]]:
    """The phrase between spaces, cut into ``errors`` + 1 pieces of like size, with their places."""
    whole = f" {phrase} "
    cuts = [i * len(whole) // (errors + 1) for i in range(errors + 2)]
    return [(a, whole[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=4)
def _compiled(notices: tuple):
    seeds: dict[str, list[tuple[int, int]]] = {}
    for n, (_, phrase, errors) in enumerate(notices):
        for at, piece in pieces(phrase, errors):
            seeds.setdefault(piece, []).append((n, at))
    automaton = ahocorasick.Automaton()
    for piece, places in seeds.items():
        automaton.add_word(piece, (len(piece), tuple(places)))
    automaton.make_automaton()
    patterns = [
        regex.compile(rf"(?b)(?: {regex.escape(phrase, literal_spaces=True)} ){{e<={errors}}}")
        for _, phrase, errors in notices
    ]
    return automaton, patterns


def _matches(pattern, normal: str, low: int, high: int, least: int) -> Iterator[tuple[int, int, int]]:
    """The best match between two places, then those in what is left on both sides of it, as errors
    and bounds without the spaces around."""
    open_ = [(low, high)]
    while open_:
        low, high = open_.pop()
        m = pattern.search(normal, low, high) if high - low >= least else None
        if m is None or m.start() == m.end():
            continue
        a, b = m.span()
        # Words that only touch the match with a space are not part of it.
        yield sum(m.fuzzy_counts), a + (normal[a] == " "), b - (normal[b - 1] == " ")
        open_ += [(low, min(a + 1, high - 1)), (max(b - 1, low + 1), high)]


def _apart(matches: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Matches that do not overlap, those with fewer errors first, then the earlier ones."""
    kept: list[tuple[int, int, int]] = []
    for errors in sorted({e for e, _, _ in matches}):
        new, i, end = [], 0, 0
        for a, b in sorted((a, b) for e, a, b in matches if e == errors):
            while i < len(kept) and kept[i][1] <= a:
                i += 1
            if a >= end and (i == len(kept) or b <= kept[i][0]):
                new.append((a, b, errors))
                end = b
        kept = sorted(kept + new)
    return kept


def _found(normal: str, notices: tuple) -> Iterator[tuple[int, int, int, int]]:
    """Bounds, notice and errors of all notices. Each seed's own surroundings are searched."""
    automaton, patterns = _compiled(notices)
    inexact: dict[int, set[tuple[int, int, int]]] = {}
    sure: dict[int, int] = {}  # where the last match without errors ends
    for end, (size, places) in automaton.iter(normal):
        start = end + 1 - size
        for n, at in places:
            _, phrase, errors = notices[n]
            if not errors:
                yield start + 1, end, n, 0
                continue
            if end <= sure.get(n, 0):
                continue
            low = max(0, start - at - errors)
            high = min(start - at + len(phrase) + 2 + errors, len(normal))
            for found in _matches(patterns[n], normal, low, high, len(phrase) + 2 - errors):
                inexact.setdefault(n, set()).add(found)
                if not found[0] and found[1] <= start + 1:
                    sure[n] = max(found[2], sure.get(n, 0))
    for n, matches in inexact.items():
        yield from ((a, b, n, errors) for a, b, errors in _apart(matches))


def scan(text: bytes, notices: tuple = NOTICES) -> dict:
    """Number of words of a text and the notices in it, by first word."""
    words = text.translate(_SPACED).split()
    found: dict = {"n_words": len(words), "spans": []}
    if not words:
        return found
    normal = f" {b' '.join(words).decode('utf-8', 'replace')} "
    before, at = 0, 1  # words before the place
    for a, b, n, errors in sorted(_found(normal, notices)):
        before, at = before + normal.count(" ", at, a), a
        found["spans"].append(
            {"label": notices[n][0], "notice": n, "first": before, "last": before + normal.count(" ", a, b),
             "errors": errors, "score": max(0.0, 1 - errors / len(notices[n][1]))}
        )
    return found


def find_notices(docs: DataFrame, text: str = "text", notices: tuple = NOTICES) -> DataFrame:
    """All rows of ``docs`` plus ``notices`` (replacing a column of that name): the number of
    words, and for each notice found its label, number in the list, first and last word (from 0),
    errors and score (1 less errors by length of the phrase).

    Words are runs of digits, letters a-z and non-ASCII characters after lower-casing A-Z. A notice
    starts and ends at a word boundary, give or take its errors. Places of notices without errors
    are all reported, overlapping ones too; of one with errors, the best match around each seed, and
    of these the ones that do not overlap, fewest errors first, then the earlier. NULL and empty
    texts have no words and no notices. Rows are searched one by one, in whole. Only as many
    characters as a notice has are searched around a seed, so the time grows in proportion to the
    text, however often a notice is nearly met.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf(RESULT)
    def found(texts: pa.Array) -> pa.Array:
        out = [scan(t.as_buffer().to_pybytes() if t.is_valid else b"", notices) for t in texts]
        return pa.array(out, type=_ARROW)

    return docs.drop("notices").withColumn("notices", found(F.col(text)))


_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [("label", pa.string()), ("notice", pa.int32()), ("first", pa.int64()),
                     ("last", pa.int64()), ("errors", pa.int32()), ("score", pa.float64())]
                )
            ),
        ),
    ]
)
