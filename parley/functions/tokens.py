"""Search terms of a text: lower case, accents stripped, runs of a-z, without stop words."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_map() -> tuple[str, str]:
    """Letters with canonical accents and their base letters; combining marks map to nothing."""
    accented, plain = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code):
            accented.append(chr(code))
            plain.append(base)
    marks = [chr(code) for code in range(0x0300, 0x0370)]
    return "".join(accented + marks), "".join(plain)


ACCENTED, PLAIN = _accent_map()


def english_stop_words() -> list[str]:
    """Spark's English list; needs a running session."""
    return StopWordsRemover.loadDefaultStopWords("english")


def normalize(c: Column) -> Column:
    """Lower case without accents; pure ASCII text skips the character map."""
    lowered = F.lower(c)
    ascii_only = F.octet_length(c) == F.length(c)
    return F.when(ascii_only, lowered).otherwise(F.translate(lowered, ACCENTED, PLAIN))


def split_tokens(c: Column) -> Column:
    """Runs of a-z in order, stop words included; the ends may give ''."""
    return F.split(normalize(c), "[^a-z]+")


def is_token(t: Column, stop_words: Iterable[str] = ()) -> Column:
    stop = sorted(plain_words(stop_words))
    return (t != "") & ~t.isin(stop) if stop else t != ""


def tokens(c: Column, stop_words: Iterable[str] = ()) -> Column:
    """Array of the search terms of a text, in order."""
    return F.filter(split_tokens(c), lambda t: is_token(t, stop_words))


def plain(text: str) -> str:
    """``normalize`` for a string at hand."""
    pairs = str.maketrans(ACCENTED, PLAIN.ljust(len(ACCENTED), "\0"))
    return text.lower().translate(pairs).replace("\0", "")


def plain_words(words: Iterable[str]) -> set[str]:
    """Words as they appear among the tokens; what cannot be a token is left out."""
    return {w for w in map(plain, words) if re.fullmatch("[a-z]+", w)}


def query_terms(query: str, stop_words: Iterable[str] = ()) -> list[str]:
    """Distinct search terms of a short query string, by the same rule."""
    stop = plain_words(stop_words)
    return sorted({t for t in re.findall("[a-z]+", plain(query)) if t not in stop})
