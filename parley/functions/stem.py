"""Porter's suffix stripping (M. F. Porter, "An algorithm for suffix stripping", 1980).

``porter_stem`` is for the few words of a query. ``stem`` does the same on a column, as a chain of
replacements in which each step sees the last one's result once, so nothing leaves the JVM. It is
meant for distinct vocabulary, or for the few tokens that could have a wanted stem. ``stem_texts`` is
for whole texts: a Python worker keeps the stems of the words it has met last.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that a Python worker keeps the stems of, some 50 MB.
KEPT = 1 << 18

# Suffix and replacement, as listed in the paper.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """'c' or 'v' per letter; y counts as a vowel after a consonant."""
    shape = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and shape[-1] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _ends_cvc(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest_suffix(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    if word.endswith(("sses", "ies")):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past_and_progressive(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest_suffix(word, ("ed", "ing"))
    if suffix is None or "v" not in _shape(word[: -len(suffix)]):
        return word
    base = word[: -len(suffix)]
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if _double_consonant(base) and base[-1] not in "lsz":
        return base[:-1]
    if _measure(base) == 1 and _ends_cvc(base):
        return base + "e"
    return base


def _replace(word: str, table) -> str:
    rules = dict(table)
    suffix = _longest_suffix(word, rules)
    if suffix and _measure(word[: -len(suffix)]) > 0:
        return word[: -len(suffix)] + rules[suffix]
    return word


def _drop(word: str) -> str:
    suffix = _longest_suffix(word, STEP_4)
    if suffix is None:
        return word
    base = word[: -len(suffix)]
    allowed = _measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t")))
    return base if allowed else word


def porter_stem(word: str) -> str:
    """Stem of one lower-case word."""
    if len(word) < 3:
        return word
    word = _past_and_progressive(_plural(word))
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _drop(_replace(_replace(word, STEP_2), STEP_3))
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _ends_cvc(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


# ---- the same as replacements ----

# A run of consonants and one of vowels: y is a vowel after a consonant. A y at the very start is
# written Y meanwhile, as it is none.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_ONE = f"(?:{_C})?{_V}[^aeiou]"  # a start of measure 1 or more
_TWO = f"(?:{_C})?{_V}{_C}{_V}"  # of measure 2 or more, if a consonant follows
_VOWEL = f"(?:{_C})?[aeiouy]"
_CVC = f"{_C}[aeiouy][^aeiouwxy]"


def _suffix_step(table) -> list[tuple[str, str]]:
    """The longest suffix is marked, kept as a candidate where the measure allows, and replaced."""
    suffixes = "|".join(s for s, _ in table)
    return [
        (f"({suffixes})$", "#$1"),
        (f"^({_ONE}.*)#", "$1%"),
        *((f"%{s}$", new) for s, new in table),
        ("#", ""),
    ]


def rewrites() -> list[tuple[str, str]]:
    """Patterns and replacements, in Java's syntax and without look-around or back references."""
    dropped = "|".join(s for s in STEP_4 if s != "ion")
    return [
        ("^y", "Y"),
        ("(ss|i)es$", "$1"),
        ("([^s])s$", "$1"),
        (f"^({_ONE}.*)eed$", "$1ee"),
        (f"^({_VOWEL}.*[^e]|(?:{_C})?[aiouy])ed$", "$1@"),
        (f"^({_VOWEL}.*)ing$", "$1@"),
        ("(at|bl|iz)@$", "$1e"),
        *((f"{c}{c}@$", c) for c in "bcdfghjkmnpqrtvwxY"),
        ("([^aeiouy])yy@$", "$1y"),
        (f"^({_CVC})@$", "$1e"),
        ("@", ""),
        (f"^({_VOWEL}.*)y$", "$1i"),
        *_suffix_step(STEP_2),
        *_suffix_step(STEP_3),
        (f"({'|'.join(STEP_4)})$", "#$1"),
        (f"^({_TWO}[^aeiou].*)#(?:{dropped})$", "$1"),
        (f"^({_TWO}(?:[st]|[^aeiou].*[st]))#ion$", "$1"),
        ("#", ""),
        (f"^({_TWO}[^aeiou].*)e$", "$1"),
        (f"^({_CVC})e$", "$1e!"),
        (f"^((?:{_C})?{_V}{_C}(?:{_V})?)e$", "$1"),
        ("!", ""),
        (f"^({_TWO}(?:l|[^aeiou].*l))l$", "$1"),
        ("Y", "y"),
    ]


def stem(word: Column) -> Column:
    """Stem of a column of lower-case words; words of one or two letters stay."""
    steps = reduce(lambda c, r: F.regexp_replace(c, F.lit(r[0]), F.lit(r[1])), rewrites(), word)
    return F.when(F.length(word) < 3, word).otherwise(steps)


_kept = lru_cache(KEPT)(porter_stem)


def _stem_texts(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: " ".join(map(_kept, t.split(" "))), na_action="ignore")


def stem_texts(text: Column) -> Column:
    """The stems of the words of a text, both joined by one space."""
    return F.pandas_udf(_stem_texts, "string")(text)
