"""Text expressions. All stay inside the JVM except the optional Python-syntax check."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Unicode whitespace plus the four ASCII separators U+001C..U+001F, as in Python's ``\s``.
SPACE = r"(?U)[\s\x1c-\x1f]+"
FENCE = "```"
# What counts as a code block.
FENCED_BLOCK = r"(?s)```(?:python)?\n*(.*?)\n*```"
UNCLOSED_BLOCK = r"(?sd)^(?:```(?:python)?)?\n?(.*?)\n?(?:```)?$"
FLAT_OBJECT = r"(?s)\{.*?\}"
# (?d): only a line feed ends a line, so '^' does not match after a carriage return.
LIST_LINE = r"(?md)^(\s*[-*]|\s*\d+\.) "


def strip_space(c: Column) -> Column:
    """Drop whitespace at both ends, tabs and line breaks included."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def clean_whitespace(c: Column) -> Column:
    """Every run of whitespace becomes one space, ends are trimmed, NULL becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, SPACE, " ")), F.lit(""))


def words(c: Column) -> Column:
    """Whitespace-separated words."""
    return F.filter(F.split(c, SPACE), lambda w: w != "")


def title_case(c: Column) -> Column:
    """Each run of letters starts upper case and goes on lower case: ``c/c++`` -> ``C/C++``."""
    runs = F.split(c, r"(?<=[^\p{L}])|(?=[^\p{L}])")
    return F.array_join(F.transform(runs, F.initcap), "")


def snippet(c: Column, length: int) -> Column:
    return F.substring(c, 1, length)


def one_line(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(" "))


def short_id(c: Column, length: int = 8) -> Column:
    return F.substring(c, 1, length)


def style_features(c: Column, w: Column) -> dict[str, Column]:
    """Five features of a text with words ``w``; ratios are 0 where there are no words."""
    n = F.size(w)
    return {
        "word_count": n,
        "lexical_diversity": F.when(n > 0, F.size(F.array_distinct(w)) / n).otherwise(F.lit(0.0)),
        "avg_word_len": F.when(n > 0, F.length(c) / n).otherwise(F.lit(0.0)),
        "has_code": F.contains(c, F.lit(FENCE)).cast("int"),
        "has_list": c.rlike(LIST_LINE).cast("int"),
    }


def code_blocks(c: Column) -> Column:
    """Contents of all fenced blocks; without any, the whole text less a stray fence."""
    blocks = F.regexp_extract_all(c, F.lit(FENCED_BLOCK), F.lit(1))
    return F.when(F.size(blocks) > 0, blocks).otherwise(
        F.array(F.regexp_extract(c, UNCLOSED_BLOCK, 1))
    )


def _compiles(source: str) -> bool:
    try:
        compile(source, "<block>", "exec")
    except (SyntaxError, ValueError):
        return False
    return True


@F.pandas_udf(ArrayType(StringType()))
def _keep_valid_python(blocks: pd.Series) -> pd.Series:
    return blocks.map(lambda bs: None if bs is None else [b for b in bs if _compiles(b)])


def extract_code(c: Column, valid_python_only: bool = False) -> Column:
    """All code of a text, blocks joined by a blank line.

    ``valid_python_only`` drops blocks that do not compile; only that option leaves the JVM.
    """
    blocks = code_blocks(c)
    if valid_python_only:
        blocks = _keep_valid_python(blocks)
    return F.array_join(blocks, "\n\n")


def text_before_code(c: Column) -> Column:
    """Text up to the first fence, '' if there is none."""
    return F.when(F.contains(c, F.lit(FENCE)), strip_space(F.substring_index(c, FENCE, 1))).otherwise(
        F.lit("")
    )


def json_objects(c: Column) -> Column:
    """Objects without nesting that parse, as an array of JSON texts."""
    found = F.regexp_extract_all(c, F.lit(FLAT_OBJECT), F.lit(0))
    return F.filter(found, lambda x: F.try_parse_json(x).isNotNull())


def trim_middle(c: Column, threshold: int = 5100, keep: int = 2500) -> Column:
    """Beyond ``threshold`` characters keep both ends and say how many were cut out."""
    cut = F.concat(
        F.substring(c, 1, keep),
        F.lit("\n ... ["),
        (F.length(c) - 2 * keep).cast("string"),
        F.lit(" characters truncated] ... \n"),
        F.right(c, F.lit(keep)),
    )
    return F.when(F.length(c) > threshold, cut).otherwise(c)


def clean_label(c: Column) -> Column:
    """First line of a labeler's answer without quotes and the ``Label:`` prefix."""
    first_line = F.split_part(strip_space(c), F.lit("\n"), F.lit(1))
    return strip_space(F.replace(F.regexp_replace(first_line, "[\"']", ""), F.lit("Label:"), F.lit("")))
