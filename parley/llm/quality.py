"""Line-first cleaning with DataFrame functions only.

Rules look at one line at a time. Lines that fail are removed, and a document that loses too much
of its text that way is rejected. Next to the rules stand a few measures of the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

MAX_LOSS = 0.5
MIN_WORDS = 10
MAX_REPEATED = 0.2
GRAM = 5

# Rules on a line, as regular expressions that fail it. They hold in Java's and in RE2's syntax.
NAVIGATION = r"\|[^|]*\|[^|]*\||[»›][^»›]*[»›]"
SHOUTING = r"!!.*!!.*!!"
UNPUNCTUATED_FROM = 20
MANY_WORDS = rf"({WORD}+{SPACES}){{{UNPUNCTUATED_FROM - 1}}}{WORD}"
PUNCTUATION = r"[.!?;:,…。！？]"
BOILERPLATE = (
    r"(?i)\b(all rights reserved|privacy policy|terms of (use|service)|enable javascript"
    r"|accept (all )?cookies|click here|subscribe (now|to)|lorem ipsum|share this)\b"
)
BOILERPLATE_LENGTH = 200
SYMBOLS = r"[^#*$%&|<>]+"
SYMBOL_SHARE = 20  # a line fails with more than one symbol in so many characters


def failed_rule(line: Column) -> Column:
    """The name of the first rule that the line fails, or NULL. Lines without words fail none."""
    return (
        F.when(~line.rlike(WORD), F.lit(None).cast("string"))
        .when(line.rlike(NAVIGATION), F.lit("navigation"))
        .when((F.length(line) <= BOILERPLATE_LENGTH) & line.rlike(BOILERPLATE), F.lit("boilerplate"))
        .when(line.rlike(SHOUTING), F.lit("punctuation"))
        .when(~line.rlike(PUNCTUATION) & line.rlike(MANY_WORDS), F.lit("punctuation"))
        .when(
            F.length(F.regexp_replace(line, SYMBOLS, "")) * SYMBOL_SHARE > F.length(line),
            F.lit("symbols"),
        )
    )


def assess(docs: DataFrame, text: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """All rows of ``docs`` plus one struct column ``quality`` (replacing one of that name):
    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``lost_chars`` (code points of words in removed lines), ``kept`` and
    ``cleaned`` (the text without the lines that fail).

    ``base_failed``: fewer than 10 words, or more than a fifth of the words in five-word windows
    that occur twice or more. ``kept`` is false if that holds or if more than ``max_loss`` of the
    word characters are in lines that fail. NULL texts count as empty: no words, rejected, cleaned
    to the empty text. Rows are judged one by one, so repeated rows and ties need no rule.

    Everything stays inside the row, so nothing is shuffled. Windows are compared by a 64-bit hash
    within their document; the sort that finds repeated ones runs only where there are any, so
    time grows as n log n with the length of a text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(t, "\n", -1)
    # The input's columns travel in a struct, so that no name of theirs can clash with one here.
    out = docs.select(
        F.struct(*docs.drop("quality").columns).alias("__row"),
        F.array_remove(F.split(t, SPACES, -1), "").alias("__words"),
        lines.alias("__lines"),
        F.length(F.regexp_replace(t, SYMBOLS, "")).cast("bigint").alias("__symbols"),
    )
    out = out.withColumn(
        "__grams",
        F.when(
            F.size("__words") >= GRAM,
            F.transform(
                F.sequence(F.lit(1), F.size("__words") - (GRAM - 1)),
                lambda i: F.xxhash64(F.slice("__words", i, F.lit(GRAM))),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    ).withColumn("__kept", F.filter("__lines", lambda x: failed_rule(x).isNull()))
    out = out.withColumn(
        "__sorted",
        F.when(
            F.size(F.array_distinct("__grams")) < F.size("__grams"),
            F.array_sort(F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<g:bigint,i:int>>")),
    )
    repeated = F.filter(
        "__sorted",
        lambda p, j: (F.get("__sorted", j - 1)["g"] == p["g"]).eqNullSafe(True)
        | (F.get("__sorted", j + 1)["g"] == p["g"]).eqNullSafe(True),
    )
    out = out.withColumn("__starts", F.array_sort(F.transform(repeated, lambda p: p["i"])))
    first = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-GRAM).alias("last"))
    covered = F.aggregate(
        "__starts",
        first,
        lambda a, x: F.struct(
            (a["n"] + F.least(F.lit(GRAM), x - a["last"]).cast("bigint")).alias("n"), x.alias("last")
        ),
        lambda a: a["n"],
    )
    with_words = F.filter("__lines", lambda x: x.rlike(WORD))
    out = out.withColumns(
        {
            "__n": F.size("__words").cast("bigint"),
            "__chars": F.length(F.array_join("__words", "")).cast("bigint"),
            "__repeat": covered,
            "__cleaned": F.array_join("__kept", "\n"),
            "__dup": (F.size(with_words) - F.size(F.array_distinct(with_words))).cast("bigint"),
        }
    )
    kept_chars = F.length(F.regexp_replace("__cleaned", SPACES, "")).cast("bigint")
    out = out.withColumn("__lost", F.col("__chars") - kept_chars)
    base_failed = (F.col("__n") < MIN_WORDS) | (
        100 * F.col("__repeat") > int(100 * MAX_REPEATED) * F.col("__n")
    )
    quality = F.struct(
        F.col("__n").alias("n_words"),
        F.col("__chars").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"),
        F.col("__dup").alias("n_dup_lines"),
        F.col("__repeat").alias("n_repeat_words"),
        base_failed.alias("base_failed"),
        F.col("__lost").alias("lost_chars"),
        (~base_failed & (F.col("__lost") <= max_loss * F.col("__chars"))).alias("kept"),
        F.col("__cleaned").alias("cleaned"),
    )
    return out.select("__row.*", quality.alias("quality"))


def clean(docs: DataFrame, text: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """The documents that are kept, with their cleaned text and the columns of ``docs``."""
    judged = assess(docs.select(F.col(text).alias("text"), F.struct(*docs.columns).alias("row")), max_loss=max_loss)
    # A filter on what explode() gives stays above it. Below, the optimizer would write the whole
    # assessment into the condition, once for each place that uses it.
    judged = judged.withColumn("quality", F.explode(F.array("quality"))).filter("quality.kept")
    return judged.select(*[F.col("quality.cleaned" if c == text else f"row.`{c}`").alias(c) for c in docs.columns])
