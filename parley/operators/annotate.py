"""Annotating first prompts with category, programming language and error message."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import strip_space
from parley.operators.clean import CHARS_PER_TOKEN, first_user_message

MAX_TOKENS = 4096 - 50
INSTRUCTION_TOKENS = 120
PREVIEW = 100

# What a missing key or an unreadable answer means.
NO_CATEGORY, NO_VALUE, UNREADABLE = "Other", "None", "Error"


def eligible_prompts(
    raw: DataFrame,
    language: str = "English",
    longer_than: int = 5,
    shorter_than: int = 10_000,
    max_tokens: int = MAX_TOKENS,
    count_tokens: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``(id, prompt)`` of the records whose first user message an annotator can take.

    ``count_tokens`` may be a real tokenizer; the default estimates from the length.
    """
    prompt = F.col("prompt")
    length = F.length(prompt)
    used = (
        count_tokens(prompt)
        if count_tokens
        else F.floor(length / CHARS_PER_TOKEN) + INSTRUCTION_TOKENS
    )
    return (
        raw.filter(F.col("language") == language)
        .select(
            F.col("conversation_hash").alias("id"),
            first_user_message(F.col("conversation")).alias("prompt"),
        )
        .filter((length > longer_than) & (length < shorter_than) & (used < max_tokens))
    )


def keyword_answer(
    prompt: Column,
    categories: dict[str, Sequence[str]],
    languages: dict[str, Sequence[str]],
    error: str = r"\b[A-Za-z.]*(?:Error|Exception)\b",
    coding: str = "Coding",
) -> Column:
    """A deterministic annotator: the JSON answer a model would give, from keywords.

    Language and error are looked for in prompts of the coding category only.
    """
    lowered = F.lower(prompt)

    def first(rules: dict[str, Sequence[str]], default: str) -> Column:
        chosen = F.lit(default)
        for name in reversed(list(rules)):
            hit = F.lit(False)
            for word in rules[name]:
                hit = hit | F.contains(lowered, F.lit(word))
            chosen = F.when(hit, F.lit(name)).otherwise(chosen)
        return chosen

    category = first(categories, NO_CATEGORY)
    is_code = category == coding
    message = F.regexp_extract(prompt, error, 0)
    return F.to_json(
        F.struct(
            category.alias("cat"),
            F.when(is_code, first(languages, NO_VALUE)).otherwise(F.lit(NO_VALUE)).alias("lang"),
            F.when(is_code & (message != ""), message).otherwise(F.lit(NO_VALUE)).alias("err"),
        )
    )


def external_answers(
    prompts: DataFrame, load_model: Callable[[], Callable[[list[str]], list[str]]]
) -> DataFrame:
    """``(id, prompt, answer)`` from an external model, loaded once per Python worker."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for part in parts:
            yield part.assign(answer=model(part["prompt"].tolist()))

    return prompts.select("id", "prompt").mapInPandas(run, "id string, prompt string, answer string")


def parse_answers(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """Adds category, language and error of a JSON answer, fenced or not.

    No JSON object: ('Error', 'None', 'None'). A missing key gives that key's default, a key with
    null stays NULL.
    """
    bare = F.regexp_replace(strip_space(F.col(answer)), "```(?:json)?", "")
    parsed = answers.withColumn("_bare", bare).withColumns(
        {"_value": F.try_parse_json("_bare"), "_keys": F.json_object_keys("_bare")}
    )
    readable = F.col("_value").isNotNull() & F.col("_keys").isNotNull()

    def field(key: str, default: str, unreadable: str) -> Column:
        found = F.when(
            F.array_contains("_keys", key), F.try_variant_get("_value", f"$.{key}", "string")
        ).otherwise(F.lit(default))
        return F.when(readable, found).otherwise(F.lit(unreadable))

    return parsed.withColumns(
        {
            "category": field("cat", NO_CATEGORY, UNREADABLE),
            "language": field("lang", NO_VALUE, NO_VALUE),
            "error": field("err", NO_VALUE, NO_VALUE),
        }
    ).drop("_bare", "_value", "_keys")


def annotations(answers: DataFrame) -> DataFrame:
    """``(prompt_preview, category, language, error)`` from ``(prompt, answer)``."""
    return parse_answers(answers).select(
        F.substring("prompt", 1, PREVIEW).alias("prompt_preview"), "category", "language", "error"
    )
