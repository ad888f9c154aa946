"""Model names: family and release date lookup, and the coarse buckets for style comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Raw model name, family, release date.
MODELS = (
    ("gpt-4.1-mini-2025-04-14", "gpt-4.1", "2025-04-14"),
    ("gpt-4o", "gpt-4o", "2024-05-13"),
    ("gpt-4o-2024-05-13", "gpt-4o", "2024-05-13"),
    ("gpt-4o-2024-08-06", "gpt-4o", "2024-08-06"),
    ("gpt-4o-2024-11-20", "gpt-4o", "2024-11-20"),
    ("gpt-4o-mini", "gpt-4o", "2024-07-18"),
    ("gpt-4o-mini-2024-07-18", "gpt-4o", "2024-07-18"),
    ("gpt-4", "gpt-4", "2023-03-14"),
    ("gpt-4-0314", "gpt-4", "2023-03-14"),
    ("gpt-4-0613", "gpt-4", "2023-06-13"),
    ("gpt-4-1106-preview", "gpt-4", "2023-11-06"),
    ("gpt-4-0125-preview", "gpt-4", "2024-01-25"),
    ("gpt-4-turbo", "gpt-4", "2024-04-09"),
    ("gpt-4-turbo-2024-04-09", "gpt-4", "2024-04-09"),
    ("gpt-3.5-turbo", "gpt-3.5", "2022-11-30"),
    ("gpt-3.5-turbo-0301", "gpt-3.5", "2023-03-01"),
    ("gpt-3.5-turbo-0613", "gpt-3.5", "2023-06-13"),
    ("gpt-3.5-turbo-1106", "gpt-3.5", "2023-11-06"),
    ("gpt-3.5-turbo-0125", "gpt-3.5", "2024-01-25"),
    ("text-davinci-002-render-sha", "gpt-3.5", "2022-11-30"),
    ("o1-preview", "o1", "2024-09-12"),
    ("o1-preview-2024-09-12", "o1", "2024-09-12"),
    ("o1-mini", "o1", "2024-09-12"),
    ("o1-mini-2024-09-12", "o1", "2024-09-12"),
)
OTHER_FAMILY = "other"

# Bucket and the name parts that select it; first hit wins, the rest is gpt-4.
BUCKETS = (
    ("gpt-4o", ("gpt-4o",)),
    ("gpt-3.5-turbo", ("gpt-3.5-turbo",)),
    ("o1", ("o1-mini", "o1-preview")),
)
REST_BUCKET = "gpt-4"


def with_model_family(df: DataFrame, model: str = "model", models=MODELS) -> DataFrame:
    """Add ``model_family`` and ``model_release_date``; unknown models get ('other', NULL).

    The few dozen entries are a literal map, so this is a projection: no join, usable on streams,
    and gone from the plan when neither column is used.
    """
    name = F.col(model)
    return df.withColumns(
        {
            "model_family": F.coalesce(_lookup(name, {m: f for m, f, _ in models}), F.lit(OTHER_FAMILY)),
            "model_release_date": _lookup(name, {m: d for m, _, d in models}).cast("date"),
        }
    )


def _lookup(name: Column, entries: dict[str, str]) -> Column:
    pairs = [F.lit(x) for entry in entries.items() for x in entry]
    return F.try_element_at(F.create_map(*pairs), name)


def model_bucket(c: Column) -> Column:
    """One of four buckets by ordered substring tests; NULL and unknown names are gpt-4."""
    bucket = F.lit(REST_BUCKET)
    for name, parts in reversed(BUCKETS):
        hit = F.lit(False)
        for part in parts:
            hit = hit | F.contains(c, F.lit(part))
        bucket = F.when(hit, F.lit(name)).otherwise(bucket)
    return bucket
