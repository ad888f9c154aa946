"""The filter shared by all analytics functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.text import words
from parley.functions.topics import NOISE_TOPIC


def build_filters(
    models: Sequence[str] | None = None,
    topic: str | None = None,
    start: str | None = None,
    end: str | None = None,
    exclude_noise: bool = True,
    min_turns: int | None = None,
    noise: str = NOISE_TOPIC,
) -> Column:
    """AND of the parts that are given; None, '' and [] all mean "no restriction".

    Excluding noise also drops rows without a topic, as the comparison is NULL there. Both date
    ends are inclusive; a bare end date means its first instant.
    """
    keep = F.lit(True)
    if exclude_noise:
        keep = keep & (F.col("topic") != noise)
    if models:
        keep = keep & F.col("model_family").isin(list(models))
    if topic:
        keep = keep & (F.col("topic") == topic)
    if start:
        keep = keep & (F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        keep = keep & (F.col("timestamp") <= F.lit(end).cast("timestamp_ntz"))
    if min_turns:
        keep = keep & (F.col("turn_count") >= min_turns)
    return keep


def more_words(c: Column, than: int) -> Column:
    """More than so many words between white space; false for NULL."""
    return F.coalesce(F.size(words(c)) > than, F.lit(False))


def usable_text(c: Column, longer_than: int = 10) -> Column:
    """Text long enough to model."""
    return F.length(c) > longer_than
