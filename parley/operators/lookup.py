"""Single conversations by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.schemas import TURNS


def conversation_by_id(fact: DataFrame, conversation_id: str) -> DataFrame:
    """The stored conversation text of one id; empty if there is none."""
    return fact.filter(F.col("id") == conversation_id).select("id", "full_content")


def conversation_content(fact: DataFrame, conversation_id: str) -> DataFrame:
    """One conversation with metadata and decoded turns.

    ``message_count`` counts the stored messages; the table's ``turn_count`` is what the source
    reported.
    """
    turns = F.from_json("full_content", TURNS)
    return fact.filter(F.col("id") == conversation_id).select(
        "id",
        "model",
        "topic",
        "search_text",
        turns.alias("conversation"),
        F.size(turns).alias("message_count"),
    )
