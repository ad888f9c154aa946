"""Rule-based topic assignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Topics in order of precedence with their keywords.
TOPIC_KEYWORDS = {
    "Coding & Debugging": (
        "python", "java", "code", "error", "bug", "sql", "api", "function", "script", "html", "css",
        "react", "node",
    ),
    "Math & Logic": (
        "calculate", "solve", "math", "equation", "proof", "logic", "probability", "geometry",
        "calculus", "algebra",
    ),
    "Creative Writing": (
        "write", "story", "poem", "essay", "script", "lyrics", "novel", "fiction", "character", "plot",
    ),
    "Academic & Research": (
        "thesis", "research", "citation", "summary", "paper", "article", "bibliography", "study",
        "analysis",
    ),
    "Roleplay & Simulation": (
        "act as", "pretend", "you are a", "simulation", "dungeon", "game", "character",
    ),
    "Translation & Lang": (
        "translate", "english to", "spanish", "chinese", "grammar", "vocabulary", "language",
    ),
    "Advice & Life": (
        "advice", "help me", "suggestion", "tip", "relationship", "gift", "idea", "plan",
    ),
}
DEFAULT_TOPIC = "General"
NOISE_TOPIC = "General / Noise"


def keyword_topic(
    text: Column,
    rules: Mapping[str, Sequence[str]] = TOPIC_KEYWORDS,
    default: str = DEFAULT_TOPIC,
) -> Column:
    """First topic with a keyword that occurs anywhere in the lower-cased text."""
    lowered = F.lower(text)
    topic = F.lit(default)
    for name in reversed(list(rules)):
        hit = F.lit(False)
        for keyword in rules[name]:
            hit = hit | F.contains(lowered, F.lit(keyword))
        topic = F.when(hit, F.lit(name)).otherwise(topic)
    return topic
