"""A corpus pipeline of the training-data operators: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import decontaminate, ordered_minhash, passages, quality, suffixes
from parley.llm.registry import packed
from parley.llm.store import stored


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that fail or lose too much that way."""
    return _sized(quality.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the smallest id."""
    return ordered_minhash.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that occur twice or more go, at all their places. What a cut leaves of
    a character goes too. Of what is left, passages of over 50 words that stand in several documents
    go, whatever their bytes. Documents of which nothing is left go."""
    rows = docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))
    found = suffixes.remove_repeats(rows)
    text = F.when(F.size("repeats.spans") == 0, F.col("text")).otherwise(suffixes.whole_characters(F.col("repeats.kept")))
    found = found.withColumn("text", F.when(F.col("text").isNotNull(), text))
    found = found.filter((F.length("text") > 0) | (F.col("repeats.n_removed") == 0))
    found = found.select(*[F.col("text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])
    return _sized(passages.cut_passages(found))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences."""
    return packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated strings", repeated_strings),
    ("benchmark leaks", benchmark_leaks),
    ("packing", packing),
]

#: Alignment, repeated byte strings and the tokenizer are beyond SQL; the tests follow each stage by
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
