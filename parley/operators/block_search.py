"""Ranked search that skips blocks of documents, by the largest score each could hold.

Documents are grouped by length class and, within a class, into blocks. For every term and block the
index keeps the largest saturation, the part of BM25 that depends on the document. A block's bound
is the sum over the query's terms of these maxima times the terms' weights. The blocks with the
greatest bounds are scored first; the n-th best score found there rules out all blocks whose bound
is lower, and of classes without a block left no file is opened.

Postings are written by root, which is the term or its stem, so a stemmed query is one filter on the
files like any other. Scores are those of :mod:`parley.operators.search`.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.functions.filters import build_filters
from parley.functions.stem import stem_texts
from parley.functions.text import snippet
from parley.operators.search import (
    SCORE_DIGITS, SNIPPET, _idf, _saturation, _wanted, word_stats, words_by_id, written_words,
)

BLOCKS = 1024  # in a class of lengths
SEEDS = 32  # blocks scored first
CLASSES = 4  # for each doubling of the length
SLACK = 10.0 ** (1 - SCORE_DIGITS)  # scores are rounded

TABLES = {
    "words": "doc long, id string, length int, copies long",
    "postings": "root string, block long, doc long, length int, tf long, top double, class int",
    "docs": "id string, snippet string",
    "stats": "n_docs long, mean_length double",
}


@dataclass
class BlockIndex:
    """``postings`` (class, root, block, id, length, tf), ``maxima`` (class, root, block, top),
    ``roots`` (root, doc_freq), ``docs`` (id, snippet) and the one-row ``stats`` (n_docs,
    mean_length)."""

    postings: DataFrame
    maxima: DataFrame
    roots: DataFrame
    docs: DataFrame
    stats: DataFrame
    stems: bool


def _class(length: Column) -> Column:
    return F.floor(CLASSES * F.log2(length)).cast("int")


def write_blocks(
    fact: DataFrame, path: str, stop_words: Iterable[str] = (), stems: bool = False, blocks: int = BLOCKS
) -> BlockIndex:
    """Write (or replace) the index of ``search_text`` by ``id`` and read it back.

    Roots are counted within their document. Postings move once, by class, root and block, so a
    frequent root is many files; the largest saturation of a block is found where its postings lie and
    written beside them."""
    spark = fact.sparkSession
    words = written_words(words_by_id(fact, stop_words, stem_texts if stems else None), path)
    word_stats(words).write.mode("overwrite").parquet(f"{path}/stats")
    stats = spark.read.schema(TABLES["stats"]).parquet(f"{path}/stats")
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)) + _class(F.col("length")).cast("long") * blocks
    rows = words.select("doc", "length", block.alias("block"), F.inline("counts")).withColumnRenamed("term", "root")
    rows = rows.select(_class(F.col("length")).alias("class"), "root", "block", "doc", "length", "tf")
    keys = ["class", "root", "block"]
    # The window needs no second exchange, and the order it asks for is that of the files.
    placed = rows.repartitionByRange(*keys).crossJoin(F.broadcast(stats))  # one row
    top = F.max(_saturation(F.col("tf"), F.col("length"), F.col("mean_length"))).over(Window.partitionBy(*keys))
    placed = placed.select("root", "block", "doc", "length", "tf", top.alias("top"), "class").sortWithinPartitions(*keys, "doc")
    placed.write.mode("overwrite").partitionBy("class").parquet(f"{path}/postings")
    previews = fact.select("id", snippet(F.col("search_text"), SNIPPET).alias("snippet"))
    previews.write.mode("overwrite").parquet(f"{path}/docs")
    return read_blocks(spark, path, stems)


def read_blocks(spark: SparkSession, path: str, stems: bool = False) -> BlockIndex:
    """An index written with the same ``stems``. Filters on class, root and block reach the files."""
    tables = {t: spark.read.schema(s).parquet(f"{path}/{t}") for t, s in TABLES.items()}
    postings = tables["postings"]
    return BlockIndex(
        postings=postings.drop("top").join(tables["words"].select("doc", "id"), "doc").drop("doc"),
        maxima=postings.groupBy("root", "class", "block").agg(F.first("top").alias("top")),
        roots=postings.groupBy("root").agg(F.count(F.lit(1)).alias("doc_freq")),
        docs=tables["docs"],
        stats=tables["stats"],
        stems=stems,
    )


def _weights(index: BlockIndex, wanted: list[str]) -> DataFrame:
    """``root``, ``weight`` and the mean length, one row per root of the query."""
    known = index.roots.filter(F.col("root").isin(wanted)).crossJoin(F.broadcast(index.stats))  # one row
    return known.select("root", _idf(F.col("n_docs"), F.col("doc_freq")).alias("weight"), "mean_length")


def bounds(index: BlockIndex, wanted: list[str]) -> DataFrame:
    """``class``, ``block`` and ``bound`` of every block that holds a root of the query."""
    tops = index.maxima.filter(F.col("root").isin(wanted))
    weighed = tops.join(F.broadcast(_weights(index, wanted)), "root")  # one row per root
    return weighed.groupBy("class", "block").agg(F.sum(F.col("weight") * F.col("top")).alias("bound"))


def _scores(index: BlockIndex, postings: DataFrame, wanted: list[str]) -> DataFrame:
    part = F.col("weight") * _saturation(F.col("tf"), F.col("length"), F.col("mean_length"))
    hits = postings.filter(F.col("root").isin(wanted)).join(F.broadcast(_weights(index, wanted)), "root")  # one row per root
    return hits.groupBy("id").agg(F.round(F.sum(part), SCORE_DIGITS).alias("score"))


def surviving(index: BlockIndex, wanted: list[str], limit: int, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks that may hold one of the ``limit`` best, and the postings of their classes.

    ``kept`` has the ids that pass the filters. The driver sees the keys of at most ``SEEDS`` blocks,
    ``limit`` scores, and the classes left, of which there are about a hundred at the most."""
    all_bounds = bounds(index, wanted)
    seeds = all_bounds.orderBy(F.desc("bound"), "block").limit(SEEDS).collect()
    classes, blocks = sorted({r["class"] for r in seeds}), [r.block for r in seeds]
    first = index.postings.filter(F.col("class").isin(classes) & F.col("block").isin(blocks))
    scored = _scores(index, first, wanted).join(kept, "id", "left_semi")
    best = [r.score for r in scored.orderBy(F.desc("score")).limit(limit).select("score").collect()]
    if len(best) == limit:
        all_bounds = all_bounds.filter(F.col("bound") >= best[-1] - SLACK)
    left = [r[0] for r in all_bounds.select("class").distinct().collect()]
    return all_bounds.select("class", "block"), index.postings.filter(F.col("class").isin(left))


def search_blocks(
    index: BlockIndex,
    fact: DataFrame,
    query: str,
    topic: str | None = None,
    model: str | None = None,
    min_turns: int | None = None,
    limit: int = 5,
    stop_words: Iterable[str] = (),
) -> DataFrame:
    """As ``search.search_index``, reading only blocks that can hold one of the best."""
    wanted = _wanted(query, stop_words, index.stems)
    keep = build_filters(models=[model] if model else None, topic=topic, min_turns=min_turns)
    rows = fact.filter(keep).select("id", "model_family", "topic", "turn_count")
    blocks, postings = surviving(index, wanted, limit, rows.select("id"))
    scores = _scores(index, postings.join(blocks, ["class", "block"], "left_semi"), wanted)
    best = rows.join(scores, "id").orderBy(F.desc("score"), "id").limit(limit)
    found = best.join(index.docs, "id").select("id", "model_family", "topic", "turn_count", "score", "snippet")
    return found.orderBy(F.desc("score"), "id")
