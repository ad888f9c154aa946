"""Importance resampling towards a target corpus, on hashed word n-grams.

A text is seen as UTF-8 bytes. A table of 256 bytes lower-cases A-Z and turns every separator into
a blank, so ``bytes.split`` yields the words; the CRC of an n-gram continues that of the n-gram one
word shorter, and a Counter per task gathers its buckets. A bucket's gain is the log ratio of its
shares in the target and in the corpus, a document's weight its mean gain, and Gumbel noise derived
from the id turns the largest scores into a draw without replacement.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.arrow import small_batches
from parley.llm.store import stored
from parley.llm.words import bytes_of

BUCKETS = 10_000
PIECE_BYTES = 1 << 20

#: Digits, letters and all bytes beyond ASCII are parts of words.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def pieces(data: memoryview, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, some ``size`` bytes at a time."""
    low, rest = 0, b""
    while low < len(data):
        part = rest + bytes(data[low : low + size]).translate(TABLE)
        low += size
        # A word that goes on in the next piece waits for it.
        cut = len(part) if low >= len(data) else part.rfind(b" ") + 1
        rest = part[cut:]
        yield part[:cut].split()


def grams(words: list[bytes], most: int, before: int = 0) -> Iterator[list[int]]:
    """CRCs of the runs of 1 to ``most`` words, joined by one blank, that end after the first
    ``before`` words."""
    ends = list(map(crc32, words))
    yield ends[before:]
    for n in range(2, most + 1):
        ends = list(map(crc32, words[n - 1 :], map(crc32, repeat(b" "), ends)))
        yield ends[max(0, before - n + 1) :]


def features(data: memoryview, most: int) -> tuple[int, Counter[int]]:
    """The number of words of a text, and how often each CRC is that of an n-gram."""
    n_words, found, tail = 0, Counter(), []
    for words in pieces(data):
        n_words += len(words)
        words = tail + words
        for crcs in grams(words, most, len(tail)):
            found.update(crcs)
        tail = words[max(0, len(words) - most + 1) :] if most > 1 else []
    return n_words, found


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[memoryview]:
    data, offsets = bytes_of(batch.column(column))
    view = memoryview(data)
    return (view[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))


def _counted(most: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for batch in batches:
            for text in _texts(batch, 0):
                for crc, n in features(text, most)[1].items():
                    total[crc % buckets] += n
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(total.keys(), pa.int64()), "n": pa.array(total.values(), pa.int64())}
        )

    return run


def bucket_counts(texts: DataFrame, most: int = 1, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """``bucket`` and ``n``: how many n-grams of all texts fall into each bucket that has any."""
    small_batches(texts.sparkSession, 4 << 20)
    counts = texts.select(text).mapInArrow(_counted(most, buckets), "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket: 1000 times the natural logarithm of the ratio of smoothed shares,
    rounded down. Both tables are counts by bucket, at most ``buckets`` rows."""
    s, t = dict(map(tuple, source.collect())), dict(map(tuple, target.collect()))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    return [
        math.floor(1000 * math.log((t.get(b, 0) + 1) * all_s / ((s.get(b, 0) + 1) * all_t))) for b in range(buckets)
    ]


def _weighed(most: int, gain: list[int]):
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in _texts(batch, 1):
                n_words, found = features(text, most)
                n = found.total()
                rows.append((n_words, n, sum(gain[c % buckets] * k for c, k in found.items()) // n if n else 0))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_words", "n_features", "weight"])

    return run


def draw(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    most: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its ``id``, ``n_words``, ``n_features`` (runs of 1 to ``most``
    words, repeats counted), ``weight`` (mean gain, rounded down; 0 without features), ``score``
    (weight plus noise that depends on ``seed`` and the id) and ``rank``: 1, 2, 3 and so on for the
    ``percent`` of the documents with at least ``least_words`` words that have the highest scores,
    NULL for the others.

    Equal scores go by id, NULL first, then by weight and number of features; rows equal in all of
    these are interchangeable, and each counts. A NULL id is hashed as empty text. NULL texts, of
    documents or of the target, have no words. With an empty target all gains follow from the
    smoothing alone. An empty table gives no rows. Other columns are not read; :func:`drawn` fetches
    the rows themselves.

    Texts are read twice, for the counts and for the weights. The driver holds the counts of
    ``buckets`` buckets, whatever the size of the corpus. Documents are ranked by a range sort of
    rows of six numbers; the sums of its partitions are one row each.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, most, buckets, text), bucket_counts(target, most, buckets, target_text), buckets)
    small_batches(spark, 4 << 20)
    kind = docs.schema[id].dataType
    schema = T.StructType([T.StructField("id", kind)] + [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(salted, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    weighed = docs.select(F.col(id).alias("id"), text).mapInArrow(_weighed(most, gain), schema)
    weighed = stored(weighed.withColumn("score", F.col("weight") + noise), "weights")

    keys = [F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("weight").desc(), "n_features"]
    order = weighed.filter(F.col("n_words") >= least_words).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The number's upper bits are the partition, the lower ones the place in it.
    order = stored(order.withColumn("at", F.monotonically_increasing_id()), "order")
    part = F.shiftrightunsigned("at", 33)
    totals = order.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bases = bases.crossJoin(totals.agg(F.coalesce(F.expr(f"({percent} * sum(n)) div 100"), F.lit(0)).alias("wanted")))
    place = F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    names = ["id", "n_words", "n_features", "weight", "score"]
    # One row per partition of the sort.
    ranked = order.withColumn("part", part).join(F.broadcast(bases), "part")
    ranked = ranked.select(*names, F.when(place <= F.col("wanted"), place).alias("rank"))
    rest = weighed.filter(F.col("n_words") < least_words).select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest).withColumnRenamed("id", id)


def drawn(docs: DataFrame, ranks: DataFrame, id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, whose id has a rank. Ids are taken to be distinct: of rows
    that share one, all come if one was drawn. Rows with a NULL id are not found."""
    chosen = ranks.filter(F.col("rank").isNotNull()).select(F.col(id).alias("__id")).distinct()
    return docs.join(chosen, docs[id] == F.col("__id"), "left_semi")
