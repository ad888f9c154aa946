"""Benchmark items inside documents: containment search by MinHash over windows of like size.

Items are partitioned by their number of distinct shingles, one class per power of two. For a class
of items with up to s shingles, a document is a set of windows of 2 s shingles that overlap by half,
so an item that stands in the document stands in one window whole, and its share of that window is
bounded below whatever the length of the document. One equal minimum out of ``PERMUTATIONS`` makes
a candidate; its containment in the whole document is then counted on the words themselves.

Minima are joined by equality on the executors. A filter of bounded size over the items' minima goes
to the documents first, so those that no item touches send nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.arrow import small_batches, thrifty
from parley.llm.key_filter import in_filter, key_filter
from parley.llm.store import stored
from parley.llm.words import mix, word_chunks

SHINGLE = 5
CONTAINMENT = 0.8
PERMUTATIONS = 32  # at containment 0.8 a window shares at least 0.19 with an item: 0.1 % missed
BLOCK_BYTES = 4 << 20
BATCH_BYTES = 4 << 20
BITS_PER_KEY = 256
SALTS = 8
SEEN = 10_000  # texts that a task remembers having sent

_MULTIPLIERS = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)


def words_of(text: bytes) -> list[bytes]:
    """Words between white space, A-Z lower-cased."""
    return text.lower().split()


def shingles_of(text: bytes) -> set[tuple[bytes, ...]]:
    w = words_of(text)
    return {tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}


def _keys(minima: np.ndarray, size_class: int, permutation: int) -> np.ndarray:
    """Minima as keys that differ by class of size and permutation."""
    salt = mix(np.array([size_class * PERMUTATIONS + permutation + 1], dtype=np.uint64))
    return mix(minima ^ salt)


def _item_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, class, keys) of each item with a shingle; its class is the exponent of its size."""
    for batch in batches:
        for chunk in word_chunks(batch.column(1), lower=True):
            grams, whole = chunk.grams(SHINGLE)
            rows, classes, keys = [], [], []
            for r, (a, b) in enumerate(zip(chunk.bounds, chunk.bounds[1:], strict=False)):
                hashes = np.unique(grams[a:b][whole[a:b]])
                if len(hashes):
                    rows.append(chunk.first_row + r)
                    classes.append((len(hashes) - 1).bit_length())
                    minima = [(hashes * m).min(keepdims=True) for m in _MULTIPLIERS]
                    keys.append(np.concatenate([_keys(x, classes[-1], j) for j, x in enumerate(minima)]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(classes, pa.int32()), pa.array(keys, pa.list_(pa.int64()))],
                ["item", "class", "keys"],
            )


def _hits(chunk, classes: list[int], words: np.ndarray) -> dict[int, list[np.ndarray]]:
    """For rows of the chunk the keys of their windows that the filter holds."""
    grams, whole = chunk.grams(SHINGLE)
    hashes = grams[whole]
    found: dict[int, list[np.ndarray]] = {}
    if not len(hashes):
        return found
    counts = np.maximum(0, chunk.counts - (SHINGLE - 1))
    firsts = np.cumsum(counts) - counts
    layout = {}
    for c in classes:
        blocks = -(-counts // (1 << c))
        row = np.repeat(np.arange(len(counts)), blocks)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        layout[c] = (firsts[row] + (nth << c), row, row[1:] == row[:-1])
    for j, m in enumerate(_MULTIPLIERS):
        ordered = hashes * m
        for c, (starts, row, joined) in layout.items():
            minima = np.minimum.reduceat(ordered, starts)
            minima[:-1] = np.where(joined, np.minimum(minima[:-1], minima[1:]), minima[:-1])
            keys = _keys(minima, c, j)
            at = np.flatnonzero(in_filter(keys, words))
            for r, k in zip(row[at].tolist(), at.tolist(), strict=True):
                found.setdefault(r, []).append(keys[k])
    return found


def _touched(shared, classes: list[int]):
    """(doc, text, keys) of the texts that hold a key of the items, as the filter sees it."""

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        seen: set[str] = set()
        for batch in batches:
            for chunk in word_chunks(batch.column(1), lower=True):
                names, texts, keys = [], [], []
                for r, own in _hits(chunk, classes, words).items():
                    name = batch.column(0)[chunk.first_row + r].as_py()
                    if name in seen:
                        continue
                    if len(seen) == SEEN:
                        seen.clear()
                    seen.add(name)
                    names.append(name)
                    texts.append(chunk.data[chunk.offsets[r] : chunk.offsets[r + 1]].tobytes())
                    keys.append(np.unique(np.array(own, dtype=np.uint64)).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(texts, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc", "text", "keys"],
                )

    return run


def shares(text: bytes, items: list[bytes]) -> list[float]:
    """The part of each item's distinct shingles that is in ``text``. Shingles with an equal hash are
    compared by their words; the text's other shingles are never held as words."""
    wanted = [shingles_of(t) for t in items]
    anything = set().union(*wanted)
    hashes = [c.grams(SHINGLE)[0][c.grams(SHINGLE)[1]] for c in word_chunks(pa.array([b"\n".join(items)], pa.binary()), lower=True)]
    hashes = np.unique(np.concatenate(hashes))
    there: set[tuple[bytes, ...]] = set()
    for chunk in word_chunks(pa.array([text], pa.binary()), lower=True):
        grams, whole = chunk.grams(SHINGLE)
        for p in np.flatnonzero(whole & np.isin(grams, hashes)):
            shingle = tuple(chunk.data[a:b].tobytes() for a, b in zip(chunk.starts[p : p + SHINGLE], chunk.ends[p : p + SHINGLE], strict=True))
            if shingle in anything:
                there.add(shingle)
    return [len(w & there) / len(w) for w in wanted]


def _verified(containment: float):
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, items, parts = [], [], []
            for name, text, asked in zip(*(batch.column(c) for c in ("doc", "text", "asked")), strict=True):
                asked = asked.as_py()
                for x, share in zip(asked, shares(text.as_py(), [x["text"].encode() for x in asked]), strict=True):
                    if share >= containment:
                        docs.append(name.as_py())
                        items.append(x["item"])
                        parts.append(share)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.string()), pa.array(items, pa.string()), pa.array(parts, pa.float64())], ["doc", "item", "containment"]
            )

    return run


def _salted(big: DataFrame, small: DataFrame, key: str, by: str) -> DataFrame:
    """An inner join on ``key`` in which one value's rows of ``big`` are dealt into parts by ``by``."""
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return big.withColumn("__salt", salt).join(small.withColumn("__salt", every), [key, "__salt"]).drop("__salt")


def contained(docs: DataFrame, items: DataFrame, containment: float, block_bytes: int) -> DataFrame:
    """(doc, items) for the texts of ``docs`` (doc: their MD5, text) that contain an item of ``items``
    (id, text): its id and the share of its distinct shingles that is there, by id."""
    spark = docs.sparkSession
    named = stored(items.dropna().select("id", F.md5("text").alias("item"), "text"), "items")
    texts = stored(named.groupBy("item").agg(F.first("text").alias("text")), "item-texts")
    minima = stored(texts.mapInArrow(_item_keys, "item string, class int, keys array<bigint>"), "item-minima")
    classes = sorted(r[0] for r in minima.select("class").distinct().collect())  # exponents of sizes: some dozens at the most
    keys = minima.select("item", F.explode("keys").alias("key"))
    shared = spark.sparkContext.broadcast(key_filter(keys.select("key"), BITS_PER_KEY))
    touched = docs.mapInArrow(_touched(shared, classes), "doc string, text binary, keys array<bigint>")
    touched = stored(touched.groupBy("doc").agg(F.first("text").alias("text"), F.first("keys").alias("keys")), "touched")
    pairs = _salted(touched.select("doc", F.explode("keys").alias("key")), keys, "key", "doc").select("doc", "item").distinct()
    pairs = stored(_salted(pairs, texts, "item", "doc"), "candidates")
    # Where a text has many candidates they are looked at in parts of about ``block_bytes``.
    parts = pairs.groupBy("doc").agg(F.ceil(F.sum(F.octet_length("text")) / block_bytes).alias("parts"))
    asked = pairs.join(parts, "doc").groupBy("doc", F.pmod(F.xxhash64("item"), "parts").alias("part"))
    asked = asked.agg(F.collect_list(F.struct("item", "text")).alias("asked"))
    asked = touched.select("doc", "text").join(asked, "doc").select("doc", "text", "asked")
    found = asked.mapInArrow(_verified(containment), "doc string, item string, containment double")
    found = _salted(found, named.select("item", "id"), "item", "doc")
    found = found.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct(F.col("id").alias("item"), "containment"))).alias("items"))
    return stored(found, "contained")


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All rows of ``docs`` plus ``items`` (replacing a column of that name): the items of which at
    least ``containment`` of the distinct five-word shingles are in the text, with that share.

    Words stand between white space; A-Z is lower-cased. Items with fewer than five words or a NULL
    id or text have no shingles and are not searched; items may repeat, and each is reported. NULL,
    empty and short texts contain nothing. Without items the lists are empty.

    Texts are told apart by MD5, so copies are looked at once. Only texts that share a minimum with an
    item are shuffled, at most once each; ``block_bytes`` bounds the items that one of them meets at a
    time. Neither the driver nor a broadcast holds items: what goes to all workers is a filter over
    their minima of ``FILTER_BITS`` at the most, beyond which it lets more through. The result joins
    the documents on the MD5 of those that contain something, with copies dealt into ``SALTS`` parts.
    """
    spark = docs.sparkSession
    small_batches(spark, BATCH_BYTES)
    rest = docs.drop("items")
    name = F.md5(F.col(text)).alias("doc")
    wanted = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    found = contained(rest.select(name, F.col(text).alias("text")).dropna(), wanted, containment, block_bytes)
    # Copies, and rows without text, are dealt into parts by what else they hold.
    plain = [c for c in rest.columns if not any(k in rest.schema[c].dataType.simpleString() for k in ("map<", "variant"))]
    own = F.xxhash64(*plain)
    rows = rest.select(
        F.struct(*rest.columns).alias("__row"),
        F.coalesce(F.md5(F.col(text)), F.concat(F.lit("none "), own)).alias("__doc"),
        F.pmod(own, F.lit(SALTS)).cast("int").alias("__salt"),
    )
    found = found.select(
        F.col("doc").alias("__doc"), F.col("items").alias("__items"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    )
    nothing = F.array().cast("array<struct<item:bigint,containment:double>>")
    return rows.join(found, ["__doc", "__salt"], "left").select("__row.*", F.coalesce("__items", nothing).alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that contain no item, with the columns of ``docs``."""
    rows = docs.select(F.col(text).alias("text"), F.struct(*docs.columns).alias("row"))
    return find_items(rows, items, **options).filter(F.size("items") == 0).select("row.*")
