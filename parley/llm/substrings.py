"""Repeated passages between documents, by winnowed anchors that are extended both ways.

A window is ``LENGTH`` consecutive words of a document. Its anchor is the word n-gram with the
smallest hash in it, so equal windows have equal anchors, and neighbouring windows mostly share
theirs: far fewer rows than words. Documents are joined on anchors first. Around each anchor that
several documents have, the windows that reach left and right of it are compared; runs of matching
windows are the maximal repeats.

Neither step pairs documents off. A task folds what it has of a key into one row before the
shuffle: if it has seen the key in several documents, all but the first are decided already, and
travel under a salted key. So a key held by a third of all rows is one row for each batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.arrow import small_batches
from parley.llm.words import mix, signed, sliding_min, word_chunks

LENGTH = 13
ANCHOR = 4  # words
SALTS = 1024
BATCH_BYTES = 4 << 20
NO_ID = -(1 << 63)  # stands for NULL in joins; no anchor has it

FOLDED = "key long, salt int, id long, known boolean"


def fold(keys: np.ndarray, ids: np.ndarray, repeats: bool = False, few: int = 2) -> pa.RecordBatch:
    """A batch's distinct (key, id). A key that ``few`` ids or more have is ``known`` as such: its
    smallest id is under salt 0, the others under salts of their own. All ids of the other keys are
    under salt 0. With ``repeats`` a key counts as often as it stands there, not once for each id."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    new = first.copy()
    new[1:] |= ids[1:] != ids[:-1]
    group = np.cumsum(first) - 1
    sizes = np.bincount(group if repeats else group[new])
    keys, ids, first, known = keys[new], ids[new], first[new], sizes[group[new]] >= few
    salted = 1 + (mix(ids.astype(np.uint64)) % np.uint64(SALTS)).astype(np.int32)
    salt = np.where(first | ~known, 0, salted).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(keys)), pa.array(salt), pa.array(ids), pa.array(known)], ["key", "salt", "id", "known"]
    )


def _windows(chunk, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each whole window's anchor hash, own hash, and row."""
    grams, _ = chunk.grams(anchor)
    whole, inside = chunk.grams(length)
    n = max(0, len(grams) - length + 1)
    anchors = sliding_min(grams, length - anchor + 1)[:n]
    inside = inside[:n]
    return anchors[inside], whole[:n][inside], chunk.row_of_word()[:n][inside]


def _anchors(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for chunk in word_chunks(batch.column(1)):
                anchors, _, row = _windows(chunk, length, anchor)
                change = np.ones(len(anchors), dtype=bool)
                change[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
                keys.append(anchors[change])
                owners.append(ids[chunk.first_row + row[change]])
            yield fold(np.concatenate(keys), np.concatenate(owners))

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values and the bounds of a column of lists of long; NULL is empty."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return values, offsets


def _member(values: np.ndarray, rows: np.ndarray, lists: pa.Array, first: int) -> np.ndarray:
    """Whether each value is in its row's list. ``rows`` ascends."""
    wanted, offsets = _lists(lists)
    out = np.zeros(len(values), dtype=bool)
    bounds = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1], [True]])) if len(rows) else []
    for a, b in zip(bounds, bounds[1:], strict=False):
        row = first + int(rows[a])
        own = wanted[offsets[row] : offsets[row + 1]]
        if len(own):
            out[a:b] = np.isin(values[a:b], own)
    return out


def _extended(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for chunk in word_chunks(batch.column(1)):
                anchors, whole, row = _windows(chunk, length, anchor)
                asked = _member(anchors, row, batch.column(2), chunk.first_row)
                keys.append(whole[asked])
                owners.append(ids[chunk.first_row + row[asked]])
            yield fold(np.concatenate(keys), np.concatenate(owners))

    return run


def _covered(chunk, lists: pa.Array, length: int) -> np.ndarray:
    """Which words stand in a window of their row's list."""
    whole, inside = chunk.grams(length)
    starts = np.zeros(len(whole), dtype=bool)
    places = np.flatnonzero(inside)
    starts[places] = _member(whole[places], chunk.row_of_word()[places], lists, chunk.first_row)
    total = np.concatenate([np.zeros(length, dtype=np.int64), np.cumsum(starts)])
    return total[length:] > total[:-length]


_RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ("kept", pa.string()),
    ]
)


def _removal(length: int):
    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,spans:array<struct<first:bigint,last:bigint>>,kept:string>")
    def remove(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for chunk in word_chunks(texts):
            covered = _covered(chunk, lists, length)
            for i in range(chunk.rows):
                a, b = chunk.bounds[i], chunk.bounds[i + 1]
                words = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes().split()
                own, spans = covered[a:b], []
                if own.any():
                    words = list(compress(words, ~own))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                    spans = [{"first": int(x), "last": int(y) - 1} for x, y in zip(edges[::2], edges[1::2], strict=True)]
                out.append({"n_words": int(b - a), "n_removed": int(own.sum()), "spans": spans, "kept": b" ".join(words).decode()})
        return pa.array(out, type=_RESULT)

    return remove


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """All rows of ``docs`` plus a struct ``repeats`` (replacing a column of that name):
    ``n_words``, ``n_removed``, ``spans`` (first and last word of each run removed) and ``kept``
    (the other words, one space between them).

    A word is removed if it is in a window of ``length`` words that also starts in a document with
    a smaller id. Windows are judged on the input. Words stand between white space and compare as
    they are. NULL and empty texts have no words; documents shorter than a window lose nothing.
    Ids are whole numbers. Rows with the same id count as one document, so they take nothing from
    each other; rows with a NULL id neither lose words nor cause others to. Windows are compared
    by a 64-bit hash.
    """
    small_batches(docs.sparkSession, BATCH_BYTES)
    # Both joins below take the same columns of ``rows`` by the same key, which is never NULL, so
    # that the texts are shuffled once for both.
    own = F.col(id).cast("long")
    row = F.struct(*docs.drop("repeats").columns)
    rows = docs.select(F.coalesce(own, F.lit(NO_ID)).alias("__key"), row.alias("__row"))
    body = F.col("__row")[text]
    named = docs.select(own.alias("id"), F.col(text).alias("text")).filter(F.col("id").isNotNull())
    anchors = named.mapInArrow(_anchors(length, anchor), FOLDED)
    by = Window.partitionBy("key", "salt")
    shared = (
        anchors.withColumn(
            "shared",
            F.col("known") | F.max("known").over(by) | (F.min("id").over(by) < F.max("id").over(by)),
        )
        .filter("shared")
        .groupBy(F.col("id").alias("__key"))
        .agg(F.collect_set("key").alias("__anchors"))
    )
    windows = rows.join(shared, "__key").select("__key", body.alias("__text"), "__anchors", "__row")
    windows = windows.mapInArrow(_extended(length, anchor), FOLDED)
    repeated = (
        windows.withColumn("again", (F.col("salt") != 0) | (F.min("id").over(by) < F.col("id")))
        .filter("again")
        .groupBy(F.col("id").alias("__key"))
        .agg(F.collect_set("key").alias("__windows"))
    )
    none = F.array().cast("array<bigint>")
    removal = _removal(length)(body, F.coalesce("__windows", none))
    return rows.join(repeated, "__key", "left").select("__row.*", removal.alias("repeats"))
