"""Passages of many words that stand in several documents, cut at all their places.

Windows of ``LENGTH`` words are found as in :mod:`parley.llm.substrings`: by anchors first, then the
windows around shared ones. Only texts that have something to compare or to lose move; they are told
apart where they lie by bounded filters over ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.arrow import give_back, small_batches, thrifty
from parley.llm.key_filter import in_filter
from parley.llm.ordered_minhash import asked_for, id_filter
from parley.llm.store import stored
from parley.llm.substrings import BATCH_BYTES, FOLDED, _anchors, _covered, _extended
from parley.llm.words import word_chunks

LENGTH = 51
ANCHOR = 16  # words


def _cut(length: int):
    @F.arrow_udf("struct<n_removed:bigint,kept:string>")
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        removed, kept = [], []
        for chunk in word_chunks(texts):
            covered = _covered(chunk, lists, length)
            for i in range(chunk.rows):
                a, b = chunk.bounds[i], chunk.bounds[i + 1]
                own = covered[a:b]
                edges = a + np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                at, parts = chunk.offsets[i], []
                for first, last in zip(edges[::2], edges[1::2] - 1, strict=True):
                    parts.append(chunk.data[at : chunk.starts[first]].tobytes())
                    at = chunk.ends[last]
                parts.append(chunk.data[at : chunk.offsets[i + 1]].tobytes())
                removed.append(int(own.sum()))
                kept.append(b"".join(parts).decode())
        result = pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["n_removed", "kept"])
        del removed, kept
        give_back()
        return result

    return cut


def cut_passages(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """The rows of ``docs`` without the words of their texts that are in a window of ``length`` words
    which also stands in another row. All such places lose it; what is between and around the words
    that stay is as it was. Rows that lose all their words go.

    Words stand between white space and compare as they are; windows compare by a 64-bit hash and
    are judged on the input. Rows are numbered in a written table; ids are not read.
    """
    small_batches(docs.sparkSession, BATCH_BYTES)
    rows = stored(docs.select(F.monotonically_increasing_id().alias("id"), F.struct(*docs.columns).alias("row")), "passages")
    texts = rows.select("id", F.col("row")[text].alias("text"))
    by = Window.partitionBy("key", "salt")

    def several(found: DataFrame, name: str) -> DataFrame:
        again = F.col("known") | F.max("known").over(by) | (F.min("id").over(by) < F.max("id").over(by))
        found = found.withColumn("again", again).filter("again")
        return stored(found.groupBy("id").agg(F.collect_set("key").alias(name)), name)

    anchors = several(texts.mapInArrow(thrifty(_anchors(length, anchor)), FOLDED), "anchors")
    near = asked_for(texts, anchors.select("id")).join(anchors, "id").select("id", "text", "anchors")
    windows = several(near.mapInArrow(thrifty(_extended(length, anchor)), FOLDED), "windows")
    words = id_filter(windows.select("id"))

    @F.arrow_udf("boolean")
    def there(keys: pa.Array) -> pa.Array:
        return pa.array(in_filter(keys.to_numpy().view(np.uint64), words.value))

    rows = rows.withColumn("there", there(F.xxhash64("id")))
    found = rows.filter("there").join(windows, "id", "left")
    none = F.array().cast("array<bigint>")
    found = found.select("row", _cut(length)(F.col("row")[text], F.coalesce("windows", none)).alias("cut"))
    found = found.filter((F.col("cut.n_removed") == 0) | F.col("cut.kept").rlike("[^\\x20\\x09-\\x0D]"))
    body = F.when(F.col("cut.n_removed") > 0, F.col("cut.kept")).otherwise(F.col("row")[text])
    found = found.select(*[(body if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    return found.union(rows.filter(~F.col("there")).select("row.*"))
