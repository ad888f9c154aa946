"""A Bloom filter of bounded size over 64-bit keys, gathered on the executors and sent to all workers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 27  # at the most: 16 MB on the driver and on each worker


def _positions(key, bits: int) -> list:
    """The two places of a key in a filter of ``bits`` bits."""
    return [key.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(bits - 1))]


def key_filter(keys: DataFrame, bits_per_key: int) -> np.ndarray:
    """A Bloom filter over the column ``key``, gathered as words of 64 bits."""
    n = keys.count()
    bits = min(FILTER_BITS, max(1 << 16, 1 << (bits_per_key * n).bit_length()))
    at = F.explode(F.array(*_positions(F.col("key"), bits))).alias("at")
    words = keys.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(bits >> 6, dtype=np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def in_filter(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    last = np.uint64(len(words) * 64 - 1)
    hit = np.ones(len(keys), dtype=bool)
    for at in (keys & last, (keys >> np.uint64(32)) & last):
        hit &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return hit
