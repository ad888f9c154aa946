"""Settings for what is sent to Python workers, and the memory they keep."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Arrow batches of texts of at most about ``size`` bytes, so that a worker's memory is
    bounded by that or by the longest text, not by a number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def give_back() -> None:
    """Return freed memory to the system. Workers live on from one stage to the next, and what they
    have freed but kept would count on top of what the next stage needs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def thrifty(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A function over batches that gives its memory back after each result and at its end."""

    @wraps(run)
    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            del out
            give_back()
        give_back()

    return running
