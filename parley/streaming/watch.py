"""Totals of running streams, added up batch by batch.

A query keeps only its latest progress reports. The listener here adds each one up as it comes,
together with the metrics that the stream's plan observes, so nothing is lost however many batches
there are, and asking costs no job.
"""

from __future__ import annotations

import threading
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class Totals:
    """Batches, rows read, the latest rate, and observed counts as ``"<name>.<metric>"``."""

    batches: int = 0
    rows: int = 0
    rows_per_second: float = 0.0
    observed: Counter = field(default_factory=Counter)
    last_batch: int = -1
    error: str | None = None
    ended: threading.Event = field(default_factory=threading.Event, repr=False)


class Watch(StreamingQueryListener):
    """Use as a context: ``with Watch(spark) as watch: … watch.totals(query)``. One watch sees all
    queries of its session; each run of a query has totals of its own."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._lock = threading.Lock()
        self._runs: dict[str, Totals] = {}

    def __enter__(self) -> Watch:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)

    def _of(self, run) -> Totals:
        return self._runs.setdefault(str(run), Totals())

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._of(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            totals = self._of(progress.runId)
            if progress.batchId == totals.last_batch:
                return
            totals.last_batch = progress.batchId
            totals.batches += 1
            totals.rows += progress.numInputRows
            totals.rows_per_second = progress.processedRowsPerSecond
            for name, metrics in progress.observedMetrics.items():
                for metric, value in metrics.asDict().items():
                    totals.observed[f"{name}.{metric}"] += value or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            totals = self._of(event.runId)
            totals.error = event.exception
        totals.ended.set()

    def totals(self, query: StreamingQuery, seconds: float = 60.0) -> Totals:
        """Of a query that runs: the totals so far. Of one that has ended: all of them, once the
        reports under way have arrived; raises if these take longer than ``seconds``."""
        with self._lock:
            totals = self._of(query.runId)
        if not query.isActive and not totals.ended.wait(seconds):
            raise TimeoutError("the last reports of the query have not arrived")
        return totals


def observed(df: DataFrame, name: str) -> DataFrame:
    """The stream, with its rows counted as ``<name>.rows`` while they pass."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))
