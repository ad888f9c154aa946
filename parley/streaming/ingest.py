"""Continuous ingest: the batch cleaner over a stream, restartable at any point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from parley.operators.clean import clean_records
from parley.sources.tables import CSV


def _available(writer: DataStreamWriter, checkpoint: str, continuous: str | None) -> DataStreamWriter:
    """All input present now, or a new batch every ``continuous`` interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)


def stream_ingest(
    raw: DataFrame, path: str, checkpoint: str, continuous: str | None = None, **options
) -> StreamingQuery:
    """Clean a stream of raw records into Parquet, each record exactly once."""
    writer = clean_records(raw, **options).writeStream.format("parquet").option("path", path)
    return _available(writer, checkpoint, continuous).start()


def once(rows: DataFrame, key: str = "id", within: str = "30 days") -> DataFrame:
    """Each key of a stream once, the first row that arrives: files delivered again, under whatever
    name and after whatever restart, add nothing.

    The state store holds one entry per key for the time ``within`` after its arrival. Arrival, not
    the rows' own time, moves the watermark, so no row is ever dropped for being late. Keys seen
    again later than that pass; :func:`skip_done` compares with all that is written. Rows
    without a key are the same only if all their columns are (maps excepted). For many keys choose the
    state store on disk (``spark.sql.streaming.stateStore.providerClass``).
    """
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    whole = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in plain]), {"ignoreNullFields": "false"}), 256)
    marked = rows.withColumns({"__arrived": F.current_timestamp(), "__row": F.when(F.col(key).isNull(), whole)})
    marked = marked.withWatermark("__arrived", within).dropDuplicatesWithinWatermark([key, "__row"])
    return marked.drop("__arrived", "__row")


def stream_batches(
    rows: DataFrame, path: str, checkpoint: str, continuous: str | None = None
) -> StreamingQuery:
    """Write each micro-batch to its own folder ``batch=<n>``; a batch run twice replaces itself."""

    def flush(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _available(rows.writeStream.foreachBatch(flush), checkpoint, continuous).start()


def stream_csv(
    rows: DataFrame, path: str, checkpoint: str, continuous: str | None = None
) -> StreamingQuery:
    """Append rows as CSV files with headers; used for annotations."""
    writer = rows.writeStream.format("csv").options(path=path, **CSV)
    return _available(writer, checkpoint, continuous).start()


def skip_done(source: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key has not been processed yet: the batch form of resuming."""
    return source.join(done.select(key).distinct(), key, "left_anti")


def progress(query: StreamingQuery) -> dict[str, float]:
    """Rows read, batches and the latest rate over the reports that the query still keeps, by default
    the last hundred; :class:`parley.streaming.watch.Watch` adds up all of them."""
    updates = query.recentProgress
    return {
        "batches": len(updates),
        "rows": sum(u["numInputRows"] for u in updates),
        "rows_per_second": updates[-1]["processedRowsPerSecond"] if updates else 0.0,
    }


def finish(query: StreamingQuery, seconds: int | None = None) -> StreamingQuery:
    """Wait for a query over the available input, however long that takes; with ``seconds`` raise if
    it does not end in time."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream still running after {seconds} s")
    return query
