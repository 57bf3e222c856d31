"""Starting and watching streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

AVAILABLE_NOW = {"availableNow": True}


def run_stream_append(
    df: DataFrame, path: str | None, checkpoint: str, trigger=None, name=None, fmt="parquet", mode="append", **options
) -> StreamingQuery:
    """Append a stream to a folder; ``fmt="console"`` or ``"memory"`` serve debugging.

    The default trigger takes what is available and stops.
    """
    writer = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    writer = writer.trigger(**(trigger or AVAILABLE_NOW))
    if name:
        writer = writer.queryName(name)
    return writer.start(path) if path else writer.start()


def run_stream_batches(
    df: DataFrame, handle, checkpoint: str, trigger=None, name=None, mode="append"
) -> StreamingQuery:
    """Hand every micro-batch to ``handle(batch, batch_id)``.

    Spark may replay the last batch after a failure with the same id, so a handler writes
    under that id (see ``batches.write_batch``) and a replay replaces its own output.
    """
    writer = df.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or AVAILABLE_NOW))
    if name:
        writer = writer.queryName(name)
    return writer.start()


def append_flow(source: DataFrame, transform, path: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """A transformed stream appended to a sink."""
    return run_stream_append(transform(source), path, checkpoint, trigger)


def wait(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for a query to end and pass on its failure; False when the time is over."""
    done = query.awaitTermination(timeout) if timeout else (query.awaitTermination() or True)
    return bool(done)


def find_active(spark: SparkSession, name: str) -> StreamingQuery | None:
    return next((q for q in spark.streams.active if q.name == name), None)


def stop_active(spark: SparkSession, name: str) -> bool:
    query = find_active(spark, name)
    if query is not None:
        query.stop()
    return query is not None
