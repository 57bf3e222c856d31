"""Streams merged into tables by key.

Each micro-batch is reduced to one state per key and stored under its batch id. Its cost
follows the batch; the table is not rewritten per batch. ``batches.read_newest`` takes the winning
state of every key, and ``batches.fold_batches`` shortens what a read has to go through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gneiss.operators.changes import newest_changes
from gneiss.operators.keys import key_list, latest_per_key
from gneiss.streaming.batches import write_batch
from gneiss.streaming.runner import run_stream_batches


def stream_append_batches(stream: DataFrame, transform, path: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """Transform every micro-batch and append it; a replayed batch replaces itself."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return run_stream_batches(stream, handle, checkpoint, trigger)


def stream_merge(
    stream: DataFrame, path: str, keys, sequence_by: str, checkpoint: str, transform=None, order_by=(), trigger=None
) -> StreamingQuery:
    """Conditional merge: a state replaces the stored one if its sequence is greater.

    ``order_by`` breaks ties of the sequence within a batch.
    """
    names = key_list(keys)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows = latest_per_key(rows, names, [F.col(sequence_by).desc_nulls_last(), *order_by])
        write_batch(rows, path, batch_id)

    return run_stream_batches(stream, handle, checkpoint, trigger)


def stream_scd1(
    stream: DataFrame,
    path: str,
    keys,
    sequence_by: str,
    checkpoint: str,
    apply_as_deletes: Column | str | None = None,
    except_columns=(),
    trigger=None,
) -> StreamingQuery:
    """Keep the last state of every key of a change stream, deletes included.

    A delete is stored as a mark with its sequence, so a late change cannot revive the key.
    """
    names = key_list(keys)
    gone = F.expr(apply_as_deletes) if isinstance(apply_as_deletes, str) else apply_as_deletes

    def handle(batch: DataFrame, batch_id: int) -> None:
        newest = newest_changes(batch, names, sequence_by)
        mark = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
        write_batch(newest.withColumn("_deleted", mark).drop(*except_columns), path, batch_id)

    return run_stream_batches(stream, handle, checkpoint, trigger)
