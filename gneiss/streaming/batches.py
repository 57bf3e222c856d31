"""What a stream has written: a folder per micro-batch, and the newest state of every key among them.

Progress is the stream's checkpoint and nothing else. A batch's folder carries its id, so a replayed batch
replaces itself. Reading is one scan of all folders and one row kept per key, whatever the number of batches; the
driver holds no list of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gneiss.operators.keys import key_list, latest_per_key, split_null_keys

BATCH = "batch_id"


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Store a micro-batch; its cost follows the batch alone."""
    batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows with their batch's id and, unless a schema is given, all columns that any batch has."""
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    wanted = T.StructType([*[f for f in schema.fields if f.name != BATCH], T.StructField(BATCH, T.LongType())])
    return spark.read.schema(wanted).parquet(path)


def newest(rows: DataFrame, keys, sequence_by: str | None = None) -> DataFrame:
    """The state of every key: the highest sequence, of equal ones the earlier batch; without a sequence the last batch.

    A row limit per key comes before the shuffle, so a key with many states sends one row from each task. Rows
    without a complete key match nothing and all stay.
    """
    order = [F.col(BATCH).desc()] if sequence_by is None else [F.col(sequence_by).desc_nulls_last(), F.col(BATCH).asc()]
    keyed, unkeyed = split_null_keys(rows, key_list(keys))
    return latest_per_key(keyed, keys, order).unionByName(unkeyed)


def read_newest(spark: SparkSession, path: str, keys, sequence_by: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The table a merge stream has built: the newest state of every key, without keys whose state is a delete."""
    rows = newest(read_batches(spark, path, schema), keys, sequence_by)
    alive = rows.filter(~F.coalesce("_deleted", F.lit(False))) if "_deleted" in rows.columns else rows
    return alive.drop("_deleted", BATCH)


def fold_batches(spark: SparkSession, path: str, target: str, keys, sequence_by: str | None = None) -> None:
    """The newest states, deletes included, as the first batch of another folder, for a stream to go on in.

    Ids of batches go on rising, so the folded rows, as batch -1, are the earliest.
    """
    write_batch(newest(read_batches(spark, path), keys, sequence_by).drop(BATCH), target, -1)
