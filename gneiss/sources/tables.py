"""Writers, and tables that readers only ever see whole.

A table is a folder of immutable parquet versions and batches of changes, with a small JSON list
of commits. A version or a batch counts once its commit row exists, so an interrupted write is
invisible and is simply written again. A commit row also holds the schema of what was written
and the high-water mark reached, so neither is searched in the data. One writer at a time.
"""

from __future__ import annotations

import json
import math
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gneiss.functions.values import day
from gneiss.operators.keys import key_list, latest_per_key, split_null_keys
from gneiss.operators.merge import merge_upsert
from gneiss.sources.config import check_cluster_by
from gneiss.sources.layout import curve_layout
from gneiss.sources.readers import list_files, read_if_any

COMMITS = "version BIGINT, through BIGINT, batch BIGINT, schema STRING, mark STRING, committed_at TIMESTAMP"
FILE_BYTES = 256 * 1024**2


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Compute a view in full, replace its stored result, and return the stored rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def todays_rows(df: DataFrame, as_of=None, column: str = "summary_date") -> DataFrame:
    return df.filter(F.col(column) == day(as_of))


def file_count(size: int, file_bytes: int = FILE_BYTES) -> int:
    """How many files of about ``file_bytes`` hold ``size`` bytes."""
    return max(1, math.ceil(size / file_bytes))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path, from their listing; contents are not read."""
    return list_files(spark, path, "*.parquet").agg(F.sum("size")).first()[0] or 0


def clustered(df: DataFrame, columns, files: int | None = None, checked: bool = True) -> DataFrame:
    """Rows laid out so that files hold narrow ranges of the clustering columns.

    Range partitioning samples the data, so a frequent value spreads over its share of
    files when further columns follow it. Parquet statistics then skip files.
    """
    columns = check_cluster_by(columns) if checked else list(columns)
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def zordered(df: DataFrame, columns, files: int) -> DataFrame:
    """Rows laid out along a Z curve over columns of any ordered type, so that files are narrow in each."""
    return curve_layout(df, columns, files)


def write_optimized(df: DataFrame, path: str, merge_keys, files: int | None = None) -> None:
    """A table rewritten along a Z curve over its merge keys, which filters and merges look for."""
    zordered(df, key_list(merge_keys), files or 1).write.mode("overwrite").parquet(path)


def write_clustered(df: DataFrame, path: str, cluster_by, merge_keys=(), files: int | None = None) -> None:
    """Full load in clustered layout; ``["auto"]`` clusters by the merge keys."""
    auto = list(cluster_by) == ["auto"]
    clustered(df, merge_keys if auto else cluster_by, files, not auto).write.mode("overwrite").parquet(path)


def compact(spark: SparkSession, path: str, target: str, cluster_by=(), file_bytes: int = FILE_BYTES) -> None:
    """Rewrite a table of many small files as files of about ``file_bytes``, into another folder.

    Without clustering the scan packs small files up to its partition size and every task
    writes one file, so no row is moved.
    """
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    if cluster_by:
        rows = clustered(rows, cluster_by, file_count(stored_bytes(spark, path), file_bytes))
    rows.write.mode("overwrite").parquet(target)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    return read_if_any(spark, "json", f"{path}/commits", COMMITS)


def current_commit(spark: SparkSession, path: str):
    """The last commit of a version: its row, or None."""
    commits = _commits(spark, path)
    return None if commits is None else commits.filter("version IS NOT NULL").orderBy(F.col("version").desc()).first()


def _commit(df: DataFrame, path: str, **values) -> None:
    """Add a commit row for what was written from ``df``."""
    row = {"version": None, "through": None, "batch": None, "mark": None, **values, "schema": df.schema.json()}
    kinds = T.StructType.fromDDL(COMMITS)
    columns = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in kinds if f.name != "committed_at"]
    added = df.sparkSession.range(1).select(*columns, F.current_timestamp().alias("committed_at"))
    added.coalesce(1).write.mode("append").json(f"{path}/commits")


def widen(known: T.StructType | None, schema: T.StructType) -> T.StructType:
    """The known columns, and after them those that are new."""
    if known is None:
        return schema
    return T.StructType([*known.fields, *[f for f in schema.fields if f.name not in known.names]])


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """All columns the table ever had, without the mark of deletes; None before the first commit.

    Commit rows of one schema count once, so the driver reads a row for each change of the schema.
    """
    commits = _commits(spark, path)
    if commits is None:
        return None
    kept = commits.groupBy("schema").agg(F.min("committed_at").alias("at")).orderBy("at").collect()
    known: T.StructType | None = None
    for row in kept:
        known = widen(known, T.StructType([f for f in T.StructType.fromJson(json.loads(row["schema"])) if f.name != "_deleted"]))
    return known


def high_water_mark(spark: SparkSession, path: str) -> str | None:
    """The mark of the last commit that has one, as text."""
    commits = _commits(spark, path)
    last = None if commits is None else commits.filter("mark IS NOT NULL").orderBy(F.col("committed_at").desc()).first()
    return last["mark"] if last else None


def write_full(df: DataFrame, path: str, through: int | None = None, mark: str | None = None) -> int:
    """Write the whole table as a new version, then make it the current one."""
    last = current_commit(df.sparkSession, path)
    version = last["version"] + 1 if last else 1
    df.write.mode("overwrite").parquet(f"{path}/version-{version}")
    _commit(df, path, version=version, through=through, mark=mark)
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """A version of the table, the current one by default; None before the first."""
    if version is None:
        last = current_commit(spark, path)
        if last is None:
            return None
        version = last["version"]
    return spark.read.parquet(f"{path}/version-{version}")


def write_changes(batch: DataFrame, path: str, batch_id: int, mark_column: str | None = None) -> None:
    """Store a batch of row states beside the current version, then commit it.

    A batch replaces itself when it is replayed. The cost follows the batch, not the
    table: no stored row is rewritten until ``fold_changes``. The greatest value of
    ``mark_column`` so far is kept with the commit.
    """
    spark, folder = batch.sparkSession, f"{path}/changes/batch_id={batch_id}"
    batch.write.mode("overwrite").parquet(folder)
    mark = high_water_mark(spark, path)
    if mark_column:
        kind = batch.schema[mark_column].dataType
        reached = F.greatest(F.max(mark_column), F.lit(mark).cast(kind)).cast("string")
        mark = spark.read.schema(batch.schema).parquet(folder).agg(reached).first()[0]
    _commit(batch, path, batch=batch_id, mark=mark)


def read_merged(spark: SparkSession, path: str, keys, schema=None, sequence_by: str | None = None) -> DataFrame:
    """The table with all later batches applied: the winning state of every key.

    With ``sequence_by`` a state wins by a strictly greater sequence, so of equal ones the
    earlier batch stays; a missing sequence is the lowest. Without it the later batch wins.
    Rows marked ``_deleted`` hide their key. The columns are those the table ever had, and
    those of ``schema``; a batch without a column leaves the stored values of it.
    """
    merged = _merged(spark, path, keys, schema, sequence_by)
    return merged.filter(~F.coalesce("_deleted", F.lit(False))).drop("_deleted")


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the committed batches after the current version, with all columns the table ever had."""
    known, batches = table_schema(spark, path), _batches(spark, path, _folded(current_commit(spark, path)))
    folders = [f"{path}/changes/batch_id={number}" for number, _ in batches]
    return spark.read.schema(known).parquet(*folders) if folders else spark.createDataFrame([], known)


def _stored(schema) -> T.StructType:
    fields = [f for f in schema.fields if f.name != "_deleted"]
    return T.StructType([*fields, T.StructField("_deleted", T.BooleanType())])


def _batches(spark: SparkSession, path: str, since: int) -> list[tuple[int, tuple[str, ...]]]:
    """Committed batches after the folded ones, with their columns; one small row each."""
    commits = _commits(spark, path)
    if commits is None:
        return []
    kept = commits.filter(F.col("batch") > since).groupBy("batch").agg(F.max_by("schema", "committed_at").alias("schema")).orderBy("batch")
    return [(r["batch"], tuple(T.StructType.fromJson(json.loads(r["schema"])).names)) for r in kept.collect()]


def _folded(commit) -> int:
    return commit["through"] if commit and commit["through"] is not None else -1


def _merged(spark, path, keys, schema, sequence_by) -> DataFrame:
    """The current version merged with the winners among later batches, marks included.

    Only the batches are reduced by key. The version holds a key once already and is the
    outer side of a join, so it stays where it is while the batches are small. Batches in a
    row that have the same columns are merged together, and folded ones are not listed.
    """
    known = table_schema(spark, path)
    stored, last = _stored(widen(known, schema) if schema is not None else known), current_commit(spark, path)
    base = spark.read.schema(stored).parquet(f"{path}/version-{last['version']}") if last else None
    for columns, run in groupby(_batches(spark, path, _folded(last)), key=lambda b: b[1]):
        fields = [f for f in stored.fields if f.name in columns]
        tagged = T.StructType([*fields, T.StructField("batch_id", T.LongType())])
        folders = [f"{path}/changes/batch_id={number}" for number, _ in run]
        changes = spark.read.schema(tagged).option("basePath", f"{path}/changes").parquet(*folders)
        batch = F.col("batch_id")
        order = [batch.desc()] if sequence_by is None else [F.col(sequence_by).desc_nulls_last(), batch.asc()]
        keyed, unkeyed = split_null_keys(changes, keys)
        winners = latest_per_key(keyed, keys, order).unionByName(unkeyed).drop("batch_id")
        if base is None:
            base = winners.select(*[F.col(f.name) if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name) for f in stored.fields])
        else:
            marked = winners if "_deleted" in columns else winners.withColumn("_deleted", F.lit(None).cast("boolean"))
            base = merge_upsert(base, marked, keys, newer_by=sequence_by, check_duplicates=False, nulls_oldest=True)
    return spark.createDataFrame([], stored) if base is None else base


def last_batch(spark: SparkSession, path: str, schema=None) -> int:
    """The highest committed batch, folded or not; -1 before the first."""
    folded, commits = _folded(current_commit(spark, path)), _commits(spark, path)
    newest = None if commits is None else commits.agg(F.max("batch")).first()[0]
    return folded if newest is None else max(folded, newest)


def fold_changes(spark: SparkSession, path: str, keys, schema=None, sequence_by: str | None = None) -> int:
    """Write the merged table as a new version, so that reads start from it.

    Marks of deleted keys are kept, so a late change still cannot bring a key back.
    """
    through = last_batch(spark, path)
    return write_full(_merged(spark, path, keys, schema, sequence_by), path, through, high_water_mark(spark, path))
