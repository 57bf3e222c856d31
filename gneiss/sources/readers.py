"""Batch and stream readers."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameReader

from gneiss.functions.values import byte_count
from gneiss.sources.config import TableConfig


def read_source(spark: SparkSession, config: TableConfig) -> DataFrame:
    """The source of a configured load. Filters and columns reach every one of these scans."""
    if config.kind == "table":
        return spark.table(config.source_table)
    if config.kind == "parquet":
        return spark.read.options(**config.options).parquet(config.source_table)
    if config.kind == "jdbc":
        return jdbc_reader(spark, **config.options).option("dbtable", config.source_table).load()
    options = dict(config.options)
    return spark.read.format(options.pop("format")).options(dbtable=config.source_table, **options).load()


def jdbc_reader(
    spark: SparkSession, url: str, partition_column=None, lower=None, upper=None, num_partitions=None, single_task=False, **properties
) -> DataFrameReader:
    """A JDBC reader that reads a table by many tasks at once, split by a column.

    The bounds only place the cuts between tasks, they filter nothing. ``single_task=True``
    says that one task may read it all, as for a small table; without it the split is required.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    split = {"partitionColumn": partition_column, "lowerBound": lower, "upperBound": upper, "numPartitions": num_partitions}
    given = [name for name, value in split.items() if value is not None]
    if len(given) < len(split) and (given or not single_task):
        raise ValueError(f"a split read needs all of {list(split)}; single_task=True reads without a split")
    return reader.options(**split) if given else reader


def stream_files(
    spark: SparkSession, path: str, fmt: str, schema, glob=None, max_files=None, max_bytes=None, **options
) -> DataFrame:
    """New files below a path as a stream, rate limited per micro-batch if asked.

    Spark takes one of the two limits; ``max_bytes`` may be written like ``2mb``.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("give max_files or max_bytes, not both")
    limits = {"pathGlobFilter": glob, "maxFilesPerTrigger": max_files, "maxBytesPerTrigger": byte_count(max_bytes)}
    reader = spark.readStream.format(fmt).schema(schema).option("ignoreMissingFiles", "true").options(**options)
    return reader.options(**{k: str(v) for k, v in limits.items() if v is not None}).load(path)


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Lineage columns from the hidden metadata of file sources."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
    )


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files below a path with name, path, size and time. Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modification_time"),
    )


def csv_headers(spark: SparkSession, paths, **options) -> DataFrame:
    """The first line of every CSV file: (file_path, header). Files without a line are left out.

    A file's rows come in order within a split, and the split at offset 0 has the first one.
    """
    lines = spark.read.options(**options).text(paths).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("at"))
    return lines.filter("offset = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("header"))


def _csv_groups(spark: SparkSession, paths, limits: dict, options: dict) -> list[DataFrame]:
    """A frame for all files of the same header, named by it; the driver holds the file names."""
    groups = csv_headers(spark, paths, **limits).groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    return [spark.read.options(**{**options, "header": "true"}).csv(r["files"]) for r in groups.orderBy("header").collect()]


def read_csv_by_header(spark: SparkSession, paths, schema: T.StructType, **options) -> DataFrame:
    """CSV files whose columns may differ in number and order, each read by its own header.

    Columns of the schema that a file lacks are NULL, values that don't fit their type too; a
    file's other columns are left out. The file's name is in ``file_name``.
    """
    parts = []
    for part in _csv_groups(spark, paths, {}, {**options, "inferSchema": "false"}):
        columns = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in part.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
        parts.append(part.select(*columns, F.col("_metadata.file_name").alias("file_name")))
    empty = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("file_name", T.StringType())]))
    return reduce(DataFrame.unionByName, parts, empty)


def stream_file_names(spark: SparkSession, path: str, glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """The paths of new files as a stream; their contents are not read."""
    limits = {"pathGlobFilter": glob, "maxFilesPerTrigger": max_files}
    reader = spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY").options(**{k: str(v) for k, v in limits.items() if v is not None})
    return reader.load(path).select("path")


SCHEMAS = "stored_at TIMESTAMP, schema STRING"


def resolve_schema(
    spark: SparkSession, path: str, fmt: str, schema_location: str, overlap: str = "1 minute", **options
) -> T.StructType:
    """The stored schema widened by columns that new files bring, and stored again.

    Known columns keep their stored type. A stream started with the result picks new
    columns up at its next start. Only files changed since the last look are inferred
    from, with some overlap for clocks that differ, so the cost follows what is new. CSV
    takes its names from the headers of all of them; read such files with ``read_csv_by_header``.
    """
    last = _last_schema(spark, schema_location, overlap)
    limits = {"modifiedAfter": last["since"]} if last else {}
    try:
        if fmt == "csv" and str(options.get("header")).lower() == "true":
            found = [part.schema for part in _csv_groups(spark, path, limits, options)]
        else:
            found = [spark.read.format(fmt).options(**options, **limits).load(path).schema]
        seen = [f for schema in found for f in schema.fields]
    except AnalysisException as error:
        if not last or error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        seen = []
    stored = T.StructType.fromJson(json.loads(last["schema"])).fields if last else []
    merged = T.StructType(list({f.name: f for f in [*reversed(seen), *reversed(stored)]}.values())[::-1])
    row = spark.range(1).select(F.current_timestamp().alias("stored_at"), F.lit(merged.json()).alias("schema"))
    row.coalesce(1).write.mode("append").json(schema_location)
    return merged


def stored_schema(spark: SparkSession, schema_location: str) -> T.StructType | None:
    """The schema stored last."""
    last = _last_schema(spark, schema_location, "0 seconds")
    return T.StructType.fromJson(json.loads(last["schema"])) if last else None


def _last_schema(spark: SparkSession, schema_location: str, overlap: str):
    kept = read_if_any(spark, "json", schema_location, SCHEMAS)
    if kept is None:
        return None
    since = F.date_format(F.col("stored_at") - F.expr(f"INTERVAL {overlap}"), "yyyy-MM-dd'T'HH:mm:ss")
    return kept.select("stored_at", "schema", since.alias("since")).orderBy(F.col("stored_at").desc()).first()


def read_if_any(spark: SparkSession, fmt: str, path: str, schema) -> DataFrame | None:
    """The dataset at a path, or None while nothing was written there."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
