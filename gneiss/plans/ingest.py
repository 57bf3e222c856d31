"""Config-driven loads: source, high-water mark or replay cutoff, merge or full rewrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.operators.merge import incremental_filter, require_unique
from gneiss.sources import tables
from gneiss.sources.config import ConfigError, TableConfig, parse_flag
from gneiss.sources.readers import read_source


def target_rows(spark: SparkSession, config: TableConfig, schema=None) -> DataFrame:
    """The target of a configured load as it stands, empty before the first load."""
    return tables.read_merged(spark, config.target, config.target_merge_columns, schema)


def ingest(
    spark: SparkSession,
    config: TableConfig,
    incremental=True,
    cutoff=None,
    transform=None,
    stage_path: str | None = None,
    allow_partial_overwrite: bool = False,
) -> DataFrame:
    """Load a configured table and return its target.

    A cutoff overrides the high-water mark, which is kept with the commits. An incremental load
    stores only the rows it read and merges them when the table is read or folded. Columns the
    source no longer has keep their stored values, new ones are added. A full load replaces
    the table; with a cutoff it would keep just the rows after it, so that has to be asked for.
    """
    incremental = parse_flag(incremental)
    if not incremental and cutoff and not allow_partial_overwrite:
        raise ConfigError("a full load with a cutoff drops older rows; set allow_partial_overwrite")
    source = read_source(spark, config)
    if transform is not None:
        source = transform(source)
    schema, keys = source.schema, list(config.target_merge_columns)
    column, mark_column = config.source_incremental_column, config.target_incremental_column or config.source_incremental_column
    if cutoff or incremental:
        mark = tables.high_water_mark(spark, config.target) if incremental else None
        source = incremental_filter(source, column, mark, cutoff)
    if stage_path:
        source = tables.materialize(source, stage_path)
    batch = tables.last_batch(spark, config.target) + 1
    if incremental:
        tables.write_changes(require_unique(source, keys), config.target, batch, mark_column)
    else:
        if config.cluster_by:
            auto = config.cluster_by == ("auto",)
            source = tables.clustered(source, keys if auto else list(config.cluster_by), checked=not auto)
        mark = source.agg(F.max(mark_column).cast("string")).first()[0]
        tables.write_full(source, config.target, through=batch, mark=mark)
    return target_rows(spark, config, schema)
