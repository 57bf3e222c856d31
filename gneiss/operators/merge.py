"""Upserts and incremental reads over tables that have no MERGE statement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.operators.keys import duplicate_keys, key_list, split_null_keys

SHOWN_KEYS = 20


class DuplicateSourceKeys(ValueError):
    """Several source rows claim the same target row."""


def merge_columns(keys, df: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """Columns to match on, to update and to insert."""
    names = key_list(keys)
    missing = [k for k in names if k not in df.columns]
    if missing:
        raise ValueError(f"key columns not in the data: {missing}")
    return names, [c for c in df.columns if c not in names], df.columns


def require_unique(df: DataFrame, keys) -> DataFrame:
    """Raise, naming some keys, when a complete key occurs more than once."""
    names = key_list(keys)
    repeated = duplicate_keys(split_null_keys(df, names)[0], names).limit(SHOWN_KEYS).collect()
    if repeated:
        shown = [tuple(row[k] for k in names) for row in repeated]
        raise DuplicateSourceKeys(f"several source rows for keys {names}: {shown}")
    return df


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys,
    newer_by: str | None = None,
    update_columns=None,
    check_duplicates: bool = True,
    nulls_oldest: bool = False,
) -> DataFrame:
    """The target after matched rows are updated and the others inserted.

    Keys compare with ``=``, so a NULL key never matches. With ``newer_by`` a match is
    updated only where the source value is strictly greater; a NULL on either side keeps
    the target, unless ``nulls_oldest`` ranks NULL below all values. Columns the source
    lacks stay untouched on update and are NULL on insert.

    The target is the outer side of a join on unique source keys: a small source is
    broadcast by Spark without moving the target, a large one is joined by key, and a
    target key with very many rows, NULL included, can be split by adaptive execution.
    """
    names, _, _ = merge_columns(keys, source)
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"source columns not in the target: {extra}")
    if check_duplicates:
        require_unique(source, names)
    allowed = [c for c in source.columns if c not in names]
    updates = allowed if update_columns is None else [c for c in update_columns if c in allowed]

    plain = newer_by is None and set(source.columns) == set(target.columns) and set(updates) == set(allowed)
    if plain:
        kept = target.join(source.select(*names), names, "left_anti")
        return kept.unionByName(source).select(*target.columns)

    carried = list(dict.fromkeys([*updates, *([newer_by] if newer_by else [])]))
    fresh = source.select(
        *[F.col(k).alias(f"_source_{k}") for k in names], F.struct(*carried, F.lit(True).alias("_hit")).alias("_source")
    )
    wins: Column = F.col("_source").isNotNull()
    if newer_by:
        fresh_value, held = F.col(f"_source.{newer_by}"), F.col(newer_by)
        newer = fresh_value > held
        wins = wins & (newer | (held.isNull() & fresh_value.isNotNull()) if nulls_oldest else newer)
    joined = target.join(fresh, _same(target, fresh, names), "left").withColumn("_wins", F.coalesce(wins, F.lit(False)))
    updated = joined.select(
        *[
            F.when(F.col("_wins"), F.col(f"_source.{c}")).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
            for c in target.columns
        ]
    )
    # Keys the target already holds: reduced to the source's keys before anything is shuffled.
    present = target.select(*names).join(source.select(*names), names, "left_semi").distinct()
    inserted = source.join(present, names, "left_anti")
    return updated.unionByName(inserted, allowMissingColumns=True).select(*target.columns)


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k] == right[f"_source_{k}"] for k in names])


def incremental_filter(source: DataFrame, source_column: str, mark=None, cutoff=None) -> DataFrame:
    """Source rows not older than the high-water mark, or than ``cutoff`` if given.

    Without either the whole source is taken. Both are literals of the column's type, so the
    comparison reaches the source scan.
    """
    since = mark if cutoff in (None, "") else cutoff
    if since is None:
        return source
    return source.filter(F.col(source_column) >= F.lit(since).cast(source.schema[source_column].dataType))


def high_water_mark(target: DataFrame | None, column: str):
    """The greatest value of a column, for targets that keep no mark; None while it is empty."""
    return None if target is None else target.agg(F.max(column)).first()[0]
