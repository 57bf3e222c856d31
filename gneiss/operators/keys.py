"""Operators on keys: latest row, uniqueness, references, skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_list(keys) -> list[str]:
    """Keys given as a list or as text separated by commas."""
    names = keys.split(",") if isinstance(keys, str) else list(keys)
    names = [name.strip() for name in names]
    if not names or not all(names):
        raise ValueError("at least one key column is needed")
    return names


def has_null_key(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key_list(keys)])


def split_null_keys(df: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and rows that can match nothing.

    Rows without a key never join, yet would all hash to one shuffle partition; keeping
    them out of the join keeps that partition small.
    """
    missing = has_null_key(keys)
    return df.filter(~missing), df.filter(missing)


def latest_per_key(df: DataFrame, keys, order_by) -> DataFrame:
    """The first row of every key under a total order.

    ``row_number() = 1`` lets Spark put a group limit in front of the shuffle, so a key
    holding a large share of the table sends one row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(*key_list(keys)).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row, with their count."""
    return df.groupBy(*key_list(keys)).agg(F.count("*").alias("record_count")).filter("record_count > 1")


def check_primary_key(df: DataFrame, keys) -> DataFrame:
    """Violations of a declared primary key: repeated keys and keys with a NULL part."""
    names = key_list(keys)
    counted = df.groupBy(*names).agg(F.count("*").alias("record_count"))
    return counted.filter((F.col("record_count") > 1) | has_null_key(names))


def check_foreign_key(child: DataFrame, parent: DataFrame, columns) -> DataFrame:
    """Child rows whose reference is missing from the parent.

    ``columns`` maps child columns to parent columns, or lists names common to both.
    A NULL reference is allowed, as in SQL. The parent is reduced to its keys first.
    """
    pairs = columns if isinstance(columns, dict) else {c: c for c in key_list(columns)}
    complete, _ = split_null_keys(child, list(pairs))
    wanted = parent.select(*[F.col(p).alias(f"_parent_{p}") for p in pairs.values()])
    same = reduce(lambda a, b: a & b, [complete[c] == wanted[f"_parent_{p}"] for c, p in pairs.items()])
    return complete.join(wanted, same, "left_anti")


def dimension_keys(df: DataFrame, key: str, predicate=None, limit: int | None = None) -> DataFrame:
    """Distinct keys of a filtered dimension, as a DataFrame."""
    rows = df if predicate is None else df.filter(predicate)
    keys = rows.select(key).distinct()
    return keys if limit is None else keys.orderBy(key).limit(limit)


def key_skew(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent keys with their share of all rows and ratio to the mean.

    The totals come from the per-key counts through a scalar subquery, so no second pass
    over rows and no single-task window is needed.
    """
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("record_count"))
    total = counts.agg(F.sum("record_count").alias("total")).scalar()
    mean = counts.agg(F.avg("record_count").alias("mean")).scalar()
    return (
        counts.select(
            "key",
            "record_count",
            (F.col("record_count") / total).alias("share"),
            (F.col("record_count") / mean).alias("ratio_to_mean"),
        )
        .orderBy(F.col("record_count").desc(), F.col("key").asc())
        .limit(n)
    )
