"""Counts kept in bounded memory that add up: distinct values by day, and frequent keys.

Both are small tables that are stored once per day or batch and merged afterwards, so that a week's
number needs no second look at the week's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.operators.keys import key_list

#: Logarithm of a sketch's slots: a standard error of about 1.04 / sqrt(2^14), 0.8 percent.
LG_SLOTS = 14


def distinct_sketches(df: DataFrame, keys, values: dict[str, str], lg_slots: int = LG_SLOTS) -> DataFrame:
    """Per key one sketch of the distinct values of each column; ``values`` maps a name to a column.

    Nulls aren't counted, as in a distinct count. A sketch takes at most some 2^``lg_slots`` bytes.
    """
    # A sketch takes long and text values alike; other types are counted by their text.
    kinds = dict(df.dtypes)
    known = {n: F.col(c) if kinds[c] in ("bigint", "int", "string") else F.col(c).cast("string") for n, c in values.items()}
    return df.groupBy(*key_list(keys)).agg(*[F.hll_sketch_agg(c, lg_slots).alias(n) for n, c in known.items()])


def merged_sketches(sketches: DataFrame, keys, names) -> DataFrame:
    """Sketches united per key, for instance those of all batches of a day."""
    return sketches.groupBy(*key_list(keys)).agg(*[F.hll_union_agg(n).alias(n) for n in names])


def trailing_distinct(sketches: DataFrame, day: str, names, days: int) -> DataFrame:
    """For each day that has a sketch, estimated distinct counts of it and the days before, ``days`` in all.

    A day's sketch joins the ``days`` windows it lies in; rows are not read again.
    """
    until = F.explode(F.sequence(F.col(day), F.date_add(F.col(day), days - 1)))
    spread = sketches.select(until.alias("_until"), *names)
    united = merged_sketches(spread, "_until", names)
    shown = united.select(F.col("_until").alias(day), *[F.hll_sketch_estimate(n).alias(n) for n in names])
    return shown.join(sketches.select(day).distinct(), day, "left_semi")


#: Seeds of the frequency table's hashes, and buckets for each.
SEEDS, BUCKETS = (11, 23, 47), 1 << 16


def _bucket(key: Column, seed: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(buckets)).cast("int")


def frequency_table(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows by hash bucket of the key for each seed: (seed, bucket, n), at most ``buckets`` rows a seed.

    Tables of parts of the data add up by ``merged_frequencies``. No key is held, so memory does not grow with their number.
    """
    hashed = F.array(*[F.struct(F.lit(s).alias("seed"), _bucket(F.col(key), s, buckets).alias("bucket")) for s in SEEDS])
    return df.select(F.inline(hashed)).groupBy("seed", "bucket").agg(F.count("*").alias("n"))


def merged_frequencies(table: DataFrame) -> DataFrame:
    return table.groupBy("seed", "bucket").agg(F.sum("n").alias("n"))


def heavy_hitters(df: DataFrame, key: str, share: float, table: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """All keys that hold more than ``share`` of the rows, null included, with their exact counts.

    A key's rows all fall into its bucket, so a frequent key has a frequent bucket under every seed. Only rows
    of such buckets are counted by key: none that is frequent is missed, and few others are counted. Frequent
    buckets number at most 1 / ``share`` for each seed, which bounds what is sent to all tasks. ``table`` may bring the stored
    frequencies of ``df``.
    """
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    counted = frequency_table(df, key, buckets) if table is None else table
    total = counted.filter(F.col("seed") == SEEDS[0]).agg(F.sum("n").alias("total")).scalar()
    frequent = counted.filter(F.col("n") > total * share)
    rows = df.select(F.col(key).alias("key"))
    for seed in SEEDS:
        own = frequent.filter(F.col("seed") == seed).select(F.col("bucket").alias("_bucket"))
        rows = rows.withColumn("_bucket", _bucket(F.col("key"), seed, buckets)).join(F.broadcast(own), "_bucket", "left_semi").drop("_bucket")
    counts = rows.groupBy("key").agg(F.count("*").alias("record_count"))
    return counts.filter(F.col("record_count") > total * share).withColumn("share", F.col("record_count") / total)
