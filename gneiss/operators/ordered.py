"""Ordered computations within a key that may hold a large share of all rows.

A plain window sends a whole key to one task. Here a key is cut into buckets of its order,
which depend on the rows' values alone: each bucket is computed by itself and receives the
little it needs from its neighbours. There is one plan for every size, no job runs while it
is built, and nothing is checkpointed, since every evaluation finds the same buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.operators.cuts import place
from gneiss.operators.keys import key_list

#: Buckets at most, rows that make a bucket worthwhile, and rows of the sample that fixes the cuts.
BUCKETS, BUCKET_ROWS, SAMPLE = 1024, 20_000, 8192


def order_cuts(df: DataFrame, order_by, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> Column:
    """Values of a total order, of any types, that cut the rows into parts of about equal size, as an array.

    The rows with the least hashes are a sample that is the same for every evaluation. How far their hashes
    reach tells the number of rows, so one pass over the order's columns is enough. There are as many
    cuts as make parts of ``bucket_rows``, and fewer than ``buckets``.
    """
    size = max(SAMPLE, 8 * buckets)
    rows = df.select(F.struct(*order_by).alias("_at"), F.xxhash64(*order_by).alias("_hash"))
    sample = rows.orderBy("_hash", "_at").limit(size).agg(
        F.array_sort(F.collect_list("_at")).alias("at"), F.count("*").alias("n"), F.max("_hash").alias("reach"))
    # The share of all 2^64 hashes that lies at or below the greatest of the sample.
    share = (F.col("reach") + F.lit(2.0**63)) / F.lit(2.0**64)
    total = F.when(F.col("n") < size, F.col("n")).otherwise(F.col("n") / share)
    parts = F.least(F.lit(buckets), F.floor(total / bucket_rows) + 1, F.col("n") + 1).cast("int")
    cuts = F.when(parts > 1, F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.get("at", F.floor(i * F.col("n") / parts).cast("int"))))
    return sample.select(cuts.alias("cuts")).scalar()


def in_buckets(df: DataFrame, order_by, cut_by: DataFrame | None = None, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows with the number of the part of the order they lie in, as ``_bucket``.

    The cuts are those of all rows, so that no key has more rows in a bucket than a bucket has. ``cut_by``
    may give them from other rows with the same columns, such as those of a cheaper input.
    """
    cuts = order_cuts(df if cut_by is None else cut_by, order_by, buckets, bucket_rows)
    return df.withColumn("_cuts", cuts).withColumn("_bucket", place(F.struct(*order_by), F.col("_cuts"), buckets - 1)).drop("_cuts")


def rolling_mean(df: DataFrame, keys, order_by, value: str, frames: dict, cut_by: DataFrame | None = None,
                 buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Means over row frames that look back at most a few rows.

    ``frames`` maps an output name to ``(first, last)`` offsets, both at most 0, for
    instance ``(-7, -1)`` for the previous seven rows. ``order_by`` must be a total order; its
    columns may be of any ordered type. See ``in_buckets`` for ``cut_by``.
    """
    names, order_by = key_list(keys), list(order_by)
    if any(last > 0 or first > last for first, last in frames.values()):
        raise ValueError("frames may only look back")
    reach = -min(first for first, _ in frames.values())
    cut = in_buckets(df, order_by, cut_by, buckets, bucket_rows)
    bucket = Window.partitionBy(*names, "_bucket")

    def means(rows: DataFrame, window) -> DataFrame:
        return rows.withColumns({n: F.avg(value).over(window.rowsBetween(a, b)) for n, (a, b) in frames.items()})

    # All but the first rows of a bucket have what they look back at beside them.
    ordered = bucket.orderBy(*order_by)
    ranked = means(cut, ordered).withColumns({"_at": F.row_number().over(ordered), "_of": F.count("*").over(bucket)})
    first = F.col("_at") <= reach
    # The first rows of a bucket and the last ones of those before are neighbours; there are few of them.
    edges = ranked.filter(first | (F.col("_at") > F.col("_of") - reach))
    mended = means(edges, Window.partitionBy(*names).orderBy("_bucket", "_at")).filter(first)
    return ranked.filter(~first).unionByName(mended).select(*df.columns, *frames)


def next_at_or_after(df: DataFrame, keys, time: str, marks: dict[str, Column], bucket: Column | None = None) -> DataFrame:
    """For every row, the earliest ``time`` of a marked row of its key, not before its own.

    ``marks`` maps an output name to a condition. This answers "the next event of that kind"
    without joining a key's rows with one another: the first marked times of each key and bucket
    are carried back over the buckets, and only a bucket's own rows are ordered. ``bucket``
    must not fall as the time rises; it is the hour of the time unless given.
    """
    names = key_list(keys)
    bucket = F.date_trunc("hour", F.col(time)) if bucket is None else bucket
    cut = df.withColumn("_bucket", bucket)
    marked = {n: F.when(cond, F.col(time)) for n, cond in marks.items()}
    firsts = cut.groupBy(*names, "_bucket").agg(*[F.min(c).alias(n) for n, c in marked.items()])
    later = Window.partitionBy(*names).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = firsts.select(
        *[F.col(k).alias(f"_key_{k}") for k in [*names, "_bucket"]], *[F.min(n).over(later).alias(f"_later_{n}") for n in marked])
    ahead = Window.partitionBy(*names, "_bucket").orderBy(F.col(time).desc()).rangeBetween(Window.unboundedPreceding, 0)
    inside = cut.withColumns({n: F.min(c).over(ahead) for n, c in marked.items()})
    same = [inside[k].eqNullSafe(carried[f"_key_{k}"]) for k in [*names, "_bucket"]]
    both = inside.join(carried, same, "left")
    return both.withColumns({n: F.coalesce(n, f"_later_{n}") for n in marked}).select(*df.columns, *marked)
