"""Tables bucketed by their merge key, merged without moving what they hold.

Rows of a key lie in the bucket its hash names, so a merge joins bucket with bucket: only the source is
shuffled, whatever its size, and each task writes its bucket's file of the next version. A version is a
table of its own; readers of the one before are not disturbed, and which one counts is up to the caller.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.operators.keys import key_list
from gneiss.operators.merge import require_unique


@dataclass(frozen=True)
class BucketedTable:
    """One version of a bucketed table: its name in the session's catalog, folder, keys and number of buckets."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    buckets: int
    name: str = ""

    def write(self, df: DataFrame) -> BucketedTable:
        """Rows as a new version. Those that already lie by bucket are written where they are."""
        name = f"bucketed_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").option("path", f"{self.root}/{name}")
        writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(name)
        return replace(self, name=name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def merge(self, source: DataFrame, newer_by: str | None = None, update_columns=None, check_duplicates: bool = True) -> BucketedTable:
        """The next version, with a source merged; see ``merge_in_place`` for its meaning."""
        return self.write(merge_in_place(self.read(), source, self.keys, self.buckets, newer_by, update_columns, check_duplicates))


def create_bucketed(df: DataFrame, root: str, keys, buckets: int) -> BucketedTable:
    """A full load into a bucketed table; the rows are dealt to buckets once, here."""
    names = tuple(key_list(keys))
    table = BucketedTable(df.sparkSession, root, names, buckets)
    return table.write(df.repartition(buckets, *names))


def merge_in_place(target: DataFrame, source: DataFrame, keys, buckets: int, newer_by: str | None = None, update_columns=None,
                   check_duplicates: bool = True) -> DataFrame:
    """An upsert as one full outer join of a bucketed target and a source, each read once.

    It means what ``merge_upsert`` means: keys compare with ``=``, so rows with a null key stay beside each
    other; with ``newer_by`` a match is updated only by a strictly greater value, a null on either side
    keeping the target; columns the source lacks stay on update and are null on insert; ``update_columns`` limits what
    an update changes. A source may hold a key once.
    """
    names = key_list(keys)
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"source columns not in the target: {extra}")
    if check_duplicates:
        require_unique(source, names)
    updates = [c for c in source.columns if c not in names and (update_columns is None or c in update_columns)]
    held = target.withColumn("_held", F.lit(True)).alias("t")
    fresh = source.repartition(buckets, *names).withColumn("_fresh", F.lit(True)).alias("s")
    both = held.join(fresh, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in names], "full_outer")
    is_new, matched = F.col("_held").isNull(), F.col("_held") & F.col("_fresh")
    wins = matched & (F.col(f"s.{newer_by}") > F.col(f"t.{newer_by}")) if newer_by else matched

    def column(name: str) -> Column:
        own = F.col(f"t.{name}")
        if name not in source.columns:
            return own.alias(name)
        new = F.col(f"s.{name}")
        taken = F.when(is_new | wins, new) if name in updates else F.when(is_new, new)
        return taken.otherwise(own).alias(name)

    return both.select(*[column(c) for c in target.columns])
