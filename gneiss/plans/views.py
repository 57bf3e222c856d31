"""Aggregated views kept current by the changes of their base table.

A view stores, per group, its rows, sums and extremes. A change feed adds and takes away: counts and sums
by signed deltas, extremes by comparison. Only a group whose extreme was taken away is read again, and
only it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.operators.changes import AFTER, BEFORE, DELETE, INSERT
from gneiss.operators.keys import key_list
from gneiss.sources.tables import materialize


@dataclass(frozen=True)
class AggregateView:
    """Group keys, columns to sum and columns to take the least and greatest of.

    Sums of exact types stay exact; doubles are summed as decimals with ``scale`` digits, so that what was added
    can be taken away again without a rest.
    """

    keys: tuple[str, ...]
    sums: tuple[str, ...] = ()
    extremes: tuple[str, ...] = ()
    scale: int = 6

    @classmethod
    def of(cls, keys, sums=(), extremes=(), scale: int = 6) -> AggregateView:
        return cls(tuple(key_list(keys)), tuple(sums), tuple(extremes), scale)

    def _exact(self, column: str) -> Column:
        return F.col(column).cast(f"decimal(28,{self.scale})")

    def _stored_sum(self, value: Column) -> Column:
        return F.sum(value).cast(f"decimal(38,{self.scale})")

    def full(self, df: DataFrame) -> DataFrame:
        """The view over a whole table: keys, row_count, and per column count, sum, least and greatest."""
        return df.groupBy(*self.keys).agg(
            F.count("*").alias("row_count"),
            *[F.count(c).alias(f"count_{c}") for c in self.sums],
            *[self._stored_sum(self._exact(c)).alias(f"sum_{c}") for c in self.sums],
            *[F.min(c).alias(f"min_{c}") for c in self.extremes],
            *[F.max(c).alias(f"max_{c}") for c in self.extremes],
        )

    def deltas(self, feed: DataFrame) -> DataFrame:
        """What a change feed adds to and takes from each group."""
        added = F.col("_change_type").isin(INSERT, AFTER)
        sign = F.when(added, 1).when(F.col("_change_type").isin(DELETE, BEFORE), -1)
        changed = feed.withColumn("_sign", sign).filter(F.col("_sign").isNotNull())
        up, down = F.col("_sign") > 0, F.col("_sign") < 0
        return changed.groupBy(*self.keys).agg(
            F.sum("_sign").alias("_rows"),
            *[F.sum(F.when(F.col(c).isNotNull(), F.col("_sign"))).alias(f"_n_{c}") for c in self.sums],
            *[self._stored_sum(F.when(up, self._exact(c)).otherwise(-self._exact(c))).alias(f"_sum_{c}") for c in self.sums],
            *[f(F.when(w, F.col(c))).alias(f"_{n}_{c}") for c in self.extremes
              for n, f, w in (("new_min", F.min, up), ("new_max", F.max, up), ("old_min", F.min, down), ("old_max", F.max, down))],
        )

    def refresh(self, view: DataFrame, feed: DataFrame, base: DataFrame, stage_path: str | None = None) -> DataFrame:
        """The view after the changes in ``feed``; ``base`` is the table after them.

        A group is read again from ``base`` if a row with its least or greatest value was taken away and none as
        low or as high was added. Groups without rows go. Null keys are a group.
        """
        prefixed = self.deltas(feed).withColumnsRenamed({k: f"_key_{k}" for k in self.keys}).withColumn("_changed", F.lit(True))
        same = [view[k].eqNullSafe(prefixed[f"_key_{k}"]) for k in self.keys]
        both = view.withColumn("_held", F.lit(True)).join(prefixed, same, "full_outer")
        key = {k: F.when(F.col("_held").isNotNull(), F.col(k)).otherwise(F.col(f"_key_{k}")) for k in self.keys}
        zero = F.lit(0)
        rows = F.coalesce("row_count", zero) + F.coalesce("_rows", zero)

        def plus(stored: str, delta: str) -> Column:
            return F.coalesce(F.col(stored), zero) + F.coalesce(F.col(delta), zero)

        lost = F.lit(False)
        for c in self.extremes:
            lost = lost | F.coalesce((F.col(f"_old_min_{c}") <= F.col(f"min_{c}")) & ~F.coalesce(F.col(f"_new_min_{c}") <= F.col(f"min_{c}"), F.lit(False)), F.lit(False))
            lost = lost | F.coalesce((F.col(f"_old_max_{c}") >= F.col(f"max_{c}")) & ~F.coalesce(F.col(f"_new_max_{c}") >= F.col(f"max_{c}"), F.lit(False)), F.lit(False))
        counts = [plus(f"count_{c}", f"_n_{c}").alias(f"count_{c}") for c in self.sums]
        sums = [F.when(plus(f"count_{c}", f"_n_{c}") > 0, plus(f"sum_{c}", f"_sum_{c}").cast(f"decimal(38,{self.scale})")).alias(f"sum_{c}") for c in self.sums]
        low = [F.least(f"min_{c}", f"_new_min_{c}").alias(f"min_{c}") for c in self.extremes]
        high = [F.greatest(f"max_{c}", f"_new_max_{c}").alias(f"max_{c}") for c in self.extremes]
        moved = both.filter(rows > 0).select(*[v.alias(k) for k, v in key.items()], rows.cast("bigint").alias("row_count"), *counts, *sums, *low, *high, lost.alias("_lost"))
        if stage_path:
            moved = materialize(moved, stage_path)
        steady = moved.filter(~F.col("_lost")).drop("_lost")
        stale = moved.filter("_lost").select(*[F.col(k).alias(f"_key_{k}") for k in self.keys])
        again = base.join(stale, [base[k].eqNullSafe(stale[f"_key_{k}"]) for k in self.keys], "left_semi")
        return steady.unionByName(self.full(again))
