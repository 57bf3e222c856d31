"""Slowly changing type 2 histories from periodic snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.operators.keys import has_null_key, key_list

START, END = "__START_AT", "__END_AT"


def scd2_from_snapshots(snapshots: DataFrame, keys, version_col: str) -> DataFrame:
    """The history that results from taking every snapshot in the order of its version.

    A row opens where its key was missing from the previous existing version or had other
    values. It closes at the version after the last one that shows it, else stays open.

    A key has at most one row per snapshot, so a window over a key spans no more rows than
    there are snapshots. The list of versions is as short; it reaches the rows as the value
    of a scalar subquery, so nothing is joined.
    """
    names = key_list(keys)
    values = [c for c in snapshots.columns if c not in [*names, version_col]]
    versions = snapshots.agg(F.array_sort(F.collect_set(version_col)).alias("versions")).scalar()
    placed = (
        snapshots.filter(~has_null_key(names))
        .withColumn("_versions", versions)
        .withColumn("_index", F.array_position("_versions", F.col(version_col)))
        .withColumns({
            "_next_version": F.get("_versions", F.col("_index").cast("int")),
            "_values": F.struct(*values) if values else F.lit(0),
        })
        .drop("_versions", *values)
    )
    by_key = Window.partitionBy(*names).orderBy("_index")
    last_seen, last_values = F.lag("_index").over(by_key), F.lag("_values").over(by_key)
    continues = (last_seen == F.col("_index") - 1) & last_values.eqNullSafe(F.col("_values"))
    opened = placed.withColumn("_opens", 1 - F.coalesce(continues, F.lit(False)).cast("int"))
    runs = opened.withColumn("_run", F.sum("_opens").over(by_key))
    # The run is constant within its key's partition, so this aggregation moves no rows.
    spans = runs.groupBy(*names, "_run").agg(
        F.first("_values").alias("_values"),
        F.min(version_col).alias(START),
        F.max(F.struct("_index", "_next_version")).alias("_last"),
    )
    shown = ["_values.*"] if values else []
    return spans.select(*names, *shown, START, F.col("_last._next_version").alias(END))


def scd2_apply_snapshot(history: DataFrame, snapshot: DataFrame, keys, version) -> DataFrame:
    """The history after one more snapshot. Only open rows take part in the join.

    Versions must increase: one not above every start and end already recorded is rejected.
    """
    names = key_list(keys)
    values = [c for c in snapshot.columns if c not in names]
    kind = history.schema[START].dataType
    at, nothing = F.lit(version).cast(kind), F.lit(None).cast(kind)
    if history.agg(F.max(F.greatest(START, END) >= at).alias("late")).first()["late"]:
        raise ValueError(f"version {version!r} is not above the versions in the history")

    closed = history.filter(F.col(END).isNotNull())
    live = history.filter(F.col(END).isNull()).select(
        *[F.col(k).alias(f"_live_{k}") for k in names], F.struct(*values).alias("_old"), F.col(START).alias("_since")
    )
    taken = snapshot.filter(~has_null_key(names)).select(*names, F.struct(*values).alias("_new"))
    same = reduce(lambda a, b: a & b, [live[f"_live_{k}"] == taken[k] for k in names])
    joined = live.join(taken, same, "full_outer").select(
        *[F.coalesce(f"_live_{k}", k).alias(k) for k in names], "_old", "_new", "_since"
    )

    def row(state, start, end):
        return F.struct(F.col(state).alias("state"), start.alias(START), end.alias(END))

    since = F.col("_since")
    outcome = (
        F.when(F.col("_old").isNull(), F.array(row("_new", at, nothing)))
        .when(F.col("_new").isNull(), F.array(row("_old", since, at)))
        .when(F.col("_old").eqNullSafe(F.col("_new")), F.array(row("_old", since, nothing)))
        .otherwise(F.array(row("_old", since, at), row("_new", at, nothing)))
    )
    current = joined.select(*names, F.inline(outcome)).select(*names, "state.*", START, END)
    return closed.select(*current.columns).unionByName(current)
