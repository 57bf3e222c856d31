"""Change feeds between table states, and their application (slowly changing type 1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.values import moment
from gneiss.operators.keys import key_list, latest_per_key, split_null_keys

# The names of the change columns and of the kinds of change.
CHANGE_COLUMNS = ["_change_type", "_commit_version", "_commit_timestamp"]
INSERT, DELETE = "insert", "delete"
BEFORE, AFTER = "update_preimage", "update_postimage"


def change_feed(old: DataFrame, new: DataFrame, keys, version: int, ts=None) -> DataFrame:
    """Rows that turn ``old`` into ``new``, each with its kind of change.

    Both states hold a key at most once. Values compare null-safely over all non-key
    columns. An update gives its row before and its row after.
    """
    names = key_list(keys)
    columns = new.columns
    old = old.select(*columns)
    old_keyed, old_rest = split_null_keys(old, names)
    new_keyed, new_rest = split_null_keys(new, names)
    before = old_keyed.select(*[F.col(k).alias(f"_old_{k}") for k in names], F.struct(*columns).alias("_before"))
    after = new_keyed.select(*[F.col(k).alias(f"_new_{k}") for k in names], F.struct(*columns).alias("_after"))
    same = reduce(lambda a, b: a & b, [before[f"_old_{k}"] == after[f"_new_{k}"] for k in names])
    pairs = before.join(after, same, "full_outer").filter(~F.col("_before").eqNullSafe(F.col("_after")))

    def change(kind, row):
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    emitted = (
        F.when(F.col("_before").isNull(), F.array(change(INSERT, "_after")))
        .when(F.col("_after").isNull(), F.array(change(DELETE, "_before")))
        .otherwise(F.array(change(BEFORE, "_before"), change(AFTER, "_after")))
    )
    changed = pairs.select(F.inline(emitted)).select("row.*", F.col("kind").alias("_change_type"))
    for rows, kind in ((old_rest, DELETE), (new_rest, INSERT)):
        changed = changed.unionByName(rows.withColumn("_change_type", F.lit(kind)))
    return changed.withColumns({"_commit_version": F.lit(version).cast("bigint"), "_commit_timestamp": moment(ts)})


def strip_change_columns(df: DataFrame) -> DataFrame:
    return df.drop(*CHANGE_COLUMNS)


def upsert_rows(feed: DataFrame) -> DataFrame:
    """Rows of a feed that carry a new state: inserts and rows after an update."""
    return feed.filter(F.col("_change_type").isin(INSERT, AFTER))


def newest_changes(changes: DataFrame, keys, sequence_by: str) -> DataFrame:
    """The change with the highest sequence of each key, whatever order changes arrive in.

    Sequences should differ within a key; equal ones are ordered by the whole row, so the
    choice does not depend on how rows are distributed. Rows before an update carry no
    state and are left out.
    """
    names = key_list(keys)
    if "_change_type" in changes.columns:
        changes = changes.filter(F.col("_change_type") != BEFORE)
    changes, _ = split_null_keys(changes, names)
    rest = [F.col(c).asc() for c in changes.columns if c not in names and c != sequence_by]
    return latest_per_key(changes, names, [F.col(sequence_by).desc_nulls_last(), *rest])


def scd1_apply(
    target: DataFrame,
    changes: DataFrame,
    keys,
    sequence_by: str,
    apply_as_deletes: Column | str | None = None,
    except_columns=(),
    tombstones: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The target after the changes, and the tombstones of deleted keys.

    A change applies only when its sequence exceeds what the key already has, be it a row
    or the tombstone of an earlier delete; so late changes never bring a key back. The
    target keeps ``sequence_by`` to make that comparison.
    """
    names = key_list(keys)
    columns = target.columns
    gone = F.lit(False) if apply_as_deletes is None else _condition(apply_as_deletes)
    newest = newest_changes(changes, names, sequence_by).withColumn("_deleted", F.coalesce(gone, F.lit(False)))
    newest = newest.drop(*except_columns)
    incoming = newest.select(
        *names, F.struct(*[_fit(newest, f) for f in target.schema.fields]).alias("_incoming"),
        F.col(sequence_by).alias("_incoming_seq"), "_deleted",
    )

    keyed, unkeyed = split_null_keys(target, names)
    stored = keyed.select(
        *names, F.struct(*columns).alias("_stored"), F.col(sequence_by).alias("_stored_seq"), F.lit(False).alias("_buried")
    )
    if tombstones is not None:
        graves = tombstones.select(
            *names, F.lit(None).cast(stored.schema["_stored"].dataType).alias("_stored"),
            F.col(sequence_by).alias("_stored_seq"), F.lit(True).alias("_buried"),
        )
        stored = stored.unionByName(graves)
    # The stored state is the outer side, so a small set of changes is broadcast and does not move it;
    # keys it lacks are found from its keys reduced to those of the changes.
    present = stored.select(*names).join(incoming.select(*names), names, "left_semi").distinct()
    added = incoming.join(present, names, "left_anti")
    both = stored.join(incoming, names, "left").unionByName(added, allowMissingColumns=True)
    newer = F.coalesce(
        F.col("_incoming_seq").isNotNull()
        & (F.col("_stored_seq").isNull() | (F.col("_incoming_seq") > F.col("_stored_seq"))),
        F.lit(False),
    )
    # A key without a row or tombstone takes its change, even one without a sequence.
    fresh = F.col("_buried").isNull() & F.col("_deleted").isNotNull()
    decided = both.withColumn("_newer", newer | fresh)
    alive = decided.filter(
        (F.col("_newer") & ~F.col("_deleted")) | (~F.col("_newer") & F.col("_stored").isNotNull())
    )
    rows = alive.select(F.when(F.col("_newer"), F.col("_incoming")).otherwise(F.col("_stored")).alias("_row"))
    buried = decided.filter((F.col("_newer") & F.col("_deleted")) | (~F.col("_newer") & F.col("_buried"))).select(
        *names, F.when(F.col("_newer"), F.col("_incoming_seq")).otherwise(F.col("_stored_seq")).alias(sequence_by)
    )
    return rows.select("_row.*").unionByName(unkeyed), buried


def _fit(df: DataFrame, field) -> Column:
    value = F.col(field.name) if field.name in df.columns else F.lit(None)
    return value.cast(field.dataType).alias(field.name)


def _condition(predicate) -> Column:
    return F.expr(predicate) if isinstance(predicate, str) else predicate
