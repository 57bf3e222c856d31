"""Data-quality expectations: named SQL predicates over rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _holds(predicate) -> Column:
    """A predicate that is NULL counts as violated."""
    return F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))


def expect(df: DataFrame, rules: dict, action: str = "warn", name="expectations") -> DataFrame:
    """``warn`` keeps every row; ``drop`` keeps the rows that satisfy every rule. Both count violations.

    Works on streams. The counts are observed under ``name``: a batch reads them from an
    ``Observation`` given as the name, a stream from its progress (``progress.observed_counts``).
    """
    if action not in ("warn", "drop"):
        raise ValueError(f"unknown action: {action!r}")
    if not rules:
        return df
    df = observe_expectations(df, rules, name)
    if action == "warn":
        return df
    return df.filter(reduce(lambda a, b: a & b, [_holds(p) for p in rules.values()]))


def observe_expectations(df: DataFrame, rules: dict, name="expectations") -> DataFrame:
    """Count violations of each rule as an observed metric, without another pass."""
    violations = [F.count_if(~_holds(p)).alias(rule) for rule, p in rules.items()]
    return df.observe(name, F.count(F.lit(1)).alias("total_records"), *violations)


def expectation_metrics(df: DataFrame, rules: dict, action: str = "warn") -> DataFrame:
    """One row per rule from one scan and one global aggregate.

    ``null_count`` counts the rows on which the rule itself is NULL.
    """
    counts = []
    for i, predicate in enumerate(rules.values()):
        value = F.expr(predicate) if isinstance(predicate, str) else predicate
        counts += [
            F.count_if(_holds(predicate)).alias(f"passed_{i}"),
            F.count_if(value.isNull()).alias(f"null_{i}"),
        ]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    rows = []
    for i, rule in enumerate(rules):
        failed = F.col("total") - F.col(f"passed_{i}")
        rows.append(
            F.struct(
                F.lit(rule).alias("name"),
                F.when(failed > 0, "FAILED").otherwise("PASSED").alias("status"),
                F.col(f"passed_{i}").alias("passed_records"),
                failed.alias("failed_records"),
                (failed if action == "drop" else F.lit(0).cast("bigint")).alias("dropped_records"),
                F.col(f"null_{i}").alias("null_count"),
                F.col("total").alias("total_records"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))
