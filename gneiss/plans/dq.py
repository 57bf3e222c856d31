"""Data-quality results found in the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.functions.values import day, ratio, steady_round
from gneiss.plans.event_log import parsed_events


def dq_violations(log: DataFrame) -> DataFrame:
    """One row per expectation reported by a flow, named by the dataset the flow fills.

    A dataset is the flow's declared output, else the definition's dataset, else the flow
    id. Flows with several definitions give a row for each. Reports without expectations
    give none.
    """
    names = {n: F.col(f"origin.{n}") for n in ("pipeline_id", "flow_id", "dataset_name")}
    definitions = parsed_events(log, "flow_definition").select(
        names["pipeline_id"].alias("_pipeline_id"),
        names["flow_id"].alias("_flow_id"),
        names["dataset_name"].alias("dataset_name"),
        F.col("d.flow_definition.output_dataset").alias("output_dataset"),
    ).distinct()
    flow = F.col("d.flow_progress")
    reports = parsed_events(log, "flow_progress").select(
        names["pipeline_id"].alias("pipeline_id"),
        names["flow_id"].alias("flow_id"),
        F.col("id").alias("event_id"),
        F.col("timestamp").alias("dq_timestamp"),
        F.col("timestamp").cast("date").alias("dq_date"),
        flow["metrics"]["input_rows"].alias("input_rows"),
        flow["metrics"]["output_rows"].alias("output_rows"),
        F.explode(flow["data_quality"]["expectations"]).alias("e"),
    )
    same = (reports["pipeline_id"] == definitions["_pipeline_id"]) & (reports["flow_id"] == definitions["_flow_id"])
    zero = F.lit(0).cast("bigint")
    return reports.join(definitions, same, "left").select(
        "pipeline_id",
        "event_id",
        "dq_timestamp",
        "dq_date",
        F.coalesce("output_dataset", "dataset_name", "flow_id").alias("dataset"),
        F.col("e.name").alias("expectation"),
        F.col("e.status").alias("expectation_status"),
        F.coalesce("e.violated_records", zero).alias("violated_records"),
        F.coalesce("e.passed_records", zero).alias("passed_expectations"),
        F.coalesce("e.failed_records", zero).alias("failed_expectations"),
        F.coalesce("e.dropped_records", zero).alias("dropped_records"),
        F.coalesce("e.metrics.null_count", zero).alias("null_count"),
        F.coalesce("e.metrics.total_records", "output_rows", "input_rows", zero).alias("record_count"),
    )


def dq_summary(violations: DataFrame) -> DataFrame:
    """Totals per day and dataset."""
    null_share = F.when(F.col("record_count") > 0, F.col("null_count") * 100.0 / F.col("record_count"))
    return violations.groupBy("dq_date", "dataset").agg(
        F.count_distinct("expectation").alias("expectations_defined"),
        F.sum("violated_records").alias("total_violated_records"),
        F.sum("passed_expectations").alias("passed_expectations"),
        F.sum("failed_expectations").alias("failed_expectations"),
        F.sum("dropped_records").alias("dropped_record_count"),
        F.sum("null_count").alias("nulls_total"),
        F.sum("record_count").alias("records_total"),
        steady_round(F.avg(null_share)).alias("avg_null_ratio"),
    )


def dq_kpis(violations: DataFrame, as_of=None) -> DataFrame:
    """One day's headline numbers in one pass over its violations.

    Sums over the daily summary equal sums over its rows, so the summary is not needed.
    """
    passed, failed = F.sum("passed_expectations"), F.sum("failed_expectations")
    violated = F.sum("violated_records")
    nulls = F.try_divide(F.col("null_count") * F.lit(100.0), F.nullif("record_count", F.lit(0)))
    return violations.filter(F.col("dq_date") == day(as_of)).agg(
        F.count_distinct("expectation").alias("expectations_defined"),
        steady_round(100 * ratio(passed, passed + failed)).alias("pass_pct"),
        steady_round(100 * ratio(violated, violated + passed)).alias("violation_pct"),
        F.count_distinct(F.when(F.col("violated_records") > 0, F.col("dataset"))).alias("datasets_violated"),
        F.sum("dropped_records").alias("dropped_records"),
        steady_round(F.avg(nulls)).alias("avg_null_pct"),
    )


def dq_trend(summary: DataFrame, as_of=None, days: int = 5, guard: str = "zero") -> DataFrame:
    """Spread of the daily scores of the last days in percent of the lowest.

    The lowest score is guarded against 0; ``guard="reference"`` guards against 1 instead,
    which leaves a score of 0 without a result only because of the safe division.
    """
    today = day(as_of)
    recent = summary.filter(F.col("dq_date").between(F.date_sub(today, days - 1), today))
    passed, failed = F.sum("passed_expectations"), F.sum("failed_expectations")
    scores = recent.groupBy("dq_date").agg(steady_round(ratio(passed, passed + failed) * 10, 1).alias("score"))
    low, high = F.min("score"), F.max("score")
    base = F.nullif(low, F.lit(1.0 if guard == "reference" else 0.0))
    return scores.agg(steady_round(F.try_divide(100.0 * (high - low), base)).alias("trend_percent"))


def top_expectation(violations: DataFrame, as_of=None) -> DataFrame:
    rows = violations.filter(F.col("dq_date") == day(as_of))
    counts = rows.groupBy("expectation").agg(F.count("*").alias("total_violations"))
    return counts.orderBy(F.col("total_violations").desc(), "expectation").limit(1)
