"""Run times, retries and the daily summary of monitored pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.functions.values import day, steady_round
from gneiss.operators.keys import has_null_key, latest_per_key
from gneiss.operators.ordered import next_at_or_after
from gneiss.plans.event_log import parsed_events, update_events

# The states that end an update.
FINAL_STATES = ["COMPLETED", "FAILED", "CANCELED"]
PIPELINE = ["pipeline_id", "pipeline_name"]


def update_runtimes(log: DataFrame) -> DataFrame:
    """For each start of an update and each state seen from then on: end and run time.

    The end is the first event of a final state, and the last event of any other state;
    so a RUNNING row with its own span appears too.

    An update's events are never joined with each other: the next final event comes from an
    ordered pass, the last event of every other state from an aggregate that is joined once
    per update and holds one entry per state, of which there are few by definition.
    """
    events = update_events(log).select(*PIPELINE, "update_id", "event_time", "update_state")
    update = ["pipeline_id", "update_id"]
    keyed = events.filter(~has_null_key(update))
    state = F.col("update_state")
    last_open = (
        keyed.filter(~F.coalesce(state.isin(FINAL_STATES), F.lit(False)))
        .groupBy(*update, "update_state").agg(F.max("event_time").alias("end"))
        .groupBy(*update).agg(F.collect_list(F.struct("update_state", "end")).alias("_open"))
    )
    marks = {f"_next_{s}": state == s for s in FINAL_STATES}
    ahead = next_at_or_after(keyed, update, "event_time", marks)
    starts = ahead.filter(state == "RUNNING").drop("update_state").distinct()
    finals = [F.struct(F.lit(s).alias("update_state"), F.col(f"_next_{s}").alias("end")) for s in FINAL_STATES]
    seen = F.filter(
        F.concat(F.array(*finals), F.coalesce("_open", F.array())),
        lambda s: s["end"] >= F.col("event_time"),
    )
    ended = starts.join(last_open, update, "left").select(
        *PIPELINE, "update_id", F.col("event_time").alias("update_start_time"), F.inline(seen).alias("final_state", "update_end_time"),
    )
    # A start without complete ids matches no event, yet is listed.
    lost = events.filter(has_null_key(update) & (state == "RUNNING")).select(
        *PIPELINE, "update_id", F.col("event_time").alias("update_start_time"),
        F.lit(None).cast("string").alias("final_state"), F.lit(None).cast("timestamp").alias("update_end_time"),
    ).distinct()
    minutes = (F.unix_timestamp("update_end_time") - F.unix_timestamp("update_start_time")) / F.lit(60.0)
    return ended.unionByName(lost).select(
        *PIPELINE, "update_id", "update_start_time", "update_end_time", "final_state", minutes.alias("runtime_minutes")
    )


def latest_updates(runtimes: DataFrame) -> DataFrame:
    """The update of each pipeline that ended last; ties by longer run time, then id."""
    order = [
        F.col("update_end_time").desc_nulls_last(), F.col("runtime_minutes").desc(),
        F.col("update_id").asc(), F.col("final_state").asc(),
    ]
    return latest_per_key(runtimes.filter(F.col("runtime_minutes").isNotNull()), PIPELINE, order).select(
        *PIPELINE, "update_id", "runtime_minutes", "update_end_time"
    )


def retry_counts(runtimes: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Updates per pipeline that completed after an earlier failure, started in the last days.

    A completed run counts when it started after a failed one ended and not later than the
    following midnight: on the same date, or exactly at that midnight. So failures are
    reduced to the first end per pipeline and date, and runs meet them by equality instead
    of every run meeting every failure.
    """
    completed = runtimes.filter(F.col("final_state") == "COMPLETED")
    failed = runtimes.filter((F.col("final_state") == "FAILED") & ~has_null_key(PIPELINE))
    failed_days = failed.groupBy(*PIPELINE, F.col("update_end_time").cast("date").alias("_day")).agg(
        F.min("update_end_time").alias("_first_failure")
    )
    start = F.col("update_start_time")
    own_day = start.cast("date")
    days_after = F.when(start == F.date_trunc("day", start), F.array(own_day, F.date_sub(own_day, 1))).otherwise(F.array(own_day))
    retried = (
        completed.filter(~has_null_key(PIPELINE))
        .select(*PIPELINE, "update_id", start, F.explode(days_after).alias("_day"))
        .join(failed_days, [*PIPELINE, "_day"])
        .filter(F.col("_first_failure") < start)
        .select("update_id")
    )
    recent = completed.filter(start >= F.date_sub(day(as_of), days)).select(*PIPELINE, "update_id")
    return recent.join(retried, "update_id", "left_semi").groupBy(*PIPELINE).agg(
        F.count_distinct("update_id").alias("retry_count_7d")
    )


def pipeline_metrics(log: DataFrame, as_of=None, status: str = "max", runtimes: DataFrame | None = None) -> DataFrame:
    """One row per pipeline that has updates. ``runtimes`` may bring stored run times.

    One scan reduces all kinds of events to a row per pipeline before anything is joined;
    the results equal those of joining every event with every other, as only maxima,
    averages and distinct counts are taken. ``status="max"`` is the greatest status in
    alphabetical order, ``"latest"`` that of the last flow event.
    """
    events = parsed_events(
        log, "flow_progress", "update_progress", "flow_definition", "dataset_definition", "operation_progress"
    )
    kind, at = F.col("event_type"), F.col("timestamp")
    # Without a pipeline id an update stands alone: other events cannot be matched to it.
    events = events.filter(F.col("origin.pipeline_id").isNotNull() | (kind == "update_progress"))
    flow, defined = F.col("d.flow_progress"), F.col("d.flow_definition")
    is_flow, is_definition = kind == "flow_progress", kind == "flow_definition"
    loads = ((kind == "dataset_definition") & (F.col("d.dataset_definition.source_type") == "autoloader")) | (
        (kind == "operation_progress") & F.col("d.operation_progress.auto_loader_details.num_files_listed").isNotNull()
    )
    # First reduce by status and table name, of which a pipeline has few: all maxima are of
    # fixed width here, so the log itself is hashed and never sorted.
    reduced = events.groupBy(
        F.col("origin.pipeline_id").alias("pipeline_id"),
        F.col("origin.pipeline_name").alias("pipeline_name"),
        kind.alias("_kind"),
        F.when(is_flow, flow["status"]).alias("_status"),
        F.when(is_definition, defined["output_dataset"]).alias("_table"),
    ).agg(
        F.max(at).alias("_at"),
        F.max(F.when(is_flow, flow["metrics"]["backlog_bytes"])).alias("_backlog"),
        F.max(F.when(loads, 1).otherwise(0)).alias("_loads"),
        F.max(F.when(is_definition & defined["is_streaming"], 1).otherwise(0)).alias("_streams"),
    )
    of_flow = F.col("_kind") == "flow_progress"
    if status == "latest":
        chosen = F.max(F.when(of_flow, F.struct("_at", "_status")))["_status"]
    elif status == "max":
        chosen = F.max("_status")
    else:
        raise ValueError(f"unknown status: {status!r}")
    metrics = reduced.groupBy(*PIPELINE).agg(
        chosen.alias("status"),
        (F.max("_backlog") / F.lit(1024.0) / F.lit(1024.0)).alias("streaming_backlog_mb"),
        F.max("_loads").alias("pipelines_with_autoloader"),
        F.count_distinct("_table").alias("tables_created"),
        F.max("_streams").alias("active_streaming_pipelines"),
        F.max(F.when(F.col("_status") == "FAILED", F.col("_at"))).alias("last_failure_ts"),
        F.max(F.when(of_flow, F.col("_at"))).alias("_last_flow"),
        F.max(F.when(F.col("_kind") == "update_progress", F.col("_at"))).alias("_last_update"),
    )
    runtimes = update_runtimes(log) if runtimes is None else runtimes
    # Of the update that ended last only the run time is shown, so a maximum finds it.
    last_run = F.max(F.when(F.col("runtime_minutes").isNotNull(), F.struct("update_end_time", "runtime_minutes")))
    times = runtimes.groupBy(*PIPELINE).agg(
        F.avg("runtime_minutes").alias("avg_runtime_minutes"),
        F.max("runtime_minutes").alias("longest_runtime_minutes"),
        last_run["runtime_minutes"].alias("latest_runtime_minutes"),
    )
    joined = metrics.filter(F.col("_last_update").isNotNull())
    for side in (times, retry_counts(runtimes, as_of)):
        joined = joined.join(side, PIPELINE, "left")
    return joined.withColumns({
        "retry_count_7d": F.coalesce("retry_count_7d", F.lit(0).cast("bigint")),
        "most_recent_event_time": F.coalesce("_last_flow", "_last_update"),
    }).drop("_last_flow", "_last_update")


def pipeline_summary(log: DataFrame, as_of=None, status: str = "max", runtimes: DataFrame | None = None) -> DataFrame:
    """The daily summary per pipeline name, of pipelines active since yesterday."""
    today = day(as_of)
    active = pipeline_metrics(log, as_of, status, runtimes).filter(F.col("most_recent_event_time") >= F.date_sub(today, 1))
    grouped = active.groupBy("pipeline_name").agg(
        F.count_distinct("pipeline_name").alias("total_pipelines"),
        F.sum(F.when(F.col("status") == "FAILED", 1).otherwise(0)).alias("pipelines_failed_today"),
        F.max("streaming_backlog_mb").alias("streaming_backlog_mb"),
        steady_round(F.avg("avg_runtime_minutes")).alias("avg_runtime_minutes"),
        steady_round(F.max("latest_runtime_minutes")).alias("latest_runtime_minutes"),
        F.max("retry_count_7d").alias("retry_count_7d"),
        F.max("longest_runtime_minutes").alias("longest_runtime_minutes"),
        F.sum("pipelines_with_autoloader").alias("pipelines_with_autoloader"),
        F.sum("tables_created").alias("tables_created"),
        F.sum("active_streaming_pipelines").alias("active_streaming_pipelines"),
        F.max("last_failure_ts").alias("last_failure_ts"),
    )
    return grouped.select(today.alias("summary_date"), "*")


def pipeline_summary_flat(runs: DataFrame, as_of=None) -> DataFrame:
    """The daily summary over an already flat log of runs.

    The number of all pipelines is a scalar subquery, not a window over everything.
    """
    total = runs.agg(F.count_distinct("pipeline_name").alias("total")).scalar()
    failed = F.col("status") == "FAILED"
    grouped = runs.groupBy("pipeline_name").agg(
        F.sum(F.when(failed, 1).otherwise(0)).alias("pipelines_failed_today"),
        F.max("streaming_backlog").alias("streaming_backlog_mb"),
        steady_round(F.avg("runtime_minutes")).alias("avg_runtime_minutes"),
        F.sum("retry_count_7d").alias("retry_count_7d"),
        F.max("runtime_minutes").alias("longest_runtime_minutes"),
        F.sum(F.when(F.col("source_type") == "autoloader", 1).otherwise(0)).alias("pipelines_with_autoloader"),
        F.count_distinct("target_table_name").alias("tables_created"),
        F.sum(F.when(F.col("is_streaming"), 1).otherwise(0)).alias("active_streaming_pipelines"),
        F.max(F.when(failed, F.col("event_time"))).alias("last_failure_ts"),
    )
    values = [c for c in grouped.columns if c != "pipeline_name"]
    return grouped.select(day(as_of).alias("summary_date"), "pipeline_name", total.alias("total_pipelines"), *values)


def summarise_registered(registry: DataFrame, log: DataFrame, as_of=None) -> DataFrame:
    """The summary of all pipelines whose registry entry has logging enabled, in one job."""
    enabled = registry.filter("log_enabled").select("pipeline_id").distinct()
    kept = log.join(enabled, log["origin.pipeline_id"] == enabled["pipeline_id"], "left_semi")
    return pipeline_summary(kept, as_of)


def run_kpis(summary: DataFrame, as_of=None) -> DataFrame:
    """The ten headline numbers of one day's summary in a single pass."""
    return summary.filter(F.col("summary_date") == day(as_of)).agg(
        F.count_distinct("pipeline_name").alias("total_pipelines"),
        F.sum("pipelines_failed_today").alias("pipelines_failed_today"),
        F.sum("streaming_backlog_mb").alias("streaming_backlog_mb"),
        F.avg("avg_runtime_minutes").alias("avg_runtime_minutes"),
        F.sum("retry_count_7d").alias("retry_count_7d"),
        F.max("longest_runtime_minutes").alias("longest_runtime_minutes"),
        F.sum("pipelines_with_autoloader").alias("pipelines_with_autoloader"),
        F.sum("tables_created").alias("tables_created"),
        F.sum("active_streaming_pipelines").alias("active_streaming_pipelines"),
        F.max("last_failure_ts").alias("last_failure_ts"),
    )
