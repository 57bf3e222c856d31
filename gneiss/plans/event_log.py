"""Typed rows from a run event log whose details are JSON text.

The log has ``id, timestamp, event_type, origin STRUCT, details STRING``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.functions.values import moment

# The paths below `details` that the extractors read, as one schema.
EXPECTATIONS = (
    "ARRAY<STRUCT<name: STRING, status: STRING, violated_records: BIGINT, passed_records: BIGINT, "
    "failed_records: BIGINT, dropped_records: BIGINT, metrics: STRUCT<null_count: BIGINT, total_records: BIGINT>>>"
)
DETAILS = (
    "flow_progress STRUCT<status: STRING, metrics: STRUCT<backlog_bytes: BIGINT, input_rows: BIGINT, "
    f"output_rows: BIGINT, output_table: STRING>, data_quality: STRUCT<expectations: {EXPECTATIONS}>>, "
    "update_progress STRUCT<state: STRING, metrics: STRUCT<input_rows: BIGINT, output_rows: BIGINT>>, "
    "flow_definition STRUCT<output_dataset: STRING, is_streaming: BOOLEAN>, "
    "dataset_definition STRUCT<source_type: STRING, path: STRING>, "
    "operation_progress STRUCT<auto_loader_details: STRUCT<num_files_listed: BIGINT, num_files_processed: BIGINT>>, "
    "cluster_resources STRUCT<default_cluster_info: STRUCT<cluster_id: STRING, cluster_name: STRING, "
    "idle_minutes: DOUBLE, active_minutes: DOUBLE, job_id: STRING>>"
)


def clean_event_log(log: DataFrame, as_of=None, pipeline_name: str | None = None) -> DataFrame:
    """The cleaned log. The name comes from the event, or is one given for the whole log."""

    def at(path):
        return F.get_json_object("details", f"$.{path}")

    name = F.col("origin.pipeline_name") if pipeline_name is None else F.lit(pipeline_name)
    return log.select(
        moment(as_of).alias("loaded_at"),
        name.alias("pipeline_name"),
        "event_type",
        "timestamp",
        F.col("origin.update_id").alias("update_id"),
        F.col("origin.org_id").alias("workspace_id"),
        F.col("origin.cloud").alias("cloud"),
        at("flow_progress.metrics.backlog_bytes").alias("backlog_bytes"),
        at("flow_progress.data_quality.expectations").alias("dq_expectations"),
        at("user_action.action").alias("user_action"),
        at("autoscale.requested_num_executors").alias("autoscale_exec"),
        at("operation_progress.auto_loader_details.num_files_listed").alias("auto_loader_file_count"),
    )


def parsed_events(log: DataFrame, *event_types: str) -> DataFrame:
    """Named events of the given types with their details parsed once as ``d``.

    The type filter runs before parsing, and Spark parses only the fields a plan uses.
    """
    rows = log.filter(F.col("event_type").isin(*event_types) & F.col("origin.pipeline_name").isNotNull())
    return rows.withColumn("d", F.from_json("details", DETAILS))


def _origin(*names):
    return [F.col(f"origin.{n}").alias(n) for n in names]


def flow_events(log: DataFrame) -> DataFrame:
    flow = F.col("d.flow_progress")
    return parsed_events(log, "flow_progress").select(
        *_origin("pipeline_id", "pipeline_name", "update_id", "flow_id", "flow_name"),
        F.col("timestamp").alias("event_time"),
        flow["status"].alias("status"),
        flow["metrics"]["backlog_bytes"].alias("backlog_bytes"),
        flow["metrics"]["input_rows"].alias("input_rows"),
        flow["metrics"]["output_rows"].alias("output_rows"),
    )


def update_events(log: DataFrame) -> DataFrame:
    update = F.col("d.update_progress")
    return parsed_events(log, "update_progress").select(
        *_origin("pipeline_id", "pipeline_name", "update_id"),
        F.col("timestamp").alias("event_time"),
        update["state"].alias("update_state"),
        update["metrics"]["input_rows"].alias("total_input_rows"),
        update["metrics"]["output_rows"].alias("total_output_rows"),
    )


def flow_definitions(log: DataFrame) -> DataFrame:
    defined = F.col("d.flow_definition")
    rows = parsed_events(log, "flow_definition").select(
        *_origin("pipeline_id", "pipeline_name", "flow_id", "flow_name"),
        defined["output_dataset"].alias("target_table_name"),
        defined["is_streaming"].alias("is_streaming"),
    )
    return rows.distinct()


def dataset_definitions(log: DataFrame) -> DataFrame:
    defined = F.col("d.dataset_definition")
    rows = parsed_events(log, "dataset_definition").select(
        *_origin("pipeline_id", "pipeline_name", "flow_id"),
        defined["source_type"].alias("source_type"),
        defined["path"].alias("source_path"),
    )
    return rows.distinct()


def operation_progress(log: DataFrame) -> DataFrame:
    loader = F.col("d.operation_progress.auto_loader_details")
    return parsed_events(log, "operation_progress").filter(loader.isNotNull()).select(
        *_origin("pipeline_id", "pipeline_name", "update_id", "flow_id"),
        F.col("timestamp").alias("event_time"),
        loader["num_files_listed"].alias("num_files_listed"),
        loader["num_files_processed"].alias("num_files_processed"),
    )


def event_log_summary(log: DataFrame) -> DataFrame:
    """Tables, cluster and minutes per pipeline, job and update, from events that frame an update."""
    info = F.col("d.cluster_resources.default_cluster_info")
    rows = log.filter(F.col("event_type").isin("create_update", "update_complete", "update_failed")).withColumn(
        "d", F.from_json("details", DETAILS)
    )
    faced = rows.select(
        "timestamp",
        *_origin("update_id", "pipeline_id", "pipeline_name"),
        F.coalesce(info["job_id"], info["cluster_id"]).alias("job_id"),
        info["cluster_name"].alias("cluster_type"),
        F.col("d.flow_progress.metrics.output_table").alias("output_table"),
        info["idle_minutes"].alias("idle_minutes"),
        info["active_minutes"].alias("active_minutes"),
    )
    grouped = faced.groupBy("pipeline_id", "pipeline_name", "job_id", "update_id").agg(
        F.max("output_table").alias("output_table"),
        F.max("cluster_type").alias("cluster_type"),
        F.sum("idle_minutes").alias("idle_minutes"),
        F.sum("active_minutes").alias("active_minutes"),
        F.max("timestamp").alias("update_time"),
    )
    return grouped.drop("update_id")
