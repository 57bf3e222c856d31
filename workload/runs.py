"""Queries over the run event log."""

from __future__ import annotations

from gneiss.plans import dq, event_log, runs
from workload.registry import query
from workload.shapes import LOG_DAY, PROCESSED
from workload.sql_shapes import DQ, LOG, RUNS_PER_UPDATE, rounded, run_summary


def with_log(*parts: str) -> str:
    return "WITH " + ",".join([LOG, *parts])


@query(with_log() + """ SELECT TIMESTAMP '2024-02-01' AS loaded_at, pipeline_name,
    CASE step WHEN 0 THEN 'update_progress' WHEN 6 THEN 'update_progress' WHEN 1 THEN 'flow_definition' WHEN 2 THEN 'dataset_definition'
      WHEN 4 THEN 'operation_progress' WHEN 7 THEN CASE final WHEN 'FAILED' THEN 'update_failed' WHEN 'CANCELED' THEN 'create_update' ELSE 'update_complete' END
      ELSE 'flow_progress' END AS event_type,
    ts AS timestamp, update_id, 'org1' AS workspace_id, 'AWS' AS cloud,
    CASE WHEN step IN (3, 5) THEN CAST(amount * 1000 AS VARCHAR) END AS backlog_bytes,
    CASE WHEN step = 3 AND u % 7 = 0 THEN '[]' WHEN step = 3 AND u % 7 > 1 THEN
      '[{"name":"valid_wind","status":"COMPLETED","violated_records":' || (amount % 50) || ',"passed_records":' || amount || ',"failed_records":' || (amount % 50)
      || ',"dropped_records":' || (amount % 20) || ',"metrics":{"null_count":' || (amount % 9) || ',"total_records":' || amount
      || '}},{"name":"valid_time","status":"COMPLETED","passed_records":' || amount || '}]' END AS dq_expectations,
    CASE WHEN step = 7 THEN 'START' END AS user_action, CASE WHEN step = 7 THEN CAST(amount % 8 AS VARCHAR) END AS autoscale_exec,
    CASE WHEN step = 4 AND pipe IN (1, 2) THEN CAST(amount AS VARCHAR) END AS auto_loader_file_count
  FROM log""")
def clean_event_log(t):
    return event_log.clean_event_log(t.event_log(), PROCESSED)


@query(with_log() + " SELECT pipeline_id, pipeline_name, update_id, flow_id, flow_name, event_time, status, backlog_bytes, input_rows, output_rows FROM flow_ev")
def flow_events(t):
    return event_log.flow_events(t.event_log())


@query(with_log() + """ SELECT pipeline_id, pipeline_name, update_id, event_time, update_state, CASE step WHEN 6 THEN amount END AS total_input_rows,
    CASE step WHEN 6 THEN amount END AS total_output_rows FROM update_ev""")
def update_events(t):
    return event_log.update_events(t.event_log())


@query(with_log() + """ SELECT DISTINCT pipeline_id, pipeline_name, flow_id, flow_name, CASE WHEN pipe <> 4 THEN 'silver.t_' || flow END AS target_table_name,
    pipe IN (0, 2) AS is_streaming FROM log WHERE step = 1 AND pipeline_name IS NOT NULL""")
def flow_definitions(t):
    return event_log.flow_definitions(t.event_log())


@query(with_log() + """ SELECT DISTINCT pipeline_id, pipeline_name, flow_id, CASE pipe WHEN 1 THEN 'autoloader' ELSE 'table' END AS source_type,
    '/landing/' || flow AS source_path FROM log WHERE step = 2 AND pipeline_name IS NOT NULL""")
def dataset_definitions(t):
    return event_log.dataset_definitions(t.event_log())


@query(with_log() + """ SELECT pipeline_id, pipeline_name, update_id, flow_id, ts AS event_time, amount AS num_files_listed, amount AS num_files_processed
    FROM log WHERE step = 4 AND pipe IN (1, 2) AND pipeline_name IS NOT NULL""")
def operation_progress(t):
    return event_log.operation_progress(t.event_log())


@query(with_log() + " SELECT * FROM update_runtimes")
def update_runtimes(t):
    return runs.update_runtimes(t.event_log())


@query(with_log() + " SELECT * FROM latest")
def latest_updates(t):
    return runs.latest_updates(runs.update_runtimes(t.event_log()))


@query(with_log() + " SELECT * FROM retries")
def retry_counts(t):
    return runs.retry_counts(runs.update_runtimes(t.event_log()), LOG_DAY)


@query(with_log(run_summary()) + " SELECT * FROM summary")
def run_summary_daily(t):
    return runs.pipeline_summary(t.event_log(), LOG_DAY)


@query(with_log(run_summary("pipeline_id <> 'p3'")) + " SELECT * FROM summary")
def summarise_registered(t):
    return runs.summarise_registered(t.registry(), t.event_log(), LOG_DAY)


@query(f"""WITH r AS (
    SELECT 'pipe_' || user_id AS pipeline_name, event_type, value * 10 AS backlog, (event_id % 90)::DOUBLE AS minutes, event_id % 3 AS retries,
           event_id % 40 AS target, ts FROM events)
  SELECT DATE '2024-01-30' AS summary_date, pipeline_name, (SELECT count(DISTINCT pipeline_name) FROM r) AS total_pipelines,
         count(*) FILTER (WHERE event_type = 'error') AS pipelines_failed_today, max(backlog) AS streaming_backlog_mb,
         {rounded('avg(minutes)')} AS avg_runtime_minutes, CAST(sum(retries) AS BIGINT) AS retry_count_7d, max(minutes) AS longest_runtime_minutes,
         count(*) FILTER (WHERE event_type = 'click') AS pipelines_with_autoloader, count(DISTINCT target) AS tables_created,
         count(*) FILTER (WHERE event_type = 'view') AS active_streaming_pipelines, max(ts) FILTER (WHERE event_type = 'error') AS last_failure_ts
  FROM r GROUP BY pipeline_name""")
def run_summary_flat(t):
    return runs.pipeline_summary_flat(t.flat_runs(), LOG_DAY)


@query(with_log(run_summary()) + """ SELECT count(DISTINCT pipeline_name) AS total_pipelines, CAST(sum(pipelines_failed_today) AS BIGINT) AS pipelines_failed_today,
    sum(streaming_backlog_mb) AS streaming_backlog_mb, avg(avg_runtime_minutes) AS avg_runtime_minutes, CAST(sum(retry_count_7d) AS BIGINT) AS retry_count_7d,
    max(longest_runtime_minutes) AS longest_runtime_minutes, CAST(sum(pipelines_with_autoloader) AS BIGINT) AS pipelines_with_autoloader,
    CAST(sum(tables_created) AS BIGINT) AS tables_created, CAST(sum(active_streaming_pipelines) AS BIGINT) AS active_streaming_pipelines,
    max(last_failure_ts) AS last_failure_ts FROM summary""")
def run_kpis(t):
    return runs.run_kpis(runs.pipeline_summary(t.event_log(), LOG_DAY), LOG_DAY)


@query(with_log(RUNS_PER_UPDATE) + " SELECT * FROM log_summary")
def event_log_summary(t):
    return event_log.event_log_summary(t.event_log())


def with_dq() -> str:
    return with_log(DQ)


@query(with_dq() + " SELECT * FROM violations")
def dq_violations(t):
    return dq.dq_violations(t.event_log())


@query(with_dq() + " SELECT * FROM dq_summary")
def dq_summary(t):
    return dq.dq_summary(dq.dq_violations(t.event_log()))


@query(with_dq() + f""" SELECT count(DISTINCT expectation) AS expectations_defined,
    {rounded('100.0::DOUBLE * sum(passed_expectations) / nullif(sum(passed_expectations + failed_expectations), 0)')} AS pass_pct,
    {rounded('100.0::DOUBLE * sum(violated_records) / nullif(sum(violated_records + passed_expectations), 0)')} AS violation_pct,
    count(DISTINCT CASE WHEN violated_records > 0 THEN dataset END) AS datasets_violated, CAST(sum(dropped_records) AS BIGINT) AS dropped_records,
    {rounded('avg(null_count * 100.0::DOUBLE / nullif(record_count, 0))')} AS avg_null_pct
  FROM violations WHERE dq_date = DATE '2024-01-30'""")
def dq_kpis(t):
    return dq.dq_kpis(dq.dq_violations(t.event_log()), LOG_DAY)


@query(with_dq() + f""", scores AS (
    SELECT dq_date, {rounded('sum(passed_expectations)::DOUBLE / nullif(sum(passed_expectations + failed_expectations), 0) * 10', 1)} AS score
    FROM dq_summary WHERE dq_date BETWEEN DATE '2024-01-26' AND DATE '2024-01-30' GROUP BY dq_date)
  SELECT {rounded('100.0 * (max(score) - min(score)) / nullif(min(score), 0)')} AS trend_percent FROM scores""")
def dq_trend(t):
    return dq.dq_trend(dq.dq_summary(dq.dq_violations(t.event_log())), LOG_DAY)


@query(with_dq() + """ SELECT expectation, count(*) AS total_violations FROM violations WHERE dq_date = DATE '2024-01-30'
  GROUP BY expectation ORDER BY total_violations DESC, expectation LIMIT 1""")
def top_expectation(t):
    return dq.top_expectation(dq.dq_violations(t.event_log()), LOG_DAY)
