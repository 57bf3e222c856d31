"""Run plans against straightforward evaluations of their definition on small logs."""

import datetime as dt
import json
import random

import pytest

from gneiss.plans import dq, event_log, runs

ORIGIN = "pipeline_id STRING, pipeline_name STRING, update_id STRING, flow_id STRING, flow_name STRING, dataset_name STRING, org_id STRING, cloud STRING"
SCHEMA = f"id STRING, timestamp TIMESTAMP, event_type STRING, origin STRUCT<{ORIGIN.replace(' STRING', ': STRING')}>, details STRING"
DAY = dt.datetime(2024, 1, 30)


def event(i, at, kind, details, pipe="p", name="n", update="u", flow="f", dataset="d"):
    return (f"e{i}", at, kind, (pipe, name, update, flow, flow, dataset, "o", "AWS"), details if isinstance(details, str) else json.dumps(details))


def update_row(i, at, state, **origin):
    return event(i, at, "update_progress", {"update_progress": {"state": state}}, **origin)


def log_frame(spark, events):
    return spark.createDataFrame(events, SCHEMA)


def expected_runtimes(events):
    """Each start against all events of its update, as the definition says."""
    ev = [(e[3][0], e[3][1], e[3][2], e[1], json.loads(e[4])["update_progress"].get("state")) for e in events if e[3][1]]
    out = set()
    for pid, name, uid, at, state in ev:
        if state != "RUNNING":
            continue
        seen = {}
        for p, _, u, t, s in ev:
            if p is not None and u is not None and (p, u) == (pid, uid) and t >= at:
                seen.setdefault(s, []).append(t)
        for s, times in seen.items():
            out.add((pid, name, uid, at, min(times) if s in runs.FINAL_STATES else max(times), s))
        if not seen:
            out.add((pid, name, uid, at, None, None))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_update_runtimes(spark, seed):
    rng = random.Random(seed)
    states = ["RUNNING", "RUNNING", "COMPLETED", "FAILED", "CANCELED", "STOPPING", None]
    events = []
    for i in range(120):
        pipe = rng.choice(["p1", "p2", None])
        events.append(update_row(
            i, DAY + dt.timedelta(seconds=rng.randint(0, 60)), rng.choice(states),
            pipe=pipe, name=rng.choice(["n1", "n2", None]), update=rng.choice(["u1", "u1", "u1", "u2", None]),
        ))
    got = runs.update_runtimes(log_frame(spark, events)).collect()
    want = expected_runtimes(events)
    assert len(got) == len(want)
    assert {(r.pipeline_id, r.pipeline_name, r.update_id, r.update_start_time, r.update_end_time, r.final_state) for r in got} == want
    for r in got:
        spent = None if r.update_end_time is None else (r.update_end_time - r.update_start_time).total_seconds() / 60
        assert r.runtime_minutes == (None if spent is None else pytest.approx(spent))


RUN = "pipeline_id STRING, pipeline_name STRING, update_id STRING, update_start_time TIMESTAMP, update_end_time TIMESTAMP, final_state STRING, runtime_minutes DOUBLE"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_retry_counts(spark, rows, seed):
    rng = random.Random(seed)
    data = []
    for i in range(80):
        start = DAY - dt.timedelta(hours=rng.randint(0, 12 * 24))
        if rng.random() < 0.3:
            start = start.replace(hour=0)
        data.append((
            rng.choice(["p1", "p2", None]), rng.choice(["n1", "n2"]), f"u{rng.randint(0, 40)}", start,
            start + dt.timedelta(hours=rng.randint(0, 5)), rng.choice(["COMPLETED", "FAILED", "RUNNING"]), 1.0,
        ))
    retried = {
        b[2] for a in data for b in data
        if a[0] is not None and a[:2] == b[:2] and a[5] == "FAILED" and b[5] == "COMPLETED"
        and a[4] < b[3] <= (a[4] + dt.timedelta(days=1)).replace(hour=0, minute=0, second=0)
    }
    want = {}
    for r in data:
        if r[5] == "COMPLETED" and r[3] >= DAY - dt.timedelta(days=7) and r[2] in retried:
            want.setdefault(r[:2], set()).add(r[2])
    got = rows(runs.retry_counts(spark.createDataFrame(data, RUN), "2024-01-30"))
    assert got == sorted(((*k, len(v)) for k, v in want.items()), key=repr)


def test_latest_update_breaks_ties_and_skips_open_runs(spark, rows):
    early, late = DAY, DAY + dt.timedelta(hours=1)
    data = [
        ("p", "n", "u1", early, late, "COMPLETED", 60.0), ("p", "n", "u2", early, late, "FAILED", 50.0),
        ("p", "n", "u3", early, None, None, None), ("q", "n", "u4", early, early, "RUNNING", 0.0),
    ]
    assert rows(runs.latest_updates(spark.createDataFrame(data, RUN)), "pipeline_id", "update_id") == [("p", "u1"), ("q", "u4")]


def flow_row(i, at, status, backlog, **origin):
    return event(i, at, "flow_progress", {"flow_progress": {"status": status, "metrics": {"backlog_bytes": backlog}}}, **origin)


def small_log():
    h = dt.timedelta(hours=1)
    return [
        update_row(1, DAY - 5 * h, "RUNNING", update="u1"), update_row(2, DAY - 4 * h, "FAILED", update="u1"),
        update_row(3, DAY + 1 * h, "RUNNING", update="u2"), update_row(4, DAY + 2 * h, "COMPLETED", update="u2"),
        flow_row(5, DAY + 1 * h, "RUNNING", 1024 * 1024 * 9), flow_row(6, DAY + 2 * h, "COMPLETED", 1024 * 1024 * 10),
        flow_row(7, DAY - 4 * h, "FAILED", 5),
        event(8, DAY, "flow_definition", {"flow_definition": {"output_dataset": "t1", "is_streaming": True}}),
        event(9, DAY, "flow_definition", {"flow_definition": {"output_dataset": "t1", "is_streaming": True}}),
        event(10, DAY, "flow_definition", {"flow_definition": {"output_dataset": "t2", "is_streaming": False}}, flow="g"),
        event(11, DAY, "dataset_definition", {"dataset_definition": {"source_type": "autoloader", "path": "/x"}}),
        event(12, DAY, "operation_progress", {"operation_progress": {"auto_loader_details": {"num_files_listed": 3}}}),
        event(13, DAY, "operation_progress", {"operation_progress": {}}),
        update_row(14, DAY - dt.timedelta(days=9), "RUNNING", pipe="old", name="idle", update="u9"),
        flow_row(15, DAY, "RUNNING", 1, name=None),
    ]


def test_pipeline_summary(spark):
    log = log_frame(spark, small_log())
    only = runs.pipeline_summary(log, "2024-01-30").collect()
    assert len(only) == 1
    row = only[0].asDict()
    assert row["summary_date"] == dt.date(2024, 1, 30) and row["pipeline_name"] == "n" and row["total_pipelines"] == 1
    assert row["pipelines_failed_today"] == 0 and row["streaming_backlog_mb"] == 10.0
    # Spans: u1 RUNNING 0 and FAILED 60, u2 RUNNING 0 and COMPLETED 60 minutes.
    assert row["avg_runtime_minutes"] == 30.0 and row["longest_runtime_minutes"] == 60.0 and row["latest_runtime_minutes"] == 60.0
    assert row["retry_count_7d"] == 0  # the failure ended the day before
    assert (row["pipelines_with_autoloader"], row["tables_created"], row["active_streaming_pipelines"]) == (1, 2, 1)
    assert row["last_failure_ts"] == DAY - dt.timedelta(hours=4)
    metrics = {r.status for r in runs.pipeline_metrics(log, "2024-01-30", status="latest").collect() if r.pipeline_name == "n"}
    assert metrics == {"COMPLETED"}
    assert {r.status for r in runs.pipeline_metrics(log, "2024-01-30").collect() if r.pipeline_name == "n"} == {"RUNNING"}
    with pytest.raises(ValueError):
        runs.pipeline_metrics(log, status="first")


def test_kpis_are_one_row(spark):
    summary = runs.pipeline_summary(log_frame(spark, small_log()), "2024-01-30")
    assert runs.run_kpis(summary, "2024-01-30").collect()[0].total_pipelines == 1
    assert runs.run_kpis(summary, "2020-01-01").collect()[0].total_pipelines == 0


def test_registry_switch(spark):
    log = log_frame(spark, small_log())
    registry = spark.createDataFrame([("p", False), ("old", True)], "pipeline_id STRING, log_enabled BOOLEAN")
    assert runs.summarise_registered(registry, log, "2024-01-30").count() == 0
    registry = spark.createDataFrame([("p", True)], "pipeline_id STRING, log_enabled BOOLEAN")
    assert runs.summarise_registered(registry, log, "2024-01-30").count() == 1


def test_event_log_summary_falls_back_to_the_cluster(spark, rows):
    def cluster(**info):
        return {"cluster_resources": {"default_cluster_info": info}, "flow_progress": {"metrics": {"output_table": "t"}}}

    log = log_frame(spark, [
        event(1, DAY, "create_update", cluster(cluster_id="c", cluster_name="single", idle_minutes=1, active_minutes=2, job_id="j")),
        event(2, DAY, "update_complete", cluster(cluster_id="c", cluster_name="single", idle_minutes=3, active_minutes=4, job_id="j")),
        event(3, DAY, "update_failed", cluster(cluster_id="c"), update="u2"),
        event(4, DAY, "flow_progress", cluster(cluster_id="c")),
    ])
    assert rows(event_log.event_log_summary(log), "job_id", "output_table", "cluster_type", "idle_minutes", "active_minutes") == [
        ("c", "t", None, None, None), ("j", "t", "single", 4.0, 6.0),
    ]


def test_log_plans_use_no_python(spark, plan):
    log = log_frame(spark, small_log())
    for df in (runs.pipeline_summary(log, "2024-01-30"), dq.dq_violations(log), event_log.event_log_summary(log)):
        assert "Python" not in plan(df)


def test_dq_violations_fallbacks(spark, rows):
    def report(expectations, **metrics):
        return {"flow_progress": {"metrics": metrics, "data_quality": {"expectations": expectations}}}

    rule = {"name": "r", "status": "OK", "violated_records": 2, "passed_records": 8, "failed_records": 2, "metrics": {"null_count": 1, "total_records": 10}}
    log = log_frame(spark, [
        event(1, DAY, "flow_definition", {"flow_definition": {"output_dataset": "out"}}, flow="f1"),
        event(2, DAY, "flow_definition", {"flow_definition": {}}, flow="f2", dataset="ds"),
        event(3, DAY, "flow_progress", report([rule], output_rows=5), flow="f1"),
        event(4, DAY, "flow_progress", report([{"name": "r"}], output_rows=5, input_rows=6), flow="f2"),
        event(5, DAY, "flow_progress", report([{"name": "r"}], input_rows=6), flow="f3"),
        event(6, DAY, "flow_progress", report([]), flow="f1"),
        event(7, DAY, "flow_progress", report(None), flow="f1"),
        event(8, DAY, "flow_progress", {"flow_progress": {}}, flow="f1"),
    ])
    found = dq.dq_violations(log)
    assert rows(found, "event_id", "dataset", "violated_records", "passed_expectations", "dropped_records", "null_count", "record_count") == [
        ("e3", "out", 2, 8, 0, 1, 10), ("e4", "ds", 0, 0, 0, 0, 5), ("e5", "f3", 0, 0, 0, 0, 6),
    ]
    kpis = dq.dq_kpis(found, "2024-01-30").collect()[0]
    assert (kpis.pass_pct, kpis.violation_pct, kpis.datasets_violated, kpis.avg_null_pct) == (80.0, 20.0, 1, 3.33)
    assert dq.dq_kpis(found, "2020-01-01").collect()[0].pass_pct is None
    assert rows(dq.top_expectation(found, "2024-01-30")) == [("r", 3)]


def test_dq_trend_guards(spark):
    def summary(*scores):
        return spark.createDataFrame([(dt.date(2024, 1, 26 + i), p, f) for i, (p, f) in enumerate(scores)], "dq_date DATE, passed_expectations BIGINT, failed_expectations BIGINT")

    def trend(df, **more):
        return dq.dq_trend(df, "2024-01-30", **more).collect()[0][0]

    assert trend(summary((8, 2), (10, 0))) == 25.0
    assert trend(summary((0, 10), (10, 0))) is None
    assert trend(summary((1, 9), (10, 0)), guard="reference") is None
    assert trend(summary((1, 9), (10, 0))) == 900.0
