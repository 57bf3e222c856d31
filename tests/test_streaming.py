import datetime as dt

import pytest
from pyspark.sql import functions as F

from gneiss.operators import changes
from gneiss.sources import readers
from gneiss.streaming import batches, merge, progress, runner, updates, windows

SCHEMA = "k INT, seq INT, v STRING, op STRING"


@pytest.fixture
def land(spark, tmp_path):
    """Land rows as one more file of the stream's input."""

    def write(data, schema=SCHEMA):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    return write


def stream(spark, tmp_path, schema=SCHEMA, **limits):
    return readers.stream_files(spark, str(tmp_path / "in"), "parquet", schema, **limits)


def test_merge_restarts_and_keeps_the_newest(spark, rows, tmp_path, land):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema

    def run():
        runner.wait(merge.stream_merge(stream(spark, tmp_path), path, "k", "seq", str(tmp_path / "c"), order_by=[F.col("v").asc()]))
        return rows(batches.read_newest(spark, path, "k", "seq", schema), "k", "seq", "v")

    land([(1, 1, "a", None), (1, 2, "b", None), (2, 1, "c", None)])
    assert run() == [(1, 2, "b"), (2, 1, "c")]
    land([(1, 1, "late", None), (2, 1, "equal", None), (3, 1, "d", None)])
    assert run() == [(1, 2, "b"), (2, 1, "c"), (3, 1, "d")]
    land([(2, 5, "e", None)])
    assert run() == [(1, 2, "b"), (2, 5, "e"), (3, 1, "d")]
    batches.fold_batches(spark, path, str(tmp_path / "folded"), "k", "seq")
    path = str(tmp_path / "folded")
    land([(2, 5, "equal", None), (3, 9, "f", None), (None, 1, "n", None)])
    assert run() == sorted([(1, 2, "b"), (2, 5, "e"), (3, 9, "f"), (None, 1, "n")], key=repr)
    assert spark.read.parquet(path).filter("batch_id = -1").count() == 3


def test_a_replayed_batch_changes_nothing(spark, rows, tmp_path, land):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema
    land([(1, 1, "a", None), (2, 1, "b", None)])
    for checkpoint in ("c1", "c2"):  # a second checkpoint replays batch 0 from scratch
        runner.wait(merge.stream_merge(stream(spark, tmp_path), path, "k", "seq", str(tmp_path / checkpoint)))
    assert spark.read.parquet(path).count() == 2
    assert rows(batches.read_newest(spark, path, "k", "seq", schema), "k") == [(1,), (2,)]


def test_scd1_stream_equals_batch_with_deletes_and_late_rows(spark, rows, tmp_path, land):
    path = str(tmp_path / "t")
    first = [(1, 1, "a", "U"), (2, 5, None, "D"), (3, 1, "c", "U"), (1, 3, "b", "U")]
    second = [(2, 4, "late", "U"), (3, 2, None, "D"), (1, 2, "late", "U"), (4, 1, "d", "U")]
    for data in (first, second):
        land(data)
        runner.wait(merge.stream_scd1(stream(spark, tmp_path), path, "k", "seq", str(tmp_path / "c"), "op = 'D'"))
    streamed = rows(batches.read_newest(spark, path, "k", "seq"), "k", "seq", "v")
    empty = spark.createDataFrame([], "k INT, seq INT, v STRING")
    batch, _ = changes.scd1_apply(empty, spark.createDataFrame(first + second, SCHEMA), "k", "seq", "op = 'D'")
    assert streamed == rows(batch) == [(1, 3, "b"), (4, 1, "d")]


def test_rate_limits_make_batches(spark, tmp_path, land):
    for i in range(3):
        land([(i, i, "x", None)])
    log = progress.ProgressLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        query = runner.run_stream_append(stream(spark, tmp_path, max_files=1), str(tmp_path / "out"), str(tmp_path / "c"), name="limited")
        assert runner.wait(query)
        log.flush(query)
    finally:
        spark.streams.removeListener(log)
    report = progress.progress_table(spark.read.text(str(tmp_path / "log")), "value").filter("input_rows > 0").collect()
    assert [(r.query_name, r.input_rows) for r in report] == [("limited", 1)] * 3 and all(r.late_rows == 0 for r in report)
    assert runner.find_active(spark, "limited") is None and not runner.stop_active(spark, "limited")
    with pytest.raises(ValueError):
        stream(spark, tmp_path, max_files=1, max_bytes="2mb")
    assert stream(spark, tmp_path, max_bytes="100k").isStreaming


def test_active_query_by_name(spark, tmp_path, land):
    land([(1, 1, "x", None)])
    query = runner.run_stream_append(
        stream(spark, tmp_path), None, str(tmp_path / "c"), {"processingTime": "1 second"}, name="ticking", fmt="memory"
    )
    try:
        query.processAllAvailable()
        assert runner.find_active(spark, "ticking").id == query.id and spark.table("ticking").count() == 1
        assert not runner.wait(query, timeout=1)
    finally:
        assert runner.stop_active(spark, "ticking")


def test_falling_behind_and_late_rows_in_a_report(spark):
    documents = [('{"name": "q", "batchId": 1, "numInputRows": 5, "inputRowsPerSecond": 9.0, "processedRowsPerSecond": 3.0, '
                  '"durationMs": {"triggerExecution": 70}, "stateOperators": [{"numRowsDroppedByWatermark": 2}, {"numRowsDroppedByWatermark": 1}]}',),
                 ('{"batchId": 2, "numInputRows": 0}',)]
    got = progress.progress_table(spark.createDataFrame(documents, "document STRING")).orderBy("batch_id").collect()
    assert (got[0].falling_behind, got[0].late_rows, got[0].duration_ms) == (True, 3, 70)
    assert (got[1].falling_behind, got[1].late_rows) == (False, 0)


READINGS = "post_code STRING, startTime STRING, temperature BIGINT, probabilityOfPrecipitation STRUCT<unitCode: STRING, value: BIGINT>"


def test_late_rows_are_dropped_and_open_windows_wait(spark, tmp_path, land):
    def reading(at):
        return ("1", f"2024-01-01T{at}:00-05:00", 10, ("%", 5))

    for batch in ([reading("10:10")], [reading("14:00")], [reading("10:20"), reading("13:10")]):
        land(batch, READINGS)
        rows_in = windows.with_start_ts(stream(spark, tmp_path, READINGS))
        runner.wait(runner.run_stream_append(windows.weather_window_stats(rows_in), str(tmp_path / "out"), str(tmp_path / "c")))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.window_start.hour, r.window_start.minute, r.forecast_count) for r in got] == [(9, 30, 1), (10, 0, 1)]
    batch = windows.weather_window_stats(windows.with_start_ts(spark.read.schema(READINGS).parquet(str(tmp_path / "in"))))
    assert batch.count() == 6


def test_append_batches_overwrite_their_own_output(spark, tmp_path, land):
    land([(1, 1, "x", None)])
    for checkpoint in ("a", "b"):
        runner.wait(merge.stream_append_batches(stream(spark, tmp_path), lambda b: b, str(tmp_path / "out"), str(tmp_path / checkpoint)))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


LOGGED = "event_type STRING, timestamp TIMESTAMP, origin STRUCT<pipeline_id: STRING, pipeline_name: STRING, update_id: STRING>, details STRING"


def test_runtimes_of_updates_on_a_stream(spark, rows, tmp_path, land):
    def at(hours):
        return f"2024-01-01 {hours // 60:02d}:{hours % 60:02d}:00" if hours < 1440 else f"2024-01-{1 + hours // 1440:02d} {hours % 1440 // 60:02d}:{hours % 60:02d}:00"

    def event(update, state, minutes, pipeline="p1"):
        return ("update_progress", dt.datetime.fromisoformat(at(minutes)), (pipeline, "one", update), '{"update_progress":{"state":"%s"}}' % state)

    def run():
        found = updates.stream_update_runtimes(stream(spark, tmp_path, LOGGED), "1 hour", "1 day")
        runner.wait(runner.run_stream_append(found, str(tmp_path / "out"), str(tmp_path / "c")))
        return rows(spark.read.parquet(str(tmp_path / "out")), "update_id", "final_state", "runtime_minutes")

    land([event("u1", "RUNNING", 0), event("u1", "COMPLETED", 30), event("u2", "RUNNING", 40), event("lost", "RUNNING", 50)], LOGGED)
    assert run() == [("u1", "COMPLETED", 30.0)]
    # The end of an update may come after a restart; one of another pipeline with its id doesn't count.
    land([event("u2", "FAILED", 100), event("u2", "FAILED", 90, "p2"), event("u3", "RUNNING", 200), event("u3", "RUNNING", 200, None)], LOGGED)
    assert run() == [("u1", "COMPLETED", 30.0), ("u2", "FAILED", 60.0)]
    # Two days later what never ended is given out, once.
    land([event("u4", "RUNNING", 4000), event("u4", "COMPLETED", 4001), event("u4", "CANCELED", 4003)], LOGGED)
    late = [("u1", "COMPLETED", 30.0), ("u2", "FAILED", 60.0), ("u4", "CANCELED", 3.0), ("u4", "COMPLETED", 1.0), ("lost", None, None), ("u3", None, None), ("u3", None, None)]
    assert run() == sorted(late, key=repr)
    assert run() == sorted(late, key=repr)
    # As a batch, unfinished starts are there at once.
    batch = updates.stream_update_runtimes(spark.read.schema(LOGGED).parquet(str(tmp_path / "in")))
    assert sorted(map(repr, [tuple(r) for r in batch.select("update_id", "final_state", "runtime_minutes").collect()])) == sorted(map(repr, late))


def test_replays_in_later_batches_leave_one_row(spark, rows, tmp_path, land):
    schema = "k INT, at TIMESTAMP, v STRING"

    def run():
        runner.wait(runner.run_stream_append(updates.once(stream(spark, tmp_path, schema), "k", "at", "2 hours"), str(tmp_path / "out"), str(tmp_path / "c")))
        return rows(spark.read.parquet(str(tmp_path / "out")), "k", "v")

    def moment(hour, minute=0):
        return dt.datetime(2024, 1, 1, hour, minute)

    land([(1, moment(1), "a"), (1, moment(1), "a"), (2, moment(2), "b"), (None, moment(2), "n"), (None, moment(2), "n")], schema)
    assert run() == [(1, "a"), (2, "b"), (None, "n")]
    land([(2, moment(2), "b"), (3, moment(3), "c"), (2, moment(2, 30), "again")], schema)
    assert run() == [(1, "a"), (2, "b"), (3, "c"), (None, "n")]
    # Behind the watermark a replay is late and goes; a new event of a key whose state is gone counts anew.
    land([(9, moment(12), "d")], schema)
    run()
    land([(3, moment(3), "c"), (2, moment(13), "new")], schema)
    assert run() == sorted([(1, "a"), (2, "b"), (2, "new"), (3, "c"), (9, "d"), (None, "n")], key=repr)


def test_reading_batches_is_one_scan_and_takes_new_columns(spark, rows, tmp_path, plan):
    path = str(tmp_path / "t")
    for batch in range(12):
        more = ", extra INT" if batch % 2 else ""
        data = [(batch % 5, batch, f"v{batch}", None, *([batch] if more else []))]
        batches.write_batch(spark.createDataFrame(data, SCHEMA + more), path, batch)
    got = batches.read_newest(spark, path, "k", "seq")
    assert rows(got, "k", "seq", "extra") == [(0, 10, None), (1, 11, 11), (2, 7, 7), (3, 8, None), (4, 9, 9)]
    assert plan(got).count("FileScan") <= 2  # rows with a key, and those without
    assert rows(batches.read_newest(spark, path, "k"), "k", "seq") == [(0, 10), (1, 11), (2, 7), (3, 8), (4, 9)]
