"""Queries that run a stream over time-ordered files until it has read all of them.

Their SQL counterparts are those of the batch plans: a stream must end where a batch does.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from gneiss.operators import changes, quality
from gneiss.plans import pii, silver
from gneiss.session import scratch_path
from gneiss.sources import discovery, tables
from gneiss.sources.readers import read_csv_by_header, resolve_schema, stream_file_names, stream_files
from gneiss.streaming import batches, merge, progress, runner, updates, windows
from workload.cdc import KEY, LATEST, order_feed
from workload.governance import TYPES
from workload.registry import query
from workload.shapes import PROCESSED, event_log_rows, forecast_rows
from workload.sql_shapes import FORECASTS, LOG, PII, SNAPSHOTS
from workload.sql_shapes import silver as silver_sql
from workload.weather import ALERTS, DROPPED, with_forecasts

WEEKS = ["2024-01-08", "2024-01-15", "2024-01-22"]


def in_slices(t, df, column, bounds, root, start):
    """Feed a table to a stream one range of a column at a time.

    Each range lands as any number of files and is read by a query that starts from the
    checkpoint of the one before, so a range is a micro-batch and every run is a restart.
    """
    edges = [None, *bounds, None]
    kind = df.schema[column].dataType
    for low, high in zip(edges, edges[1:]):
        rows = df if low is None else df.filter(F.col(column) >= F.lit(low).cast(kind))
        rows = rows if high is None else rows.filter(F.col(column) < F.lit(high).cast(kind))
        rows.write.mode("append").parquet(f"{root}/input")
        stream = stream_files(t.spark, f"{root}/input", "parquet", df.schema, glob="*.parquet")
        runner.wait(start(stream))


def by_week(t, root, start):
    """Feed the events of four weeks as forecasts."""
    in_slices(t, t.table("events"), "ts", WEEKS, root, lambda events: start(forecast_rows(events)))


@query(with_forecasts() + ALERTS)
def stream_alerts(t):
    root = scratch_path(t.spark, "stream-alerts")
    by_week(t, root, lambda rows: runner.run_stream_append(silver.alerts(rows, as_of=PROCESSED), f"{root}/out", f"{root}/checkpoint"))
    return t.spark.read.parquet(f"{root}/out")


@query(with_forecasts(silver_sql()) + " SELECT * FROM silver")
def stream_append(t):
    root = scratch_path(t.spark, "stream-append")

    def flatten(batch):
        return silver.silver_forecasts(batch, processed_at=PROCESSED)

    by_week(t, root, lambda rows: merge.stream_append_batches(rows, flatten, f"{root}/out", f"{root}/checkpoint"))
    return t.spark.read.parquet(f"{root}/out").drop("batch_id")


@query(with_forecasts(silver_sql(end_offset="own")) + f" SELECT * FROM silver WHERE {DROPPED}")
def stream_expect(t):
    """Rule-breaking rows dropped on a stream, violations observed on the way."""
    root = scratch_path(t.spark, "stream-expect")

    def checked(rows):
        flat = silver.silver_forecasts(rows, end_offset="own", processed_at=PROCESSED)
        return quality.expect(flat, silver.SILVER_RULES, "drop")

    by_week(t, root, lambda rows: runner.append_flow(rows, checked, f"{root}/out", f"{root}/checkpoint"))
    return t.spark.read.parquet(f"{root}/out")


@query("WITH " + ",".join([FORECASTS, silver_sql()]) + f" SELECT * EXCLUDE (rn) FROM (SELECT *, {LATEST} FROM silver) WHERE rn = 1")
def stream_merge(t):
    root = scratch_path(t.spark, "stream-merge")
    flatten, tie = partial(silver.silver_forecasts, processed_at=PROCESSED), [F.col("number").desc()]
    by_week(t, root, lambda rows: merge.stream_merge(
        flatten(rows), f"{root}/table", KEY, "audit_update_ts", f"{root}/checkpoint", order_by=tie
    ))
    schema = flatten(t.forecasts()).schema
    return batches.read_newest(t.spark, f"{root}/table", KEY, "audit_update_ts", schema)


@query("WITH " + SNAPSHOTS + " SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM snapshots WHERE version = 4")
def stream_scd1(t):
    """Inserts, updates and deletes of an order book, streamed one version at a time."""
    root = scratch_path(t.spark, "stream-scd1")
    first = t.snapshot(2).withColumns({
        "_change_type": F.lit(changes.INSERT), "_commit_version": F.lit(2).cast("bigint"), "_commit_timestamp": F.lit("1998-06-30").cast("timestamp"),
    })
    feed = first.unionByName(order_feed(t))
    deleted = F.col("_change_type") == changes.DELETE
    in_slices(t, feed, "_commit_version", [3, 4], root, lambda rows: merge.stream_scd1(
        rows, f"{root}/table", ["o_orderkey"], "_commit_version", f"{root}/checkpoint", deleted
    ))
    merged = batches.read_newest(t.spark, f"{root}/table", ["o_orderkey"], "_commit_version")
    return merged.drop(*changes.CHANGE_COLUMNS)


CLOSED_WINDOWS = with_forecasts() + r""", timed AS (SELECT *, CAST(regexp_replace(startTime, '[+-]\d{2}:\d{2}$', '') AS TIMESTAMP) AS start_ts FROM forecasts),
  slid AS (SELECT *, time_bucket(INTERVAL 30 MINUTE, start_ts) - o * INTERVAL 30 MINUTE AS window_start FROM timed, (VALUES (0), (1)) x(o))
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, post_code, avg(temperature) AS avg_temp, max(temperature) AS max_temp,
         min(temperature) AS min_temp, avg(pop) AS avg_precipitation, count(*) AS forecast_count
  FROM slid GROUP BY window_start, post_code
  HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(start_ts) FROM timed) - INTERVAL 2 HOUR"""


@query(CLOSED_WINDOWS)
def stream_window_stats(t):
    """Windows that the watermark has closed when the stream ends."""
    root = scratch_path(t.spark, "stream-windows")
    by_week(t, root, lambda rows: runner.run_stream_append(
        windows.weather_window_stats(windows.with_start_ts(rows)), f"{root}/out", f"{root}/checkpoint"
    ))
    return t.spark.read.parquet(f"{root}/out")


@query(with_forecasts() + r""", timed AS (SELECT *, CAST(regexp_replace(startTime, '[+-]\d{2}:\d{2}$', '') AS TIMESTAMP) AS start_ts FROM forecasts),
  slid AS (SELECT *, time_bucket(INTERVAL 30 MINUTE, start_ts) - o * INTERVAL 30 MINUTE AS window_start FROM timed, (VALUES (0), (1)) x(o))
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, post_code, avg(temperature) AS avg_temp, max(temperature) AS max_temp,
         min(temperature) AS min_temp, avg(pop) AS avg_precipitation, count(*) AS forecast_count
  FROM slid GROUP BY window_start, post_code""")
def window_stats(t):
    """The same windows over the whole table as a batch."""
    return windows.weather_window_stats(windows.with_start_ts(t.forecasts()))


def pii_stream(t, root):
    """The column metadata as a stream, in batches of the keys' ranges."""
    columns = t.columns_metadata()
    columns.repartition("schema_name").write.parquet(f"{root}/columns")
    return pii.tag_pii(stream_files(t.spark, f"{root}/columns", "parquet", columns.schema, max_files=2))


def complete(t, counts, root):
    """Counts in complete mode; every micro-batch replaces the result."""
    runner.wait(runner.run_stream_batches(
        counts, lambda batch, _: tables.materialize(batch, f"{root}/out"), f"{root}/checkpoint", mode="complete"))
    return t.spark.read.parquet(f"{root}/out")


@query("WITH " + PII + " SELECT schema_name, count(*) AS pii_column_count FROM tagged WHERE is_pii = 'Yes' GROUP BY schema_name")
def stream_pii_by_schema(t):
    root = scratch_path(t.spark, "stream-pii")
    return complete(t, pii.pii_by_schema(pii_stream(t, root)), root)


@query("WITH " + PII + TYPES + " SELECT pii_type, count(*) AS column_count FROM typed GROUP BY pii_type")
def stream_pii_types(t):
    """Counts in update mode: a batch holds the groups that changed, and the last state of each counts."""
    root = scratch_path(t.spark, "stream-types")
    counts = pii.pii_type_distribution(pii_stream(t, root))
    runner.wait(runner.run_stream_batches(
        counts, lambda batch, number: batches.write_batch(batch, f"{root}/table", number), f"{root}/checkpoint", mode="update"))
    return batches.read_newest(t.spark, f"{root}/table", ["pii_type"])


@query("WITH " + PII + " SELECT * FROM pii_hits")
def stream_pii_violations(t):
    """Tagged columns as a stream, joined with the grants as they stand."""
    root = scratch_path(t.spark, "stream-hits")
    found = pii.pii_violations(pii_stream(t, root), t.privileges())
    runner.wait(runner.run_stream_append(found, f"{root}/out", f"{root}/checkpoint"))
    return t.spark.read.parquet(f"{root}/out")


@query("WITH " + PII + " SELECT violation_type, count(*) AS total FROM pii_hits GROUP BY ALL")
def stream_violation_types(t):
    root = scratch_path(t.spark, "stream-violations")
    return complete(t, pii.violation_types(pii.pii_violations(pii_stream(t, root), t.privileges())), root)


@query(CLOSED_WINDOWS)
def stream_late_rows(t):
    """Rows that come again after the watermark has passed them change nothing."""
    root = scratch_path(t.spark, "stream-late")

    def start(rows):
        return runner.run_stream_append(windows.weather_window_stats(windows.with_start_ts(rows)), f"{root}/out", f"{root}/checkpoint")

    by_week(t, root, start)
    late = t.table("events").filter(F.col("ts") < F.lit(WEEKS[0]).cast("timestamp"))
    late.write.mode("append").parquet(f"{root}/input")
    runner.wait(start(forecast_rows(stream_files(t.spark, f"{root}/input", "parquet", late.schema, glob="*.parquet"))))
    return t.spark.read.parquet(f"{root}/out")


@query("""SELECT 1990 + c_custkey % 30 AS year, c_name AS first_name, 'county_' || c_nationkey AS county, CASE WHEN c_acctbal < 0 THEN 'M' ELSE 'F' END AS sex,
    CAST(c_custkey % 1000 AS INTEGER) AS count, CASE WHEN c_mktsegment >= 'F' THEN c_mktsegment END AS segment, true AS from_csv,
    TIMESTAMP '2024-02-01' AS audit_update_ts FROM customer""")
def names_stream(t):
    """Names from CSV files, of which later ones carry one more column in the middle."""
    root = scratch_path(t.spark, "names")
    rows = t.table("customer").select(
        (1990 + F.col("c_custkey") % 30).alias("Year"),
        F.col("c_name").alias("First Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.concat(F.lit("county_"), F.col("c_nationkey").cast("string")).alias("County"),
        F.when(F.col("c_acctbal") < 0, "M").otherwise("F").alias("Sex"),
        (F.col("c_custkey") % 1000).alias("Count"),
    )
    early = F.col("Segment") < "F"
    inbox, options = f"{root}/inbox", {"header": "true"}

    def load():
        schema = resolve_schema(t.spark, inbox, "csv", f"{root}/schema", inferSchema="true", **options)

        def handle(batch, number):
            # A micro-batch is a list of new files, as many as one trigger takes.
            files = [r["path"] for r in batch.collect()]
            named = silver.names_rows(read_csv_by_header(t.spark, files, schema), PROCESSED)
            batches.write_batch(named, f"{root}/table", number)

        runner.wait(runner.run_stream_batches(stream_file_names(t.spark, inbox, "*.csv", max_files=100), handle, f"{root}/checkpoint"))

    rows.filter(early).drop("Segment").write.mode("append").options(**options).csv(inbox)
    load()
    rows.filter(~early).write.mode("append").options(**options).csv(inbox)
    load()
    loaded = batches.read_batches(t.spark, f"{root}/table")
    return loaded.select(
        F.col("year").cast("bigint").alias("year"), "first_name", "county", "sex", "count", "segment",
        F.col("file_name").endswith(".csv").alias("from_csv"), "audit_update_ts",
    )


def recorded(t, label, plan, path="out"):
    """Run four weeks through a plan and return the progress documents of all micro-batches."""
    root = scratch_path(t.spark, label)
    log = progress.ProgressLog(t.spark, f"{root}/log")
    t.spark.streams.addListener(log)
    runs = []

    def start(rows):
        runs.append(runner.run_stream_append(plan(rows), f"{root}/{path}", f"{root}/checkpoint", name=label))
        return runs[-1]

    try:
        by_week(t, root, start)
        for run in runs:
            log.flush(run)
    finally:
        t.spark.streams.removeListener(log)
    return t.spark.read.text(f"{root}/log")


@query("""SELECT CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 0 WHEN ts < TIMESTAMP '2024-01-15' THEN 1 WHEN ts < TIMESTAMP '2024-01-22' THEN 2 ELSE 3 END::BIGINT AS batch_id,
    count(*) AS input_rows FROM events GROUP BY ALL""")
def stream_progress(t):
    """Rows per micro-batch as Spark reports them."""
    documents = recorded(t, "progress", lambda rows: silver.alerts(rows, as_of=PROCESSED))
    return progress.progress_table(documents, "value").filter("input_rows > 0").select("batch_id", "input_rows")


@query(with_forecasts(silver_sql(end_offset="own"), "rules AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS metric, ({p}) AS ok FROM silver" for n, p in silver.SILVER_RULES.items()) + ")")
    + """ SELECT metric, count(*) FILTER (WHERE ok IS NOT TRUE) AS total FROM rules GROUP BY metric
  UNION ALL SELECT 'total_records', count(*) FROM silver""")
def stream_expectation_counts(t):
    """Violations of each rule, counted on a stream that keeps all rows."""

    def checked(rows):
        return quality.expect(silver.silver_forecasts(rows, end_offset="own", processed_at=PROCESSED), silver.SILVER_RULES, "warn")

    documents = recorded(t, "expectations", checked)
    return progress.observed_counts(documents, "expectations", "value")


# A start whose end has not come is given out once the watermark, an hour behind the later of the last start and the
# last end that came, has passed the time by which it must have ended. Every 16th update never ends.
@query("WITH " + LOG + """, kept AS (SELECT * FROM update_ev WHERE NOT (step = 6 AND u % 16 = 3)),
  s AS (SELECT * FROM kept WHERE step = 0), e AS (SELECT * FROM kept WHERE step = 6),
  mark AS (SELECT least((SELECT max(ts) FROM s), (SELECT max(ts) FROM e)) - INTERVAL 1 HOUR AS passed),
  ended AS (SELECT s.pipeline_id, s.pipeline_name, s.update_id, s.ts AS update_start_time, e.ts AS update_end_time, e.update_state AS final_state
    FROM s LEFT JOIN e ON s.pipeline_id = e.pipeline_id AND s.update_id = e.update_id AND e.ts BETWEEN s.ts AND s.ts + INTERVAL 1 DAY)
  SELECT *, (epoch(date_trunc('second', update_end_time)) - epoch(date_trunc('second', update_start_time))) / 60.0::DOUBLE AS runtime_minutes
  FROM ended WHERE update_end_time IS NOT NULL OR update_start_time + INTERVAL 1 DAY < (SELECT passed FROM mark)""")
def stream_update_runtimes(t):
    """Run times as updates end, over restarts, with updates that never do."""
    root = scratch_path(t.spark, "stream-runtimes")
    events = t.table("events").filter(~((F.col("event_id") % 8 == 6) & (F.expr("event_id div 8") % 16 == 3)))
    in_slices(t, events, "ts", WEEKS, root, lambda rows: runner.run_stream_append(
        updates.stream_update_runtimes(event_log_rows(rows)), f"{root}/out", f"{root}/checkpoint"))
    return t.spark.read.parquet(f"{root}/out")


@query("SELECT event_id, ts::TIMESTAMP AS at, user_id, event_type FROM events")
def stream_once(t):
    """Events of which every week sends the last day of the week before once more, and some twice within a batch."""
    root = scratch_path(t.spark, "stream-once")
    events = t.table("events").select("event_id", F.col("ts").cast("timestamp").alias("at"), "user_id", "event_type")
    edges = [None, *WEEKS, None]
    for low, high in zip(edges, edges[1:]):
        rows = events if low is None else events.filter(F.col("at") >= F.date_sub(F.lit(low).cast("date"), 1).cast("timestamp"))
        rows = rows if high is None else rows.filter(F.col("at") < F.lit(high).cast("timestamp"))
        rows.union(rows.filter("event_id % 7 = 0")).write.mode("append").parquet(f"{root}/input")
        stream = stream_files(t.spark, f"{root}/input", "parquet", events.schema, glob="*.parquet")
        runner.wait(runner.run_stream_append(updates.once(stream, "event_id", "at", "2 days"), f"{root}/out", f"{root}/checkpoint"))
    return t.spark.read.parquet(f"{root}/out")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_type = 'error' THEN user_id END AS who_user,
    CASE WHEN event_type = 'error' THEN 'm' || (event_id % 5) END AS who_mail, CASE WHEN event_type = 'error' THEN (event_id % 3 + 0.5)::DOUBLE ELSE (event_id % 3)::DOUBLE END AS load FROM events""")
def discovered_details(t):
    """Documents whose later batch brings an object and a wider number, read by the schema that has grown to hold both."""
    folder = scratch_path(t.spark, "discovered")
    more = F.concat(F.lit(',"load":'), (F.col("event_id") % 3).cast("string"), F.when(F.col("event_type") == "error", F.concat(
        F.lit('.5,"who":{"user":'), F.col("user_id").cast("string"), F.lit(',"mail":"m'), (F.col("event_id") % 5).cast("string"), F.lit('"}'))).otherwise(F.lit("")), F.lit("}"))
    rows = t.table("events").select("event_id", "event_type", F.concat(F.regexp_replace("props", r"\}\s*$", ""), more).alias("details"))
    early = rows.filter("event_type <> 'error'")
    discovery.evolve_schema(t.spark, folder, discovery.discover(early, "details"))
    schema = discovery.evolve_schema(t.spark, folder, discovery.discover(rows.filter("event_type = 'error'"), "details"))
    typed = discovery.typed_columns(rows.drop("event_type"), "details", schema)
    return typed.select("event_id", "k", "who_user", "who_mail", F.col("load").cast("double").alias("load"))


@query("SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS dearest FROM orders GROUP BY ALL")
def stream_memory_sink(t):
    """Orders per priority over byte-limited micro-batches, in a table in memory: a few rows, as that sink is for."""
    root = scratch_path(t.spark, "stream-memory")
    orders = t.table("orders")
    orders.repartition(6, "o_orderkey").write.parquet(f"{root}/input")
    size = tables.stored_bytes(t.spark, f"{root}/input")
    stream = stream_files(t.spark, f"{root}/input", "parquet", orders.schema, glob="*.parquet", max_bytes=f"{max(1, size // 3 // 1024)}kb")
    counts = stream.groupBy("o_orderpriority").agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("dearest"))
    name = f"orders_{root.rsplit('-', 1)[-1]}"
    runner.wait(runner.run_stream_append(counts, None, f"{root}/checkpoint", name=name, fmt="memory", mode="complete"))
    return t.spark.table(name)
