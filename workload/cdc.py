"""Queries over loads and snapshots: merges, change feeds, histories, keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from gneiss.operators import changes, history, keys, merge
from gneiss.plans import ingest, silver, views
from gneiss.session import scratch_path
from gneiss.sources import buckets, tables
from gneiss.sources.config import TableConfig
from gneiss.sources.readers import read_source
from workload.registry import query
from workload.shapes import PROCESSED
from workload.sql_shapes import FORECASTS, LOADS, SNAPSHOTS
from workload.sql_shapes import silver as silver_sql

KEY = ["post_code", "startTime"]

LATEST = """row_number() OVER (PARTITION BY post_code, startTime ORDER BY audit_update_ts DESC, number DESC) AS rn"""


def loads_sql(*parts):
    return "WITH " + ",".join([FORECASTS, LOADS, silver_sql("first_load", name="one"), silver_sql("second_load", name="two"),
                               f"t AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {LATEST} FROM one) WHERE rn = 1)",
                               f"s AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {LATEST} FROM two) WHERE rn = 1)", *parts])


def newest(rows):
    return keys.latest_per_key(rows, KEY, [F.col("audit_update_ts").desc(), F.col("number").desc()])


def target(t):
    return newest(silver.silver_forecasts(t.first_load(), processed_at=PROCESSED))


def source(t):
    return newest(silver.silver_forecasts(t.second_load(), processed_at=PROCESSED))


@query("WITH " + ",".join([FORECASTS, silver_sql()]) + f" SELECT * EXCLUDE (rn) FROM (SELECT *, {LATEST} FROM silver) WHERE rn = 1")
def latest_per_key(t):
    return newest(silver.silver_forecasts(t.forecasts(), processed_at=PROCESSED))


@query(loads_sql() + " SELECT * FROM s UNION ALL SELECT * FROM t ANTI JOIN s ON t.post_code = s.post_code AND t.startTime = s.startTime")
def merge_upsert(t):
    return merge.merge_upsert(target(t), source(t), KEY)


@query(loads_sql() + """ SELECT t.* FROM t LEFT JOIN s ON t.post_code = s.post_code AND t.startTime = s.startTime
    WHERE s.post_code IS NULL OR NOT s.audit_update_ts > t.audit_update_ts
  UNION ALL SELECT s.* FROM s LEFT JOIN t ON t.post_code = s.post_code AND t.startTime = s.startTime
    WHERE t.post_code IS NULL OR s.audit_update_ts > t.audit_update_ts""")
def merge_newer(t):
    return merge.merge_upsert(target(t), source(t), KEY, newer_by="audit_update_ts", check_duplicates=False)


@query(loads_sql() + """ SELECT t.* REPLACE (CASE WHEN s.post_code IS NULL THEN t.temperature ELSE s.temperature END AS temperature)
    FROM t LEFT JOIN s ON t.post_code = s.post_code AND t.startTime = s.startTime
  UNION ALL SELECT * FROM s ANTI JOIN t ON t.post_code = s.post_code AND t.startTime = s.startTime""")
def merge_columns(t):
    return merge.merge_upsert(target(t), source(t), KEY, update_columns=["temperature"], check_duplicates=False)


@query(loads_sql() + """ SELECT t.* FROM t LEFT JOIN s ON t.post_code = s.post_code AND t.startTime = s.startTime
    WHERE s.post_code IS NULL OR NOT s.audit_update_ts > t.audit_update_ts
  UNION ALL SELECT s.* FROM s LEFT JOIN t ON t.post_code = s.post_code AND t.startTime = s.startTime
    WHERE t.post_code IS NULL OR s.audit_update_ts > t.audit_update_ts""")
def merge_bucketed(t):
    """The second load merged into a table bucketed by its keys, twice, as a repeated load would be."""
    stored = buckets.create_bucketed(target(t), scratch_path(t.spark, "bucketed"), KEY, 8)
    fresh = tables.materialize(source(t), scratch_path(t.spark, "fresh"))
    return stored.merge(fresh, newer_by="audit_update_ts").merge(fresh, newer_by="audit_update_ts").read()


@query(loads_sql() + " SELECT * FROM two WHERE audit_update_ts >= (SELECT max(audit_update_ts) FROM one)")
def incremental_filter(t):
    rows = silver.silver_forecasts(t.second_load(), processed_at=PROCESSED)
    return merge.incremental_filter(rows, "audit_update_ts", merge.high_water_mark(t.first_load(), "audit_update_ts"))


@query(loads_sql() + " SELECT * FROM two WHERE audit_update_ts >= TIMESTAMP '2024-01-20'")
def replay_filter(t):
    rows = silver.silver_forecasts(t.second_load(), processed_at=PROCESSED)
    return merge.incremental_filter(rows, "audit_update_ts", cutoff="2024-01-20")


CUSTOMERS = """WITH src AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, TIMESTAMP '2024-01-01' + c_custkey * INTERVAL 1 MINUTE AS changed_at FROM customer)"""


def customer_source(t, stale: bool):
    rows = t.table("customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment",
        F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01").cast("timestamp")) + F.col("c_custkey") * 60).alias("changed_at"),
    )
    if not stale:
        return rows
    older = rows.filter(F.col("c_mktsegment") != "BUILDING")
    return older.withColumns({"c_acctbal": F.lit(0.0), "changed_at": F.lit("2023-12-31").cast("timestamp")})


@query(CUSTOMERS + """ SELECT * REPLACE (CASE WHEN c_custkey % 10 = 0 THEN changed_at + INTERVAL 60 DAY ELSE changed_at END AS changed_at,
    CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal) FROM src""")
def ingest_customer(t):
    """A stale full load, an incremental one, and one whose source has lost a column, from one configuration."""
    root = scratch_path(t.spark, "ingest")
    config = {
        "source_incremental_column": "changed_at", "target": f"{root}/target", "target_merge_columns": ["c_custkey"],
        "target_incremental_column": "changed_at",
    }
    for name, stale, incremental in (("old", True, "false"), ("new", False, "true")):
        customer_source(t, stale).write.parquet(f"{root}/{name}")
        ingest.ingest(t.spark, TableConfig.from_dict({"source_table": f"{root}/{name}", **config}), incremental)
    # The last source changes every tenth customer and no longer has the market segment.
    later = customer_source(t, False).filter("c_custkey % 10 = 0").drop("c_mktsegment").withColumns({
        "c_acctbal": F.col("c_acctbal") + 1, "changed_at": F.col("changed_at") + F.expr("INTERVAL 60 DAYS")})
    later.write.parquet(f"{root}/lost")
    return ingest.ingest(t.spark, TableConfig.from_dict({"source_table": f"{root}/lost", **config}), True)


@query(CUSTOMERS + " SELECT * FROM src WHERE changed_at >= TIMESTAMP '2024-01-01 12:00:00'")
def ingest_staged(t):
    """An incremental load after a cutoff, staged before it is merged."""
    root = scratch_path(t.spark, "staged")
    customer_source(t, False).write.parquet(f"{root}/source")
    loaded = TableConfig.from_dict({
        "source_table": f"{root}/source", "source_incremental_column": "changed_at", "target": f"{root}/target",
        "target_merge_columns": ["c_custkey"], "target_incremental_column": "changed_at"})
    return ingest.ingest(t.spark, loaded, True, cutoff="2024-01-01 12:00:00", stage_path=f"{root}/stage")


@query("WITH " + SNAPSHOTS + """, o AS (SELECT * EXCLUDE (version) FROM snapshots WHERE version = 2), n AS (SELECT * EXCLUDE (version) FROM snapshots WHERE version = 3),
  feed AS (
    SELECT n.*, 'insert' AS _change_type FROM n ANTI JOIN o USING (o_orderkey)
    UNION ALL SELECT o.*, 'delete' FROM o ANTI JOIN n USING (o_orderkey)
    UNION ALL SELECT o.*, 'update_preimage' FROM o JOIN n USING (o_orderkey) WHERE (o.o_custkey, o.o_orderstatus, o.o_totalprice) IS DISTINCT FROM (n.o_custkey, n.o_orderstatus, n.o_totalprice)
    UNION ALL SELECT n.*, 'update_postimage' FROM o JOIN n USING (o_orderkey) WHERE (o.o_custkey, o.o_orderstatus, o.o_totalprice) IS DISTINCT FROM (n.o_custkey, n.o_orderstatus, n.o_totalprice))
  SELECT *, 3::BIGINT AS _commit_version, TIMESTAMP '2000-01-01' AS _commit_timestamp FROM feed""")
def change_feed(t):
    return changes.change_feed(t.snapshot(2), t.snapshot(3), ["o_orderkey"], 3, "2000-01-01")


def order_feed(t):
    """Changes from the second to the fourth snapshot."""
    first = changes.change_feed(t.snapshot(2), t.snapshot(3), ["o_orderkey"], 3, "2000-01-01")
    return first.unionByName(changes.change_feed(t.snapshot(3), t.snapshot(4), ["o_orderkey"], 4, "2001-08-01"))


SCD1 = """, marked AS (
    SELECT *, lag(version) OVER w AS pv, lag(o_orderstatus) OVER w AS ps FROM snapshots WINDOW w AS (PARTITION BY o_orderkey ORDER BY version)),
  since AS (SELECT o_orderkey, max(version) AS _commit_version FROM marked WHERE pv IS NULL OR pv <> version - 1 OR ps <> o_orderstatus GROUP BY o_orderkey)
  SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, greatest(_commit_version, 2) AS _commit_version
  FROM snapshots s JOIN since USING (o_orderkey) WHERE s.version = 4"""


@query("WITH " + SNAPSHOTS + SCD1)
def scd1_apply(t):
    base = t.snapshot(2).withColumn("_commit_version", F.lit(2).cast("bigint"))
    rows, _ = changes.scd1_apply(base, order_feed(t), ["o_orderkey"], "_commit_version", F.col("_change_type") == "delete")
    return rows


SCD2 = """, seen AS (
    SELECT *, lag(version) OVER w AS pv, lag(o_orderstatus) OVER w AS ps FROM snapshots WINDOW w AS (PARTITION BY o_orderkey ORDER BY version)),
  runs AS (
    SELECT *, sum(CASE WHEN pv = version - 1 AND ps = o_orderstatus THEN 0 ELSE 1 END) OVER (PARTITION BY o_orderkey ORDER BY version) AS run FROM seen)
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, min(version) AS __START_AT,
         CASE WHEN max(version) < 4 THEN max(version) + 1 END AS __END_AT
  FROM runs GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, run"""


@query("WITH " + SNAPSHOTS + SCD2)
def scd2_from_snapshots(t):
    return history.scd2_from_snapshots(t.snapshots(), ["o_orderkey"], "version")


@query("WITH " + SNAPSHOTS + SCD2)
def scd2_apply_snapshot(t):
    built = history.scd2_from_snapshots(t.snapshots().filter("version < 4"), ["o_orderkey"], "version")
    past = tables.materialize(built, scratch_path(t.spark, "history"))
    return history.scd2_apply_snapshot(past, t.snapshot(4), ["o_orderkey"], 4)


@query("""SELECT l_orderkey, l_linenumber, count(*) AS record_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def check_primary_key(t):
    return keys.check_primary_key(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def check_foreign_key(t):
    solvent = t.table("customer").filter("c_acctbal > 0")
    return keys.check_foreign_key(t.table("orders"), solvent, {"o_custkey": "c_custkey"})


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def compact(t):
    """Many small files rewritten as clustered ones of the wished size; the rows stay the same."""
    root, size = scratch_path(t.spark, "compact"), tables.stored_bytes(t.spark, f"{t.sf_dir}/orders.parquet")
    t.table("orders").repartition(tables.file_count(size, tables.FILE_BYTES // 16), "o_orderkey").write.parquet(f"{root}/small")
    tables.compact(t.spark, f"{root}/small", f"{root}/packed", ["o_orderdate", "o_orderkey"])
    return t.spark.read.parquet(f"{root}/packed")


@query("SELECT * FROM orders")
def clustered_layout(t):
    """A full load in clustered layout."""
    path = scratch_path(t.spark, "clustered")
    tables.write_clustered(t.table("orders"), path, ["o_orderpriority", "o_orderdate", "o_orderkey"])
    return t.spark.read.parquet(path)


@query("SELECT * FROM orders")
def zordered_layout(t):
    """The order book along a Z curve over date and price."""
    path = scratch_path(t.spark, "zordered")
    files = tables.file_count(tables.stored_bytes(t.spark, f"{t.sf_dir}/orders.parquet"))
    tables.zordered(t.table("orders"), ["o_orderdate", "o_totalprice"], files).write.parquet(path)
    return t.spark.read.parquet(path)


@query("WITH " + ",".join([FORECASTS, silver_sql()]) + " SELECT * FROM silver")
def zordered_merge_keys(t):
    """Silver forecasts along a Z curve over their merge keys, two of them text, and the time of the update."""
    path = scratch_path(t.spark, "optimized")
    tables.write_optimized(silver.silver_forecasts(t.forecasts(), processed_at=PROCESSED), path, [*KEY, "audit_update_ts"], files=16)
    return t.spark.read.parquet(path)


@query("WITH " + SNAPSHOTS + " SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM snapshots WHERE version = 4")
def versioned_table(t):
    """A table written whole, then changed by a batch with deletes, then folded and read."""
    path = scratch_path(t.spark, "versioned")
    feed = changes.change_feed(t.snapshot(3), t.snapshot(4), ["o_orderkey"], 4, "2001-08-01")
    batch = feed.filter(F.col("_change_type") != changes.BEFORE).withColumn("_deleted", F.col("_change_type") == changes.DELETE)
    schema = t.snapshot(3).schema
    tables.write_full(t.snapshot(3), path)
    tables.write_changes(batch.drop(*changes.CHANGE_COLUMNS), path, 0)
    tables.fold_changes(t.spark, path, ["o_orderkey"], schema)
    return tables.read_merged(t.spark, path, ["o_orderkey"], schema)


@query("WITH " + SNAPSHOTS + """ SELECT o_orderstatus, o_custkey, count(*) AS row_count, count(o_totalprice) AS count_o_totalprice,
    CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS sum_o_totalprice, min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice
  FROM snapshots WHERE version = 4 GROUP BY ALL""")
def view_refresh(t):
    """Orders per status and customer at the first date, brought to the last one by three change feeds."""
    view = views.AggregateView.of("o_orderstatus, o_custkey", ["o_totalprice"], ["o_totalprice"])
    root = scratch_path(t.spark, "view")
    rows = tables.materialize(view.full(t.snapshot(1)), f"{root}/view1")
    for version in (2, 3, 4):
        before, after = t.snapshot(version - 1), t.snapshot(version)
        feed = tables.materialize(changes.change_feed(before, after, ["o_orderkey"], version, "2001-08-01"), f"{root}/feed{version}")
        rows = tables.materialize(view.refresh(rows, feed, after, f"{root}/moved{version}"), f"{root}/view{version}")
    return rows.withColumn("sum_o_totalprice", F.col("sum_o_totalprice").cast("double"))


@query("SELECT * FROM orders")
def append_and_insert(t):
    """Orders of one half appended, the others selected out of a staged table of another format into the same one."""
    root = scratch_path(t.spark, "append")
    orders = t.table("orders")
    tables.write_append(orders.filter("o_orderkey % 2 = 0"), f"{root}/table")
    staged = orders.filter("o_orderkey % 2 = 1")
    staged.write.format("orc").save(f"{root}/staged")
    config = TableConfig.from_dict({
        "source_table": f"{root}/staged", "source_incremental_column": "o_orderdate", "target": f"{root}/table", "target_merge_columns": ["o_orderkey"], "target_incremental_column": "o_orderdate",
        "kind": "format", "options": {"format": "orc", "path": f"{root}/staged"}})
    tables.write_append(read_source(t.spark, config).select(*orders.columns), f"{root}/table")
    return t.spark.read.parquet(f"{root}/table")


@query("""SELECT CAST(o_orderdate AS DATE) AS summary_date, o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-06-30' GROUP BY ALL""")
def summary_today_table(t):
    """A daily summary stored in full, and the rows of one day stored beside it as a table of their own."""
    root = scratch_path(t.spark, "today")
    daily = t.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("summary_date"), "o_orderpriority").agg(
        F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    return tables.materialize(tables.todays_rows(tables.materialize(daily, f"{root}/summary"), "1998-06-30"), f"{root}/today")


@query("""WITH named AS (SELECT 1990 + c_custkey % 30 AS year, c_name AS first_name, 'county_' || c_nationkey AS county, CASE WHEN c_acctbal < 0 THEN 'M' ELSE 'F' END AS sex,
    CAST(c_custkey % 1000 AS INTEGER) AS count, 'names' AS file_name FROM customer)
  SELECT *, TIMESTAMP '2024-02-01' AS audit_update_ts FROM named
  UNION ALL SELECT year, 'Ada', county, 'F', count, 'manual_add', TIMESTAMP '2024-02-01' FROM named WHERE count = 7""")
def manual_rows(t):
    """Names, and rows entered by hand after the pattern of some of them."""
    named = t.table("customer").select(
        (1990 + F.col("c_custkey") % 30).alias("year"), F.col("c_name").alias("first_name"), F.concat(F.lit("county_"), F.col("c_nationkey").cast("string")).alias("county"),
        F.when(F.col("c_acctbal") < 0, "M").otherwise("F").alias("sex"), (F.col("c_custkey") % 1000).cast("string").alias("count"), F.lit("names").alias("file_name"))
    rows = silver.names_rows(named, PROCESSED)
    added = silver.manual_names(rows.filter("count = 7").drop("audit_update_ts"), "Ada", "F", PROCESSED)
    return rows.unionByName(added)
