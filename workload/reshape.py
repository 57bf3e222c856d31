"""Queries over column-level reshaping and file listings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gneiss.operators import shape, sketches
from gneiss.session import scratch_path
from gneiss.sources import tables
from workload.registry import query
from workload.shapes import PROCESSED
from workload.sql_shapes import ZIPS


@query("WITH " + ZIPS + " SELECT *, TIMESTAMP '2024-02-01' AS audit_update_ts FROM zips")
def flatten_places(t):
    """Postal documents as they would land from their service, one per zip code."""
    place = F.struct(
        F.col("place_name").alias("place name"), F.col("longitude").cast("string").alias("longitude"),
        F.col("latitude").cast("string").alias("latitude"), "state", F.col("state_abbreviation").alias("state abbreviation"),
    )
    document = F.struct(
        F.col("post_code").alias("post code"), "country", F.col("country_abbreviation").alias("country abbreviation"), F.array(place).alias("places"),
    )
    landed = t.zips().select(F.to_json(document).alias("document"))
    return shape.flatten_places(shape.parse_json_rows(landed, "document", shape.PLACES_SCHEMA), PROCESSED)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def parse_json_rows(t):
    return shape.parse_json_rows(t.table("events"), "props", "k BIGINT", keep=["event_id"])


@query("SELECT c_custkey AS customer_key, c_name AS full_name, c_acctbal AS account_balance FROM customer")
def normalize_names(t):
    rows = t.table("customer").select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Full Name"), F.col("c_acctbal").alias("Account Balance")
    )
    return shape.normalize_names(rows)


@query("""SELECT '''' || event_id AS event_id, '''' || user_id AS user_id, event_type, value FROM events""")
def quote_id_columns(t):
    return shape.quote_id_columns(t.table("events").select("event_id", "user_id", "event_type", "value"))


@query("""SELECT o_orderkey, o_custkey, o_totalprice, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
  UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def evolve_union(t):
    orders = t.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    old = orders.filter(F.col("o_orderdate") < split).drop("o_orderpriority", "o_orderdate")
    new = orders.filter(F.col("o_orderdate") >= split).drop("o_orderdate")
    return shape.evolve_union(old, new)


@query("SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, round(value * 100)::BIGINT AS cents FROM events")
def nested_to_variant(t):
    """Nested values as VARIANT, read back by path."""
    nested = t.table("events").select(
        "user_id", F.struct(F.from_json("props", "k BIGINT").alias("props"), F.round(F.col("value") * 100).cast("bigint").alias("cents")).alias("body")
    )
    body = F.col("body")
    return shape.nested_to_variant(nested).select(
        "user_id", F.variant_get(body, "$.props.k", "bigint").alias("k"), F.variant_get(body, "$.cents", "bigint").alias("cents")
    )


@query("SELECT c_custkey::INTEGER AS c_custkey, c_acctbal::VARCHAR::DECIMAL(12,2) AS c_acctbal FROM customer")
def conform(t):
    schema = T.StructType([T.StructField("c_custkey", T.IntegerType()), T.StructField("c_acctbal", T.DecimalType(12, 2))])
    return shape.conform(t.table("customer"), schema)


def daily_users(t):
    """Sketches of each day's users and of its error events' users, stored as a batch of each half of the month would."""
    rows = t.table("events").withColumns({"day": F.col("ts").cast("date"), "failing": F.when(F.col("event_type") == "error", F.col("user_id"))})
    halves = [rows.filter(F.col("event_id") % 2 == half) for half in (0, 1)]
    path = scratch_path(t.spark, "sketches")
    for half in halves:
        tables.write_append(sketches.distinct_sketches(half, "day", {"users": "user_id", "failing_users": "failing"}), path)
    return rows, sketches.merged_sketches(t.spark.read.parquet(path), "day", ["users", "failing_users"])


def beside_exact(estimated, exact, names, bound=0.03):
    """The exact counts, and whether the estimated ones lie within a bound."""
    both = exact.join(estimated.withColumnsRenamed({n: f"_{n}" for n in names}), "day")
    return both.select("day", *names, *[(F.abs(F.col(f"_{n}") - F.col(n)) <= F.greatest(F.lit(1.0), F.col(n) * bound)).alias(f"{n}_within") for n in names])


@query("""SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS failing_users,
    true AS users_within, true AS failing_users_within FROM events GROUP BY ALL""")
def distinct_daily(t):
    """Distinct users a day, estimated from stored sketches of its batches, beside the exact counts."""
    rows, stored = daily_users(t)
    names = ["users", "failing_users"]
    exact = rows.groupBy("day").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("failing").alias("failing_users"))
    return beside_exact(sketches.trailing_distinct(stored, "day", names, 1), exact, names)


@query("""WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
  SELECT day, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS failing_users, true AS users_within, true AS failing_users_within
  FROM days JOIN events ON CAST(ts AS DATE) BETWEEN day - 6 AND day GROUP BY ALL""")
def distinct_weekly(t):
    """Distinct users of the seven days up to each, united from the daily sketches, beside the exact counts."""
    rows, stored = daily_users(t)
    names = ["users", "failing_users"]
    weeks = rows.select("user_id", "failing", F.explode(F.sequence("day", F.date_add("day", 6))).alias("day")).join(rows.select("day").distinct(), "day", "left_semi")
    exact = weeks.groupBy("day").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("failing").alias("failing_users"))
    return beside_exact(sketches.trailing_distinct(stored, "day", names, 7), exact, names)


@query("""SELECT l_suppkey AS key, count(*) AS record_count, count(*) / (SELECT count(*) FROM lineitem)::DOUBLE AS share FROM lineitem GROUP BY ALL
  HAVING count(*) > 0.0105::DOUBLE * (SELECT count(*) FROM lineitem)""")
def heavy_hitters(t):
    """Suppliers with more than 1.05 percent of all line items, found through frequencies stored by return flag."""
    rows = t.table("lineitem")
    path = scratch_path(t.spark, "frequencies")
    for flag in ("A", "N", "R"):
        tables.write_append(sketches.frequency_table(rows.filter(F.col("l_returnflag") == flag), "l_suppkey"), path)
    return sketches.heavy_hitters(rows, "l_suppkey", 0.0105, sketches.merged_frequencies(t.spark.read.parquet(path)))
