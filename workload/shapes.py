"""The tables the plans expect, derived by Spark from the given test tables.

Everything is a plain projection or join over whole tables, without randomness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Snapshot dates of the order book, and the dates the other shapes are looked at.
SNAPSHOT_DATES = ["1996-12-31", "1998-06-30", "2000-01-01", "2001-08-01"]
WEATHER_DAY = "2024-01-15"
LOG_DAY = "2024-01-30"
COST_DAY = "1998-06-30"
PROCESSED = "2024-02-01 00:00:00"


class Shapes:
    """Shapes over one folder of test tables."""

    # Folders of shapes that were written out beforehand, by the folder of the tables and name.
    stored: dict[tuple[str, str], str] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def store(self, folder: str, *names: str) -> None:
        """Write shapes out as the tables they stand for, and read those from now on."""
        for name in names:
            path = f"{folder}/{name}"
            getattr(self, name)().write.parquet(path)
            Shapes.stored[self.sf_dir, name] = path

    def _stored(self, name: str) -> DataFrame | None:
        path = Shapes.stored.get((self.sf_dir, name))
        return self.spark.read.parquet(path) if path else None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def zips(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
            code(key).alias("post_code"),
            F.lit("United States").alias("country"),
            F.lit("US").alias("country_abbreviation"),
            (25 + (key % 2400) / F.lit(100.0)).alias("latitude"),
            (-67 - (key % 5700) / F.lit(100.0)).alias("longitude"),
            F.col("c_name").alias("place_name"),
            F.col("n_name").alias("state"),
            F.format_string("N%02d", "n_nationkey").alias("state_abbreviation"),
        )

    def forecasts(self) -> DataFrame:
        return self._stored("forecasts") or forecast_rows(self.table("events"))

    def first_load(self) -> DataFrame:
        """Forecasts known by the middle of the month."""
        return self.forecasts().filter(F.col("audit_update_ts") < F.lit("2024-01-16").cast("timestamp"))

    def second_load(self) -> DataFrame:
        """Forecasts of the second half, and newer versions of those of the week before."""
        rows = self.forecasts().filter(F.col("audit_update_ts") >= F.lit("2024-01-09").cast("timestamp"))
        again = F.col("audit_update_ts") < F.lit("2024-01-16").cast("timestamp")
        return rows.withColumns({
            "temperature": F.when(again, F.col("temperature") + 1).otherwise(F.col("temperature")),
            "audit_update_ts": F.when(again, F.col("audit_update_ts") + F.expr("INTERVAL 7 DAYS")).otherwise(F.col("audit_update_ts")),
        })

    def event_log(self) -> DataFrame:
        return self._stored("event_log") or event_log_rows(self.table("events"))

    def registry(self) -> DataFrame:
        """One entry per pipeline of the log; logging is off for one of them."""
        ids = self.event_log().select("origin.pipeline_id").distinct()
        return ids.select("pipeline_id", (F.col("pipeline_id") != "p3").alias("log_enabled"))

    def flat_runs(self) -> DataFrame:
        event = F.col("event_id")
        return self.table("events").select(
            F.concat(F.lit("pipe_"), F.col("user_id").cast("string")).alias("pipeline_name"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("COMPLETED").alias("status"),
            (F.col("value") * 10).alias("streaming_backlog"),
            (event % 90).cast("double").alias("runtime_minutes"),
            (event % 3).alias("retry_count_7d"),
            F.when(F.col("event_type") == "click", "autoloader").otherwise("table").alias("source_type"),
            F.concat(F.lit("t_"), (event % 40).cast("string")).alias("target_table_name"),
            (F.col("event_type") == "view").alias("is_streaming"),
            F.col("ts").cast("timestamp").alias("event_time"),
        )

    def usage(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.table("lineitem").select(
            F.col("l_shipdate").cast("timestamp").alias("usage_start_time"),
            F.concat(F.lit("job_"), (F.col("l_suppkey") % 5).cast("string")).alias("job_id"),
            F.col("l_extendedprice").alias("dbu_cost"),
            F.col("l_quantity").alias("dbus"),
            F.col("l_quantity").alias("usage_quantity"),
            F.when(flag == "A", "job_compute").when(flag == "N", "warehouse").otherwise("serverless").alias("compute_type"),
            F.concat(F.lit("SKU_"), flag).alias("sku_name"),
            "l_orderkey", "l_linenumber", "l_partkey",
        )

    def timed_usage(self) -> DataFrame:
        """Usage of four jobs while the log was written, of up to three hours each; the last job runs no pipeline."""
        event, start = F.col("event_id"), F.col("ts").cast("timestamp")
        return self.table("events").select(
            event.alias("usage_id"), start.alias("usage_start_time"),
            F.timestamp_micros(F.unix_micros(start) + event % 180 * 60_000_000).alias("usage_end_time"),
            F.concat(F.lit("job_"), (F.col("user_id") % 4).cast("string")).alias("job_id"),
            F.col("value").alias("dbu_cost"), (event % 7).cast("double").alias("dbus"))

    def shared_jobs(self) -> DataFrame:
        """Three jobs share the pipelines of the log."""
        pipelines = self.event_log().select("origin.pipeline_id").distinct()
        return pipelines.select("pipeline_id", F.concat(F.lit("job_"), (F.substring("pipeline_id", 2, 9).cast("int") % 3).cast("string")).alias("job_id"))

    def columns_metadata(self) -> DataFrame:
        key = F.col("c_custkey")
        words = ["email_address", "ssn", "filename", "tax_rate", "amount", "created_at", "dob", "phone_no", "credit_limit",
                 "passport_no", "syntax", "quantity"]
        return self.table("customer").select(
            *metadata_table(key),
            F.concat(F.element_at(F.array(*map(F.lit, words)), (key % 12 + 1).cast("int")), F.lit("_"), key.cast("string")).alias("column_name"),
            F.lit("STRING").alias("data_type"),
            F.when(F.col("c_mktsegment") == "BUILDING", "Phone of the contact").alias("comment"),
        )

    def privileges(self) -> DataFrame:
        key = F.col("c_custkey")
        anyone = F.when(key % 3 == 0, "public").when(key % 3 == 1, "PUBLIC").otherwise("analysts")
        return self.table("customer").select(
            *metadata_table(key),
            F.when(key % 4 == 3, "analysts").otherwise(anyone).alias("grantee"),
            F.lit("SELECT").alias("privilege_type"),
        )

    def snapshots(self) -> DataFrame:
        """The order book at four dates: finished orders leave it after three years."""
        names = ["version", "at", "leaving", "aged"]
        dates = [F.struct(*[c.alias(n) for n, c in zip(names, [F.lit(v).cast("bigint"), *book_dates(d)])]) for v, d in enumerate(SNAPSHOT_DATES, 1)]
        return order_book(self.table("orders").select("*", F.inline(F.array(*dates))), *map(F.col, names))

    def snapshot(self, version: int) -> DataFrame:
        """The order book at one of the dates, by the same rules; other dates are not derived for it."""
        return order_book(self.table("orders"), F.lit(version), *book_dates(SNAPSHOT_DATES[version - 1])).drop("version")

    def file_listing(self) -> DataFrame:
        """One file per line item, stored in a folder per part."""
        return self.table("lineitem").select(
            F.concat(F.lit("s3://lake/raw/part_"), F.col("l_partkey").cast("string"), F.lit("/f_"), F.col("l_orderkey").cast("string"),
                     F.lit("_"), F.col("l_linenumber").cast("string"), F.lit(".parquet")).alias("path"),
            F.col("l_quantity").cast("bigint").alias("size"),
        )

    def partitioned_listing(self) -> DataFrame:
        """One file per line item below a folder per part, year and month, a log folder for each part, and loose files."""
        part = F.concat(F.lit("s3://lake/raw/part_"), F.col("l_partkey").cast("string"))
        number = F.concat(F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"))
        files = self.table("lineitem").select(
            F.concat(part, F.lit("/year="), F.year("l_shipdate").cast("string"), F.lit("/month="), F.month("l_shipdate").cast("string"),
                     F.lit("/f_"), number, F.lit(".parquet")).alias("path"), F.col("l_quantity").cast("bigint").alias("size"))
        size = F.lit(10).cast("bigint").alias("size")
        key = F.col("p_partkey").cast("string")
        logs = self.table("part").select(F.concat(F.lit("s3://lake/raw/part_"), key, F.lit("/_log/0.json")).alias("path"), size)
        loose = self.table("part").select(F.concat(F.lit("s3://lake/raw/loose_"), key).alias("path"), size)
        return files.unionByName(logs).unionByName(loose)

    def nested_tables(self) -> DataFrame:
        """Tables in the folders of the smaller parts; of some larger parts one year's folder is a table."""
        small = F.col("p_size") <= 25
        part = F.concat(F.lit("s3://lake/raw/part_"), F.col("p_partkey").cast("string"))
        return self.table("part").filter(small | (F.col("p_size") <= 30)).select(
            F.col("p_name").alias("tableName"), F.when(small, F.concat(part, F.lit("/"))).otherwise(F.concat(part, F.lit("/year=1996"))).alias("location"))

    def table_list(self) -> DataFrame:
        """Tables stored in the folders of the smaller parts."""
        return self.table("part").filter("p_size <= 25").select(
            F.col("p_name").alias("tableName"),
            F.concat(F.lit("s3://lake/raw/part_"), F.col("p_partkey").cast("string")).alias("location"),
        )


def code(key) -> Column:
    """A key as a code of at least five digits."""
    return F.format_string("%05d", key)


def book_dates(date: str) -> list[Column]:
    """A snapshot's date, and those up to which finished orders have left it and others are no longer fresh; all constants."""
    at = F.lit(date).cast("timestamp_ntz")
    return [at, at - F.expr("INTERVAL '3' YEAR"), at - F.expr("INTERVAL '1' YEAR")]


def order_book(orders: DataFrame, version: Column, at: Column, leaving: Column, aged: Column) -> DataFrame:
    """Orders in the book at the dates given, with the status they had then."""
    ordered = F.col("o_orderdate")
    live = (ordered <= at) & ((F.col("o_orderstatus") != "F") | (ordered > leaving))
    return orders.filter(live).select(
        version.alias("version"),
        "o_orderkey",
        "o_custkey",
        F.when(ordered > aged, "P").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
    )


def metadata_table(key):
    return [
        F.lit("main").alias("catalog_name"),
        F.concat(F.lit("schema_"), (key % 4).cast("string")).alias("schema_name"),
        F.concat(F.lit("table_"), (key % 20).cast("string")).alias("table_name"),
    ]


def forecast_rows(events: DataFrame) -> DataFrame:
    """Bronze forecasts out of events; works on a stream of events too."""
    event, at = F.col("event_id"), F.col("ts").cast("timestamp")
    hour = F.date_trunc("hour", at)
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    start_offset = F.element_at(F.array(*map(F.lit, ["-05:00", "-07:00", "+01:00", ""])), (event % 4 + 1).cast("int"))
    end_offset = F.element_at(F.array(*map(F.lit, ["-05:00", "-07:00", "+01:00"])), (event % 3 + 1).cast("int"))
    kind = F.col("event_type")
    short = (
        F.when(kind == "click", "Sunny").when(kind == "view", "Cloudy").when(kind == "purchase", "Rain")
        .when(kind == "signup", "Snow").otherwise("Thunderstorms")
    )
    k = F.get_json_object("props", "$.k").cast("bigint")
    wind = F.when(event % 17 == 0, "calm").when(event % 19 == 0, "10 to 15 mph").otherwise(F.concat(k.cast("string"), F.lit(" mph")))
    percent, degrees = F.lit("wmoUnit:percent").alias("unitCode"), F.lit("wmoUnit:degC").alias("unitCode")
    return events.select(
        code(F.col("user_id")).alias("post_code"),
        (event % 24 + 1).alias("number"),
        F.date_format(hour, "EEEE").alias("name"),
        F.concat(F.date_format(hour, iso), start_offset).alias("startTime"),
        F.when(event % 23 != 0, F.concat(F.date_format(hour + F.expr("INTERVAL 1 HOUR"), iso), end_offset)).alias("endTime"),
        F.when(event % 31 != 0, F.hour(at).between(6, 17)).alias("isDaytime"),
        F.when(event % 29 == 0, 140).otherwise(F.floor("value").cast("bigint") % 160 - 30).cast("bigint").alias("temperature"),
        F.lit("F").alias("temperatureUnit"),
        F.when(event % 3 == 1, "rising").when(event % 3 == 2, "falling").alias("temperatureTrend"),
        F.struct(percent, k.alias("value")).alias("probabilityOfPrecipitation"),
        F.struct(degrees, (F.col("value") / F.lit(10.0)).alias("value")).alias("dewpoint"),
        F.struct(percent, (event % 120).alias("value")).alias("relativeHumidity"),
        wind.alias("windSpeed"),
        F.element_at(F.array(*map(F.lit, ["N", "E", "S", "W"])), (event % 4 + 1).cast("int")).alias("windDirection"),
        F.concat(F.lit("icons/"), kind).alias("icon"),
        short.alias("shortForecast"),
        F.concat(short, F.lit(", wind "), wind).alias("detailedForecast"),
        at.alias("audit_update_ts"),
    )


def event_log_rows(events: DataFrame) -> DataFrame:
    """A run log out of events: eight events make an update, five pipelines take turns."""
    event = F.col("event_id")
    update, step = F.expr("event_id div 8"), event % 8
    pipe = update % 5
    flow = F.concat_ws("_", pipe.cast("string"), F.expr("event_id div 40 % 3").cast("string"))
    flow_id = F.concat(F.lit("f"), flow)
    amount = F.floor(F.col("value") * 100).cast("bigint")
    text = amount.cast("string")
    failed, canceled = update % 4 == 0, update % 11 == 0
    state = F.when(failed, "FAILED").when(canceled, "CANCELED").otherwise("COMPLETED")
    kind = (
        F.when(step.isin(0, 6), "update_progress").when(step == 1, "flow_definition").when(step == 2, "dataset_definition")
        .when(step.isin(3, 5), "flow_progress").when(step == 4, "operation_progress")
        .otherwise(F.when(failed, "update_failed").when(canceled, "create_update").otherwise("update_complete"))
    )
    expectations = (
        F.when(update % 7 == 0, "[]").when(update % 7 == 1, "null").otherwise(
            F.concat(
                F.lit('[{"name":"valid_wind","status":"COMPLETED","violated_records":'), (amount % 50).cast("string"),
                F.lit(',"passed_records":'), text, F.lit(',"failed_records":'), (amount % 50).cast("string"),
                F.lit(',"dropped_records":'), (amount % 20).cast("string"),
                F.lit(',"metrics":{"null_count":'), (amount % 9).cast("string"), F.lit(',"total_records":'), text,
                F.lit('}},{"name":"valid_time","status":"COMPLETED","passed_records":'), text, F.lit("}]"),
            )
        )
    )
    metrics = F.concat(
        F.lit('"metrics":{"backlog_bytes":'), (amount * 1000).cast("string"), F.lit(',"input_rows":'), text,
        F.lit(',"output_rows":'), (amount + 1).cast("string"), F.lit("}"),
    )
    details = (
        F.when(step == 0, '{"update_progress":{"state":"RUNNING"}}')
        .when(step == 1, F.concat(
            F.lit('{"flow_definition":{'),
            F.when(update % 5 != 4, F.concat(F.lit('"output_dataset":"silver.t_'), flow, F.lit('",'))).otherwise(F.lit("")),
            F.lit('"is_streaming":'), F.when(pipe.isin(0, 2), "true").otherwise("false"), F.lit("}}")))
        .when(step == 2, F.concat(
            F.lit('{"dataset_definition":{"source_type":"'), F.when(pipe == 1, "autoloader").otherwise("table"),
            F.lit('","path":"/landing/'), flow, F.lit('"}}')))
        .when(step == 3, F.concat(
            F.lit('{"flow_progress":{"status":"RUNNING",'), metrics, F.lit(',"data_quality":{"expectations":'), expectations, F.lit("}}}")))
        .when(step == 4, F.when(pipe.isin(1, 2), F.concat(
            F.lit('{"operation_progress":{"auto_loader_details":{"num_files_listed":'), text,
            F.lit(',"num_files_processed":'), text, F.lit("}}}"))).otherwise('{"operation_progress":{"type":"other"}}'))
        .when(step == 5, F.concat(F.lit('{"flow_progress":{"status":"'), state, F.lit('",'), metrics, F.lit("}}")))
        .when(step == 6, F.concat(
            F.lit('{"update_progress":{"state":"'), state, F.lit('","metrics":{"input_rows":'), text, F.lit(',"output_rows":'), text, F.lit("}}}")))
        .otherwise(F.concat(
            F.lit('{"cluster_resources":{"default_cluster_info":{"cluster_id":"c'), pipe.cast("string"),
            F.lit('","cluster_name":"'), F.when(pipe.isin(0, 1), "single-node").otherwise("multi-node"),
            F.lit('","idle_minutes":'), (amount % 60).cast("string"), F.lit(',"active_minutes":'), (amount % 240).cast("string"),
            F.when(update % 13 != 0, F.concat(F.lit(',"job_id":"job_'), pipe.cast("string"), F.lit('"'))).otherwise(F.lit("")),
            F.lit('}},"flow_progress":{"metrics":{"output_table":"gold.t_'), flow,
            F.lit('"}},"user_action":{"action":"START"},"autoscale":{"requested_num_executors":'), (amount % 8).cast("string"), F.lit("}}")))
    )
    return events.select(
        F.concat(F.lit("e"), event.cast("string")).alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        kind.alias("event_type"),
        F.struct(
            F.concat(F.lit("p"), pipe.cast("string")).alias("pipeline_id"),
            F.when(update % 50 != 7, F.concat(F.lit("pipe_"), pipe.cast("string"))).alias("pipeline_name"),
            F.concat(F.lit("u"), update.cast("string")).alias("update_id"),
            flow_id.alias("flow_id"),
            F.concat(F.lit("flow_"), flow).alias("flow_name"),
            F.when(pipe != 3, F.concat(F.lit("ds_"), flow)).alias("dataset_name"),
            F.lit("org1").alias("org_id"),
            F.lit("AWS").alias("cloud"),
        ).alias("origin"),
        details.alias("details"),
    )
