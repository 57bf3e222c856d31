"""Bronze forecasts to typed silver rows, and alerts. One definition for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.values import moment
from gneiss.operators.quality import expect
from gneiss.operators.shape import with_audit

# Fixed value: a UTC offset at the end of an ISO time.
OFFSET = r"([+-]\d{2}:\d{2})$"

# The rules of the append-only silver table.
SILVER_RULES = {
    "non_null_time": "startTime IS NOT NULL AND endTime IS NOT NULL",
    "valid_temperature": "temperature > -100 AND temperature < 130",
    "windspeed_positive": "windSpeed >= 0 OR windSpeed IS NULL",
    "humidity_percent_range": "relativeHumidity BETWEEN 0 AND 100 OR relativeHumidity IS NULL",
    "daytime_boolean": "isDaytime IN (true, false)",
}
WIND_RULE = {"valid_wind_speed": "windSpeed >= 0"}
TABLE_RULES = {"valid_wind_speed": "windSpeed BETWEEN 0 AND 200", "valid_timestamps": "startTimeUTC <= endTimeUTC"}


def _without(time: Column, offset: Column) -> Column:
    """A time without the offset found at its end: a cut, cheaper than a second pattern."""
    return F.left(time, F.length(time) - F.length(offset))


def _shifted(local: Column, offset: Column, mode: str) -> Column:
    shift = F.from_utc_timestamp if mode == "reference" else F.to_utc_timestamp
    at = local.try_cast("timestamp")
    return F.when(offset != "", shift(at, offset)).otherwise(at)


def silver_forecasts(
    df: DataFrame, utc_mode: str | None = "reference", end_offset: str = "start", processed_at=None
) -> DataFrame:
    """Flat typed forecasts.

    ``utc_mode`` decides the UTC columns. ``"reference"`` shifts a local time by its
    offset, which moves it away from UTC (12:00-05:00 becomes 07:00); ``"correct"`` gives
    the instant in UTC (17:00); ``None`` leaves them out. ``end_offset`` is ``"start"`` to
    shift the end by the offset of the start, ``"own"`` by its own.

    ``audit_update_ts`` stays the time of the source, on which merges and filters rely;
    the time of processing is ``processed_ts``.
    """
    if utc_mode not in ("reference", "correct", None) or end_offset not in ("start", "own"):
        raise ValueError("unknown utc_mode or end_offset")
    # Patterns are matched in a step of their own, once per row, and their results reused.
    found = df.withColumns({
        "timezoneOffset": F.regexp_extract("startTime", OFFSET, 1),
        "_end_offset": F.regexp_extract("endTime", OFFSET, 1),
    })
    offset, own_offset = F.col("timezoneOffset"), F.col("_end_offset")
    local = found.withColumns({
        "startTime": _without(F.col("startTime"), offset),
        "endTime": _without(F.col("endTime"), own_offset),
        "windSpeed": F.regexp_extract("windSpeed", r"(\d+)", 1).try_cast("int"),
        "dewpoint": F.col("dewpoint.value"),
        "probabilityOfPrecipitation": F.col("probabilityOfPrecipitation.value"),
        "relativeHumidity": F.col("relativeHumidity.value"),
        "processed_ts": moment(processed_at),
    })
    if utc_mode:
        used = offset if end_offset == "start" else own_offset
        local = local.withColumns({
            "startTimeUTC": _shifted(F.col("startTime"), offset, utc_mode),
            "endTimeUTC": _shifted(F.col("endTime"), used, utc_mode),
        })
    return local.drop("_end_offset")


def silver_append(df: DataFrame, utc_mode: str | None = "reference", processed_at=None) -> DataFrame:
    """The append-only silver rows: own end offset, rule-breaking rows dropped."""
    return expect(silver_forecasts(df, utc_mode, "own", processed_at), SILVER_RULES, "drop")


def alerts(df: DataFrame, low: int = 20, high: int = 95, precip: int = 80, as_of=None) -> DataFrame:
    """Alerts on cold, heat and rain. A row both cold and wet is an alert on cold."""
    temperature, wet = F.col("temperature"), F.col("probabilityOfPrecipitation.value")
    at = moment(as_of)
    hit = df.filter((temperature < low) | (temperature > high) | (wet > precip))
    kind = F.when(temperature < low, "EXTREME_COLD").when(temperature > high, "EXTREME_HEAT")
    return hit.select(
        F.concat(F.lit("ALERT_"), "post_code", F.lit("_"), F.unix_timestamp(at).cast("string")).alias("alert_id"),
        "post_code",
        kind.otherwise("HIGH_PRECIPITATION").alias("alert_type"),
        "temperature",
        wet.alias("precipitation_prob"),
        F.concat(F.lit("Weather alert for "), "post_code").alias("alert_message"),
        at.alias("created_at"),
    )


def names_rows(df: DataFrame, as_of=None) -> DataFrame:
    """Name counts from CSV rows: typed count, further columns, source file and load time.

    ``df`` comes straight from a file source, whose hidden metadata names the file, or has a
    ``file_name`` of its own.
    """
    file_name = F.col("file_name" if "file_name" in df.columns else "_metadata.file_name").alias("file_name")
    names = {c: c.lower().replace(" ", "_") for c in df.columns if c != "file_name"}
    rows = df.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()], file_name)
    fixed = ["year", "first_name", "county", "sex"]
    more = [n for n in names.values() if n not in [*fixed, "count"]]
    return with_audit(rows.select(*fixed, F.col("count").try_cast("int").alias("count"), *more, "file_name"), as_of)


def manual_names(df: DataFrame, first_name: str, sex: str, as_of=None) -> DataFrame:
    """Rows entered by hand after the pattern of existing ones."""
    return with_audit(
        df.withColumns({"first_name": F.lit(first_name), "sex": F.lit(sex), "file_name": F.lit("manual_add")}), as_of
    )
