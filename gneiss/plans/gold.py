"""Gold views over silver forecasts and the zip code dimension.

The dimension join carries no broadcast hint: Spark broadcasts the dimension when its
measured size allows and otherwise joins by key, where adaptive execution splits a post
code that holds many forecasts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.functions.values import day, moment


def forecast_zip(forecasts: DataFrame, zips: DataFrame) -> DataFrame:
    return forecasts.join(zips.select("post_code", "place_name", "state"), "post_code")


def _gold_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        "startTime",
        "place_name",
        "state",
        "post_code",
        "temperature",
        "probabilityOfPrecipitation",
        "windSpeed",
        F.col("startTimeUTC").cast("date").alias("forecast_date_utc"),
        F.col("startTime").try_cast("date").alias("forecast_date_local_tz"),
    )


def gold_ten_day(forecasts: DataFrame, zips: DataFrame, as_of=None, days: int = 10) -> DataFrame:
    """Forecasts from today up to ten days ahead, by UTC date, bounds included."""
    first = day(as_of)
    wanted = F.col("startTimeUTC").cast("date").between(first, F.date_add(first, days))
    return _gold_columns(forecast_zip(forecasts.filter(wanted), zips))


def gold_beyond(forecasts: DataFrame, zips: DataFrame, as_of=None, days: int = 10, processed_at=None) -> DataFrame:
    """Forecasts at least ten days ahead, with the time of computation."""
    wanted = F.col("startTimeUTC").cast("date") >= F.date_add(day(as_of), days)
    rows = _gold_columns(forecast_zip(forecasts.filter(wanted), zips))
    return rows.withColumn("audit_update_ts", moment(processed_at))


def state_extremes(forecasts: DataFrame, zips: DataFrame, as_of=None, ordered: bool = True) -> DataFrame:
    """The coldest and the warmest forecast per state and date, one row each.

    Equal temperatures are decided by place, post code, then time. Both rows come from one
    aggregation whose partial step runs before the shuffle, so a state holding a large
    share of rows sends two rows per task. ``as_of=None`` takes all dates.
    """
    date = F.col("startTimeUTC").cast("date")
    rows = forecasts if as_of is None else forecasts.filter(date >= day(as_of))
    joined = forecast_zip(rows, zips).filter(F.col("temperature").isNotNull())
    details = ["place_name", "post_code", "localTime", "temperature", "probabilityOfPrecipitation", "windSpeed"]
    faced = joined.select(
        "state", date.alias("forecast_date"), F.col("startTime").alias("localTime"),
        *[c for c in details if c != "localTime"],
    )
    lowest = F.min(F.struct(F.col("temperature").alias("_rank"), *details))
    highest = F.min(F.struct((-F.col("temperature")).alias("_rank"), *details))

    def picked(row, kind):
        return F.struct(*[F.col(row)[c].alias(c) for c in details], F.lit(kind).alias("temperature_type"))

    both = faced.groupBy("state", "forecast_date").agg(lowest.alias("_low"), highest.alias("_high"))
    result = both.select(
        "forecast_date", "state", F.inline(F.array(picked("_low", "LOWEST"), picked("_high", "HIGHEST")))
    ).select("forecast_date", "localTime", "state", *[c for c in details if c != "localTime"], "temperature_type")
    return result.orderBy("forecast_date", "state", "place_name") if ordered else result


def daily_high_low(forecasts: DataFrame, zips: DataFrame, zip_code: str, as_of=None, days: int = 10) -> DataFrame:
    """Daily extremes of one zip code over the next days. Codes compare as text."""
    rows = gold_ten_day(forecasts.filter(F.col("post_code") == str(zip_code)), zips, as_of, days)
    return rows.groupBy("forecast_date_local_tz").agg(
        F.max("temperature").alias("max_temperature"), F.min("temperature").alias("min_temperature")
    )


def snapshot(forecasts: DataFrame, zip_code: str, as_of=None) -> DataFrame:
    """Today's forecasts of one zip code, the input of a type 2 history."""
    return forecasts.filter((F.col("post_code") == str(zip_code)) & (F.col("startTimeUTC").cast("date") == day(as_of)))
