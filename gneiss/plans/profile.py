"""Counts and profiles of forecasts and zip codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zips_per_state(zips: DataFrame) -> DataFrame:
    counts = zips.groupBy("state_abbreviation").agg(F.count("*").alias("zip_count"))
    return counts.orderBy(F.col("zip_count").desc(), "state_abbreviation")


def state_forecasts(forecasts: DataFrame, zips: DataFrame, state: str) -> DataFrame:
    """Forecasts of one state: the dimension is filtered before the join."""
    wanted = zips.filter(F.col("state_abbreviation") == state).select("post_code", "place_name")
    return forecasts.join(wanted, "post_code").select("place_name", *forecasts.columns)


def distinct_zips(zips: DataFrame, state: str | None = None) -> DataFrame:
    rows = zips if state is None else zips.filter(F.col("state") == state)
    return rows.agg(F.count_distinct("post_code").alias("zip_count"))


def newest_rows(df: DataFrame, n: int = 10, column: str = "audit_update_ts", tie=()) -> DataFrame:
    return df.orderBy(F.col(column).desc(), *tie).limit(n)


def data_volume(df: DataFrame, key: str = "post_code", time: str = "audit_update_ts") -> DataFrame:
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_distinct(key).alias("unique_keys"),
        F.min(time).alias("earliest"),
        F.max(time).alias("latest"),
    )


def distribution_by_key(df: DataFrame, key: str = "post_code", n: int = 15) -> DataFrame:
    """Row count and averages of the most frequent keys."""
    grouped = df.groupBy(key).agg(
        F.count("*").alias("record_count"),
        F.avg("temperature").alias("avg_temp"),
        F.avg(F.col("probabilityOfPrecipitation.value").cast("double")).alias("avg_precipitation"),
    )
    return grouped.orderBy(F.col("record_count").desc(), key).limit(n)


def forecast_patterns(df: DataFrame) -> DataFrame:
    """Count and temperatures per kind of weather, most frequent first."""
    grouped = df.groupBy("shortForecast").agg(
        F.count("*").alias("record_count"),
        F.avg("temperature").alias("avg_temp"),
        F.min("temperature").alias("min_temp"),
        F.max("temperature").alias("max_temp"),
        F.avg(F.col("probabilityOfPrecipitation.value").cast("double")).alias("avg_precipitation"),
    )
    return grouped.orderBy(F.col("record_count").desc(), "shortForecast")
