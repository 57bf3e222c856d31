"""Queries over forecasts: silver, alerts, expectations, gold, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from gneiss.operators import keys, quality
from gneiss.plans import gold, profile, silver
from workload.registry import query
from workload.shapes import PROCESSED, WEATHER_DAY
from workload.sql_shapes import FORECASTS, ZIPS
from workload.sql_shapes import silver as silver_sql


def with_forecasts(*parts: str) -> str:
    return "WITH " + ",".join([FORECASTS, *parts])


@query(with_forecasts(silver_sql()) + " SELECT * FROM silver")
def silver_forecasts(t):
    return silver.silver_forecasts(t.forecasts(), processed_at=PROCESSED)


@query(with_forecasts(silver_sql(sign="-", end_offset="own")) + " SELECT * FROM silver")
def silver_forecasts_correct_utc(t):
    return silver.silver_forecasts(t.forecasts(), "correct", "own", PROCESSED)


@query(
    with_forecasts(silver_sql())
    + " SELECT post_code, startTime, endTime, windSpeed, dewpoint, probabilityOfPrecipitation, relativeHumidity, audit_update_ts FROM silver"
)
def silver_without_utc(t):
    rows = silver.silver_forecasts(t.forecasts(), None, processed_at=PROCESSED)
    return rows.select("post_code", "startTime", "endTime", "windSpeed", "dewpoint", "probabilityOfPrecipitation", "relativeHumidity", "audit_update_ts")


DROPPED = """
  startTime IS NOT NULL AND endTime IS NOT NULL AND temperature > -100 AND temperature < 130
  AND (windSpeed >= 0 OR windSpeed IS NULL) AND (relativeHumidity BETWEEN 0 AND 100 OR relativeHumidity IS NULL)
  AND isDaytime IN (true, false)"""


@query(with_forecasts(silver_sql(end_offset="own")) + f" SELECT * FROM silver WHERE {DROPPED}")
def silver_append_end_offset(t):
    return silver.silver_append(t.forecasts(), processed_at=PROCESSED)


@query(with_forecasts(silver_sql()) + " SELECT * FROM silver WHERE windSpeed >= 0")
def expect_drop(t):
    return quality.expect(silver.silver_forecasts(t.forecasts(), processed_at=PROCESSED), silver.WIND_RULE, "drop")


RULES = {**silver.SILVER_RULES, **{f"table_{k}": v for k, v in silver.TABLE_RULES.items()}}


@query(
    with_forecasts(silver_sql(), "rules AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS name, ({p}) AS ok FROM silver" for n, p in RULES.items()) + ")")
    + """ SELECT name, CASE WHEN count(*) FILTER (WHERE ok) < count(*) THEN 'FAILED' ELSE 'PASSED' END AS status,
       count(*) FILTER (WHERE ok) AS passed_records, count(*) - count(*) FILTER (WHERE ok) AS failed_records,
       count(*) - count(*) FILTER (WHERE ok) AS dropped_records, count(*) FILTER (WHERE ok IS NULL) AS null_count,
       count(*) AS total_records FROM rules GROUP BY name"""
)
def expectation_metrics(t):
    return quality.expectation_metrics(silver.silver_forecasts(t.forecasts(), processed_at=PROCESSED), RULES, "drop")


ALERTS = """
 SELECT 'ALERT_' || post_code || '_' || CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT) AS alert_id, post_code,
   CASE WHEN temperature < 20 THEN 'EXTREME_COLD' WHEN temperature > 95 THEN 'EXTREME_HEAT' ELSE 'HIGH_PRECIPITATION' END AS alert_type,
   temperature, pop AS precipitation_prob, 'Weather alert for ' || post_code AS alert_message, TIMESTAMP '2024-02-01' AS created_at
 FROM forecasts WHERE temperature < 20 OR temperature > 95 OR pop > 80"""


@query(with_forecasts() + ALERTS)
def alerts(t):
    return silver.alerts(t.forecasts(), as_of=PROCESSED)


GOLD = """
 SELECT startTime, place_name, state, s.post_code, temperature, probabilityOfPrecipitation, windSpeed,
   CAST(startTimeUTC AS DATE) AS forecast_date_utc, CAST(CAST(startTime AS TIMESTAMP) AS DATE) AS forecast_date_local_tz
 FROM silver s JOIN zips z ON s.post_code = z.post_code"""


@query(with_forecasts(silver_sql(), ZIPS) + GOLD + " WHERE CAST(startTimeUTC AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-25'")
def gold_ten_day(t):
    return gold.gold_ten_day(silver.silver_forecasts(t.forecasts()), t.zips(), WEATHER_DAY)


@query(
    with_forecasts(silver_sql(), ZIPS) + ", g AS (" + GOLD
    + " WHERE CAST(startTimeUTC AS DATE) >= DATE '2024-01-25') SELECT *, TIMESTAMP '2024-02-01' AS audit_update_ts FROM g"
)
def gold_beyond(t):
    return gold.gold_beyond(silver.silver_forecasts(t.forecasts()), t.zips(), WEATHER_DAY, processed_at=PROCESSED)


@query(
    with_forecasts(silver_sql(), ZIPS) + ", g AS (" + GOLD
    + """ WHERE CAST(startTimeUTC AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-25' AND s.post_code = '00007')
    SELECT forecast_date_local_tz, max(temperature) AS max_temperature, min(temperature) AS min_temperature FROM g GROUP BY ALL"""
)
def daily_high_low(t):
    return gold.daily_high_low(silver.silver_forecasts(t.forecasts()), t.zips(), "00007", WEATHER_DAY)


def extremes_sql(where: str) -> str:
    return with_forecasts(silver_sql(), ZIPS) + f""", daily AS (
      SELECT s.post_code, place_name, state, temperature, probabilityOfPrecipitation, windSpeed, startTime AS localTime,
             CAST(startTimeUTC AS DATE) AS forecast_date
      FROM silver s JOIN zips z ON s.post_code = z.post_code {where}),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY state, forecast_date ORDER BY temperature, place_name, post_code, localTime, probabilityOfPrecipitation, windSpeed NULLS FIRST) AS low,
                row_number() OVER (PARTITION BY state, forecast_date ORDER BY temperature DESC, place_name, post_code, localTime, probabilityOfPrecipitation, windSpeed NULLS FIRST) AS high
      FROM daily)
    SELECT * EXCLUDE (low, high), 'LOWEST' AS temperature_type FROM ranked WHERE low = 1
    UNION ALL BY NAME SELECT * EXCLUDE (low, high), 'HIGHEST' AS temperature_type FROM ranked WHERE high = 1"""


@query(extremes_sql("WHERE CAST(startTimeUTC AS DATE) >= DATE '2024-01-15'"))
def state_extremes(t):
    return gold.state_extremes(silver.silver_forecasts(t.forecasts()), t.zips(), WEATHER_DAY)


@query(extremes_sql(""))
def state_extremes_all_days(t):
    return gold.state_extremes(silver.silver_forecasts(t.forecasts()), t.zips())


@query(with_forecasts(silver_sql()) + " SELECT * FROM silver WHERE post_code = '00007' AND CAST(startTimeUTC AS DATE) = DATE '2024-01-15'")
def local_snapshot(t):
    return gold.snapshot(silver.silver_forecasts(t.forecasts(), processed_at=PROCESSED), "00007", WEATHER_DAY)


@query("WITH " + ZIPS + " SELECT state_abbreviation, count(*) AS zip_count FROM zips GROUP BY ALL")
def zips_per_state(t):
    return profile.zips_per_state(t.zips())


@query("WITH " + ZIPS + " SELECT count(DISTINCT post_code) AS zip_count FROM zips WHERE state = 'NATION_3'")
def distinct_zips(t):
    return profile.distinct_zips(t.zips(), "NATION_3")


@query(with_forecasts(silver_sql(), ZIPS) + " SELECT place_name, s.* FROM silver s JOIN zips z ON s.post_code = z.post_code WHERE state_abbreviation = 'N07'")
def state_forecasts(t):
    return profile.state_forecasts(silver.silver_forecasts(t.forecasts(), processed_at=PROCESSED), t.zips(), "N07")


@query(with_forecasts() + " SELECT post_code, startTime, count(*) AS record_count FROM forecasts GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t):
    return keys.duplicate_keys(t.forecasts(), ["post_code", "startTime"])


@query(with_forecasts(silver_sql()) + " SELECT * FROM silver ORDER BY audit_update_ts DESC, post_code LIMIT 10")
def newest_rows(t):
    return profile.newest_rows(silver.silver_forecasts(t.forecasts(), processed_at=PROCESSED), 10, tie=["post_code"])


@query(with_forecasts() + """ SELECT count(*) AS total_records, count(DISTINCT post_code) AS unique_keys,
  min(audit_update_ts) AS earliest, max(audit_update_ts) AS latest FROM forecasts""")
def data_volume(t):
    return profile.data_volume(t.forecasts())


@query(with_forecasts() + """ SELECT post_code, count(*) AS record_count, avg(temperature) AS avg_temp, avg(pop) AS avg_precipitation
  FROM forecasts GROUP BY ALL ORDER BY record_count DESC, post_code LIMIT 15""")
def distribution_by_key(t):
    return profile.distribution_by_key(t.forecasts())


@query(with_forecasts() + """ SELECT shortForecast, count(*) AS record_count, avg(temperature) AS avg_temp, min(temperature) AS min_temp,
  max(temperature) AS max_temp, avg(pop) AS avg_precipitation FROM forecasts GROUP BY ALL""")
def forecast_patterns(t):
    return profile.forecast_patterns(t.forecasts())


@query(with_forecasts() + """, c AS (SELECT post_code AS key, count(*) AS record_count FROM forecasts GROUP BY ALL)
  SELECT key, record_count, record_count / (SELECT sum(record_count) FROM c)::DOUBLE AS share,
         record_count / (SELECT avg(record_count) FROM c) AS ratio_to_mean FROM c ORDER BY record_count DESC, key LIMIT 10""")
def key_skew(t):
    return keys.key_skew(t.forecasts(), "post_code", 10)


@query("WITH " + ZIPS + " SELECT DISTINCT post_code FROM zips WHERE state = 'NATION_3'")
def dimension_keys(t):
    return keys.dimension_keys(t.zips(), "post_code", F.col("state") == "NATION_3")


@query(with_forecasts(silver_sql()) + """, counted AS (SELECT count(*) AS n FROM silver), bronze AS (SELECT count(*) AS n FROM forecasts)
  SELECT b.n AS bronze_rows, c.n AS silver_rows FROM bronze b, counted c""")
def layer_counts(t):
    """Rows per layer in one row, the silver count as a scalar."""
    silver_rows = silver.silver_forecasts(t.forecasts()).agg(F.count("*").alias("n")).scalar()
    return t.forecasts().agg(F.count("*").alias("bronze_rows")).select("bronze_rows", silver_rows.alias("silver_rows"))
