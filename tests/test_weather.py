import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gneiss.plans import gold, profile, silver

BRONZE = (
    "post_code STRING, startTime STRING, endTime STRING, isDaytime BOOLEAN, temperature BIGINT, "
    "probabilityOfPrecipitation STRUCT<unitCode: STRING, value: BIGINT>, dewpoint STRUCT<unitCode: STRING, value: DOUBLE>, "
    "relativeHumidity STRUCT<unitCode: STRING, value: BIGINT>, windSpeed STRING, audit_update_ts TIMESTAMP"
)
NOW = dt.datetime(2024, 1, 2)


def forecast(start, end=None, code="00501", temperature=50, wind="12 mph", wet=10, humidity=40, day=True):
    return (code, start, end or start, day, temperature, ("%", wet), ("C", 1.5), ("%", humidity), wind, NOW)


def frame(spark, *data):
    return spark.createDataFrame(list(data), BRONZE)


def times(spark, mode, end_offset="start"):
    df = frame(spark, forecast("2024-01-01T12:00:00-05:00", "2024-01-01T13:00:00+01:00"), forecast("2024-01-01T12:00:00"))
    return [(r.timezoneOffset, r.startTime, r.startTimeUTC.hour, r.endTimeUTC.hour) for r in silver.silver_forecasts(df, mode, end_offset).collect()]


def test_utc_modes_and_end_offsets(spark):
    local, plain = "2024-01-01T12:00:00", ("", "2024-01-01T12:00:00", 12, 12)
    assert times(spark, "reference") == [("-05:00", local, 7, 8), plain]
    assert times(spark, "reference", "own") == [("-05:00", local, 7, 14), plain]
    assert times(spark, "correct") == [("-05:00", local, 17, 18), plain]
    assert times(spark, "correct", "own") == [("-05:00", local, 17, 12), plain]
    without = silver.silver_forecasts(frame(spark, forecast("x")), None)
    assert "startTimeUTC" not in without.columns
    with pytest.raises(ValueError):
        silver.silver_forecasts(frame(spark), "local")


@pytest.mark.parametrize("text, speed", [("12 mph", 12), ("10 to 15 mph", 10), ("calm", None), ("", None), (None, None), ("99999999999 mph", None)])
def test_wind_speed(spark, text, speed):
    assert silver.silver_forecasts(frame(spark, forecast("2024-01-01T12:00:00", wind=text))).collect()[0].windSpeed == speed


def test_unreadable_times_become_null(spark):
    row = silver.silver_forecasts(frame(spark, forecast("soon-05:00"))).collect()[0]
    assert row.startTimeUTC is None and row.timezoneOffset == "-05:00" and row.startTime == "soon"


def test_silver_append_drops_each_kind_of_violation(spark):
    at = "2024-01-01T12:00:00"
    good = [forecast(at), forecast(at, wind="calm"), forecast(at, humidity=None)]
    bad = [forecast(at, temperature=130), forecast(at, humidity=101), forecast(at, day=None), forecast(None), forecast(at, temperature=None)]
    assert silver.silver_append(frame(spark, *good, *bad)).count() == len(good)


def test_alert_order(spark, rows):
    df = frame(spark, *[forecast("t", temperature=t, wet=w) for t, w in [(19, 90), (20, 80), (96, 0), (95, 81), (None, 99), (10, None)]])
    found = silver.alerts(df, as_of="2024-01-01 00:00:00")
    assert rows(found, "alert_type", "temperature", "precipitation_prob") == sorted([
        ("EXTREME_COLD", 19, 90), ("EXTREME_HEAT", 96, 0), ("HIGH_PRECIPITATION", 95, 81), ("HIGH_PRECIPITATION", None, 99), ("EXTREME_COLD", 10, None),
    ], key=repr)
    assert found.collect()[0].alert_id == "ALERT_00501_1704067200"


def zips(spark):
    return spark.createDataFrame([("00501", "Low", "NY", "NY"), ("00502", "High", "NY", "NY"), ("90210", "Hills", "CA", "CA")],
                                 "post_code STRING, place_name STRING, state STRING, state_abbreviation STRING")


def test_state_extremes_against_brute_force(spark):
    rng = random.Random(5)
    data = [forecast(f"2024-01-0{rng.randint(1, 3)}T{rng.randint(10, 20)}:00:00", code=rng.choice(["00501", "00502", "90210", "99999"]),
                     temperature=rng.choice([None, *range(-3, 3)])) for _ in range(60)]
    flat = silver.silver_forecasts(frame(spark, *data))
    places = {r.post_code: r for r in zips(spark).collect()}
    groups = {}
    for r in flat.collect():
        if r.post_code in places and r.temperature is not None:
            z = places[r.post_code]
            groups.setdefault((z.state, r.startTimeUTC.date()), []).append((r.temperature, z.place_name, r.post_code, r.startTime))
    want = set()
    for (state, day), found in groups.items():
        want.add((state, day, "LOWEST", *min(found)))
        want.add((state, day, "HIGHEST", *min(found, key=lambda f: (-f[0], *f[1:]))))
    got = {(r.state, r.forecast_date, r.temperature_type, r.temperature, r.place_name, r.post_code, r.localTime) for r in gold.state_extremes(flat, zips(spark)).collect()}
    assert got == want
    later = gold.state_extremes(flat, zips(spark), "2024-01-03").collect()
    assert {r.forecast_date for r in later} == {dt.date(2024, 1, 3)}


def test_ten_days_include_both_ends(spark, rows):
    flat = silver.silver_forecasts(frame(spark, *[forecast(f"2024-01-{d:02}T12:00:00", temperature=d) for d in range(1, 31)]))
    assert sorted(r[0] for r in rows(gold.gold_ten_day(flat, zips(spark), "2024-01-05"), "temperature")) == list(range(5, 16))
    assert sorted(r[0] for r in rows(gold.gold_beyond(flat, zips(spark), "2024-01-05"), "temperature")) == list(range(15, 31))
    assert gold.daily_high_low(flat, zips(spark), "501", "2024-01-05").count() == 0
    assert gold.daily_high_low(flat, zips(spark), "00501", "2024-01-05").count() == 11
    assert rows(gold.snapshot(flat, "00501", "2024-01-05"), "temperature") == [(5,)]


def test_gold_reads_only_needed_columns(spark, plan, tmp_path):
    flat = silver.silver_forecasts(frame(spark, forecast("2024-01-01T12:00:00")))
    flat.write.parquet(str(tmp_path / "f"))
    text = plan(gold.state_extremes(spark.read.parquet(str(tmp_path / "f")), zips(spark)))
    assert "detailedForecast" not in text and "isDaytime" not in text and "Window" not in text


def test_profiles(spark, rows):
    df = frame(spark, forecast("a"), forecast("b", code="00502"), forecast("c", code="00502", temperature=70)).withColumn("shortForecast", F.lit("Sunny"))
    assert rows(profile.data_volume(df), "total_records", "unique_keys") == [(3, 2)]
    assert rows(profile.distribution_by_key(df, n=1)) == [("00502", 2, 60.0, 10.0)]
    assert rows(profile.forecast_patterns(df), "record_count", "min_temp", "max_temp") == [(3, 50, 70)]
    assert [tuple(r) for r in profile.zips_per_state(zips(spark)).collect()] == [("NY", 2), ("CA", 1)]
    assert rows(profile.state_forecasts(df, zips(spark), "NY"), "place_name") == [("High",), ("High",), ("Low",)]
    assert rows(profile.distinct_zips(zips(spark))) == [(3,)]
    assert profile.newest_rows(df, 2).count() == 2


def test_manual_names(spark, rows):
    df = spark.createDataFrame([("2000", "Ann", "X", "F", 1, "f.csv")], "year STRING, first_name STRING, county STRING, sex STRING, count INT, file_name STRING")
    assert rows(silver.manual_names(df, "Bo", "male").drop("audit_update_ts")) == [("2000", "Bo", "X", "male", 1, "manual_add")]
