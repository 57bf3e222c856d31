"""Buckets of a key, few or many, give the rows that brute force gives."""

import random

import pytest
from pyspark.sql import functions as F

from gneiss.operators import ordered


@pytest.fixture(scope="module")
def readings():
    rng = random.Random(3)
    keys = ["hot"] * 300 + ["a"] * 40 + ["b"] * 3 + ["c"] + [None] * 20
    return [(k, i // 4, i, float(rng.randint(1, 50))) for i, k in enumerate(rng.sample(keys, len(keys)))]


SCHEMA = "k STRING, day INT, id INT, x DOUBLE"


def rolling_by_hand(data, first, last):
    out = {}
    for key in {r[0] for r in data}:
        group = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, row in enumerate(group):
            part = [r[3] for r in group[max(0, i + first):max(0, i + last + 1)]]
            out[row[2]] = sum(part) / len(part) if part else None
    return out


@pytest.mark.parametrize("buckets, bucket_rows", [(1024, 20_000), (7, 30), (500, 1)])
def test_rolling_mean(spark, readings, buckets, bucket_rows):
    df = spark.createDataFrame(readings, SCHEMA).repartition(4)
    got = ordered.rolling_mean(df, "k", ["day", "id"], "x", {"before": (-7, -1), "with": (-6, 0)}, buckets=buckets, bucket_rows=bucket_rows).collect()
    before, including = rolling_by_hand(readings, -7, -1), rolling_by_hand(readings, -6, 0)
    assert len(got) == len(readings)
    for row in got:
        assert row["before"] == (None if before[row["id"]] is None else pytest.approx(before[row["id"]]))
        assert row["with"] == pytest.approx(including[row["id"]])


def test_rolling_mean_with_buckets_smaller_than_the_frame(spark, readings):
    data = [r for r in readings if r[0] in ("hot", "a")][:40]
    got = ordered.rolling_mean(spark.createDataFrame(data, SCHEMA), "k", ["day", "id"], "x", {"m": (-7, -1)}, buckets=500, bucket_rows=1).collect()
    want = rolling_by_hand(data, -7, -1)
    assert {r["id"]: r["m"] for r in got} == {i: m if m is None else pytest.approx(m) for i, m in want.items()}


def test_frames_may_only_look_back(spark):
    with pytest.raises(ValueError):
        ordered.rolling_mean(spark.createDataFrame([], SCHEMA), "k", ["id"], "x", {"m": (-1, 1)})


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_next_at_or_after(spark, readings, width):
    data = [(k, day, i, "end" if x > 40 else "go") for k, day, i, x in readings]
    df = spark.createDataFrame(data, "k STRING, day INT, id INT, s STRING").repartition(4)
    got = ordered.next_at_or_after(df, "k", "day", {"next_end": F.col("s") == "end"}, F.floor(F.col("day") / width)).collect()
    assert len(got) == len(data)
    for row in got:
        ends = [d for k, d, _, s in data if k == row["k"] and s == "end" and d >= row["day"]]
        assert row["next_end"] == min(ends, default=None)


def test_building_starts_no_job(spark, readings):
    tracker, df = spark.sparkContext.statusTracker(), spark.createDataFrame(readings, SCHEMA)
    spark.sparkContext.setJobGroup("building", "")
    ordered.rolling_mean(df, "k", ["day", "id"], "x", {"m": (-7, -1)})
    ordered.next_at_or_after(df, "k", "day", {"n": F.col("x") > 40}, F.col("day"))
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("kind", ["text ids", "one outlier", "many types"])
def test_a_hot_key_is_spread_over_buckets(spark, kind):
    n = 6000
    ids = {"text ids": F.format_string("usage_%08d", F.col("id")), "one outlier": F.when(F.col("id") == 5, F.lit(10**15)).otherwise(F.col("id")),
           "many types": F.struct(F.col("id").cast("decimal(20,2)"), F.timestamp_seconds("id"))}[kind]
    # Two thirds of the rows are of one key and one day.
    df = spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
                               F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 9).cast("int").alias("day"), ids.alias("id"), (F.col("id") % 13).cast("double").alias("x"))
    cut = ordered.in_buckets(df.repartition(3), ["day", "id"], bucket_rows=100)
    sizes = [r["count"] for r in cut.groupBy("k", "_bucket").count().collect()]
    assert sum(sizes) == n and max(sizes) < 300 and 40 < cut.select("_bucket").distinct().count() <= 61
    again = ordered.in_buckets(df.repartition(5), ["day", "id"], bucket_rows=100)
    assert cut.exceptAll(again).count() == 0
    frames = {"m": (-7, -1), "n": (-3, 0)}
    got = ordered.rolling_mean(df, "k", ["day", "id"], "x", frames, bucket_rows=100)
    assert got.exceptAll(ordered.rolling_mean(df, "k", ["day", "id"], "x", frames)).count() == 0 and got.count() == n


def test_nulls_and_empty_tables_in_the_order(spark):
    df = spark.createDataFrame([("a", None, 1, 1.0), ("a", 1, None, 2.0), ("a", 2, 1, None), ("a", None, None, 4.0)], SCHEMA)
    got = {(r.day, r.id): r.m for r in ordered.rolling_mean(df, "k", ["day", "id"], "x", {"m": (-1, 0)}, bucket_rows=1).collect()}
    assert got == {(None, None): 4.0, (None, 1): 2.5, (1, None): 1.5, (2, 1): 2.0}
    assert ordered.rolling_mean(df.limit(0), "k", ["day", "id"], "x", {"m": (-1, 0)}).count() == 0
