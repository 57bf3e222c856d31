"""Snapshots of the order book, against brute force over odd rows, and what their plans do for each order."""

import datetime
import random

from workload.shapes import SNAPSHOT_DATES, Shapes

SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ"


def years_before(at, years):
    return at.replace(year=at.year - years)


def orders(rng):
    edges = [datetime.datetime.fromisoformat(d) for d in SNAPSHOT_DATES]
    edges += [years_before(d, n) for d in edges for n in (1, 3)]
    dates = [None, *[d + datetime.timedelta(microseconds=m) for d in edges for m in (-1, 0, 1)]]
    rows = [(i, rng.choice([None, 1, 2]), s, rng.choice([None, 1.5]), d) for i, (s, d) in enumerate((s, d) for s in (None, "F", "O", "P") for d in dates)]
    return [*rows, *rows[:40], (None, 1, "O", 2.0, edges[0])]


def brute(rows, date):
    at = datetime.datetime.fromisoformat(date)
    for key, customer, status, price, day in rows:
        if day is not None and day <= at and ((status is not None and status != "F") or day > years_before(at, 3)):
            yield key, customer, "P" if day > years_before(at, 1) else status, price


def shapes(spark, folder):
    data = orders(random.Random(1))
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{folder}/orders.parquet")
    return data, Shapes(spark, str(folder))


def test_snapshots_equal_brute_force(spark, rows, tmp_path):
    data, t = shapes(spark, tmp_path)
    every = t.snapshots()
    for version, date in enumerate(SNAPSHOT_DATES, 1):
        want = sorted(brute(data, date), key=repr)
        assert want and rows(t.snapshot(version)) == want
        assert rows(every.filter(every.version == version).drop("version")) == want
    assert every.dtypes[0] == ("version", "bigint") and every.dtypes[1:] == t.snapshot(1).dtypes


def test_dates_are_constants_and_one_snapshot_derives_no_other(spark, plan, tmp_path):
    _, t = shapes(spark, tmp_path)
    assert "transform(" not in plan(t.snapshots()) and "lambda" not in plan(t.snapshots())
    assert "Generate" not in plan(t.snapshot(2)) and "LessThanOrEqual(o_orderdate" in plan(t.snapshot(2))
