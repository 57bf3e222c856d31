import pytest
from pyspark.sql import functions as F

from gneiss.operators import keys


def test_latest_per_key_takes_first_in_order(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 5, "n"), (None, 4, "m")], "k STRING, s INT, v STRING")
    assert rows(keys.latest_per_key(df, "k", [F.col("s").desc()])) == [("a", 2, "y"), ("b", 1, "z"), (None, 5, "n")]


def test_latest_per_key_limits_groups_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(4)
    text = plan(keys.latest_per_key(df, ["k"], [F.col("id").desc()]))
    before = text[text.rindex("Exchange hashpartitioning(k"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_primary_key_reports_repeats_and_nulls(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "a INT, b STRING")
    assert rows(keys.check_primary_key(df, "a, b")) == [(1, "a", 2), (2, None, 1)]


def test_foreign_key_allows_null(spark, rows):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id INT, ref INT")
    parent = spark.createDataFrame([(10,), (11,)], "pk INT")
    assert rows(keys.check_foreign_key(child, parent, {"ref": "pk"})) == [(2, 99)]


def test_key_skew(spark, rows):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "k STRING")
    assert keys.key_skew(df, "k", 1).collect()[0].asDict() == {"key": "a", "record_count": 6, "share": 0.75, "ratio_to_mean": 1.5}
    assert keys.key_skew(df.limit(0), "k").count() == 0


def test_key_list_rejects_nothing():
    with pytest.raises(ValueError):
        keys.key_list("")


def test_dimension_keys_stays_distributed(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 1)], "k STRING, s INT")
    assert rows(keys.dimension_keys(df, "k", "s = 1")) == [("a",), ("c",)]
    assert rows(keys.dimension_keys(df, "k", "s = 1", 1)) == [("a",)]
