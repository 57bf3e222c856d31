import pytest

from gneiss.operators import quality

RULES = {"positive": "x > 0", "known": "x IS NOT NULL", "small": "x < 5 OR x IS NULL"}


def frame(spark):
    return spark.createDataFrame([(1,), (0,), (None,), (9,)], "x INT")


def test_drop_counts_null_as_violated_and_warn_keeps_all(spark, rows):
    assert rows(quality.expect(frame(spark), RULES, "drop")) == [(1,)]
    assert quality.expect(frame(spark), RULES).count() == 4
    assert quality.expect(frame(spark), {}, "drop").count() == 4
    with pytest.raises(ValueError):
        quality.expect(frame(spark), RULES, "explode")


def test_metrics_per_rule(spark, rows):
    assert rows(quality.expectation_metrics(frame(spark), RULES, "drop")) == [
        ("known", "FAILED", 3, 1, 1, 0, 4), ("positive", "FAILED", 2, 2, 2, 1, 4), ("small", "FAILED", 3, 1, 1, 0, 4),
    ]
    assert rows(quality.expectation_metrics(frame(spark).limit(0), {"any": "x > 0"})) == [("any", "PASSED", 0, 0, 0, 0, 0)]


def test_metrics_need_one_scan(spark, plan, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "x"))
    assert plan(quality.expectation_metrics(spark.read.parquet(str(tmp_path / "x")), RULES)).count("FileScan") == 1


def test_observed_violations(spark):
    from pyspark.sql import Observation

    seen = Observation("seen")
    quality.observe_expectations(frame(spark), RULES, seen).collect()
    assert seen.get == {"total_records": 4, "positive": 2, "known": 1, "small": 1}
