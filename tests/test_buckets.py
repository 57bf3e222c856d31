"""Merges into bucketed tables equal other merges, and leave the target where it lies."""

import random

import pytest

from gneiss.operators import merge
from gneiss.sources import buckets

SCHEMA = "a INT, b STRING, at INT, x DOUBLE, y STRING"


def table(spark, seed, n, unique=True):
    rng = random.Random(seed)
    data = {}
    for i in range(n):
        key = (rng.choice([None, *range(40)]), rng.choice(["u", "v", None]))
        row = (*key, rng.choice([None, 1, 2, 3]), float(i), f"{seed}-{i}")
        if not unique or None in key or key not in data:
            data[key if unique and None not in key else (key, i)] = row
    return spark.createDataFrame(list(data.values()), SCHEMA)


@pytest.mark.parametrize("options", [{}, {"newer_by": "at"}, {"update_columns": ["x"]}, {"newer_by": "at", "update_columns": ["y"]}])
def test_merge_equals_the_general_one(spark, rows, tmp_path, options):
    target, source = table(spark, 1, 90), table(spark, 2, 60).drop("y" if options.get("update_columns") == ["x"] else "z")
    stored = buckets.create_bucketed(target, str(tmp_path), "a, b", 4)
    got = stored.merge(source, **options)
    assert rows(got.read()) == rows(merge.merge_upsert(target, source, ["a", "b"], **options))
    assert rows(stored.read()) == rows(target)


def test_repeated_merges_and_refusals(spark, rows, tmp_path):
    stored = buckets.create_bucketed(table(spark, 1, 50), str(tmp_path), ["a", "b"], 3)
    want = table(spark, 1, 50)
    for seed in (5, 6, 7):
        stored, want = stored.merge(table(spark, seed, 40), newer_by="at"), merge.merge_upsert(want, table(spark, seed, 40), ["a", "b"], newer_by="at")
        want = spark.createDataFrame(want.collect(), SCHEMA)
    assert rows(stored.read()) == rows(want)
    twice = spark.createDataFrame([(1, "u", 1, 1.0, "p"), (1, "u", 2, 1.0, "q")], SCHEMA)
    with pytest.raises(merge.DuplicateSourceKeys):
        stored.merge(twice)
    with pytest.raises(ValueError, match="more"):
        stored.merge(table(spark, 1, 3).withColumnRenamed("x", "more"))


def test_the_target_is_not_moved(spark, tmp_path, plan):
    stored = buckets.create_bucketed(table(spark, 1, 90), str(tmp_path), "a, b", 4)
    merged = buckets.merge_in_place(stored.read(), table(spark, 2, 60), "a, b", 4, "at")
    merged.collect()
    text = plan(merged).split("Initial Plan")[0]
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "bucketed_" in line)
    assert text.count("FileScan parquet") == 1 and "Bucketed: true" in lines[scan]
    depth, above = lines[scan].index("FileScan"), []
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            above.append(line)
            depth = at
    assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)
    # The next version is written by bucket without a shuffle of its own: one file for each bucket at most.
    later = stored.merge(table(spark, 2, 60), newer_by="at")
    assert len(later.read().inputFiles()) <= 4
