from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gneiss.operators import changes

SCHEMA = "k INT, v STRING"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_change_feed_kinds(spark, rows):
    old = frame(spark, [(1, "a"), (2, "b"), (3, None), (4, None), (None, "n")])
    new = frame(spark, [(2, "B"), (3, None), (4, "d"), (5, "e"), (None, "m")])
    feed = changes.change_feed(old, new, "k", 7, "2024-01-01")
    assert rows(feed, "k", "v", "_change_type") == sorted([
        (1, "a", "delete"), (2, "b", "update_preimage"), (2, "B", "update_postimage"), (4, None, "update_preimage"),
        (4, "d", "update_postimage"), (5, "e", "insert"), (None, "n", "delete"), (None, "m", "insert"),
    ], key=repr)
    assert rows(feed.select("_commit_version").distinct()) == [(7,)]
    assert changes.strip_change_columns(feed).columns == ["k", "v"]
    assert changes.change_feed(old.limit(0), new.limit(0), "k", 1).count() == 0


states = st.dictionaries(st.integers(0, 6), st.sampled_from(["a", "b", None]), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=states, new=states)
def test_feed_applied_to_old_gives_new(spark, rows, old, new):
    before = frame(spark, list(old.items())).withColumn("_commit_version", F.lit(0).cast("bigint"))
    feed = changes.change_feed(frame(spark, list(old.items())), frame(spark, list(new.items())), "k", 1)
    after, _ = changes.scd1_apply(before, feed, "k", "_commit_version", F.col("_change_type") == "delete")
    assert rows(after, "k", "v") == sorted(new.items(), key=repr)


CHANGE = "k INT, v STRING, seq INT, op STRING"


def test_scd1_orders_by_sequence_and_remembers_deletes(spark, rows):
    target = frame(spark, [(1, "a", 5), (2, "b", 5), (3, "c", None)], "k INT, v STRING, seq INT")
    first = frame(spark, [
        (1, "old", 4, "U"), (1, "new", 8, "U"), (1, "mid", 6, "U"), (2, None, 7, "D"), (3, "C", 1, "U"), (4, "d", 1, "U"), (5, "e", None, "U"),
    ], CHANGE)
    rows_1, graves = changes.scd1_apply(target, first, "k", "seq", "op = 'D'", ["op"])
    assert rows(rows_1) == sorted([(1, "new", 8), (3, "C", 1), (4, "d", 1), (5, "e", None)], key=repr)
    assert rows(graves) == [(2, 7)]
    late = frame(spark, [(2, "late", 6, "U"), (1, None, 9, "D")], CHANGE)
    rows_2, graves_2 = changes.scd1_apply(rows_1, late, "k", "seq", "op = 'D'", ["op"], graves)
    assert rows(rows_2) == sorted([(3, "C", 1), (4, "d", 1), (5, "e", None)], key=repr)
    assert rows(graves_2) == [(1, 9), (2, 7)]
    back, none = changes.scd1_apply(rows_2, frame(spark, [(2, "back", 8, "U")], CHANGE), "k", "seq", "op = 'D'", ["op"], graves_2)
    assert (2, "back", 8) in rows(back) and rows(none) == [(1, 9)]


def test_scd1_equal_sequence_keeps_the_target(spark, rows):
    target = frame(spark, [(1, "a", 5)], "k INT, v STRING, seq INT")
    after, _ = changes.scd1_apply(target, frame(spark, [(1, "b", 5, "U")], CHANGE), "k", "seq", except_columns=["op"])
    assert rows(after) == [(1, "a", 5)]


def test_preimages_never_win(spark, rows):
    feed = frame(spark, [(1, "old", 2, "update_preimage"), (1, "new", 2, "update_postimage")], "k INT, v STRING, seq INT, _change_type STRING")
    assert rows(changes.newest_changes(feed, "k", "seq"), "v") == [("new",)]
    assert rows(changes.upsert_rows(feed), "v") == [("new",)]


def test_small_changes_do_not_move_the_target(spark, plan, tmp_path):
    spark.range(1000).selectExpr("id AS k", "1 AS seq", "'a' AS v").write.parquet(str(tmp_path / "t"))
    spark.range(3).selectExpr("id * 900 AS k", "2 AS seq", "'b' AS v").write.parquet(str(tmp_path / "c"))
    stored, new = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "c"))
    alive, _ = changes.scd1_apply(stored, new, ["k"], "seq")
    assert alive.count() == 1001 and alive.filter("v = 'b'").count() == 3
    text = plan(alive)
    assert "FullOuter" not in text and "SortMergeJoin" not in text
