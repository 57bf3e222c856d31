import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gneiss.operators import merge

SCHEMA = "k INT, ts INT, v STRING"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_merge_columns_accepts_text_and_lists(spark):
    df = frame(spark, [])
    assert merge.merge_columns("k, ts", df) == (["k", "ts"], ["v"], ["k", "ts", "v"])
    assert merge.merge_columns(["k"], df)[1] == ["ts", "v"]
    with pytest.raises(ValueError):
        merge.merge_columns("missing", df)


def test_upsert_updates_inserts_and_keeps(spark, rows):
    target = frame(spark, [(1, 1, "a"), (2, 1, "b"), (None, 1, "n")])
    source = frame(spark, [(2, 0, "B"), (3, 1, "c"), (None, 2, "m")])
    assert rows(merge.merge_upsert(target, source, "k")) == [(1, 1, "a"), (2, 0, "B"), (3, 1, "c"), (None, 1, "n"), (None, 2, "m")]


def test_newer_by_is_strict_and_null_keeps_the_target(spark, rows):
    target = frame(spark, [(1, 5, "a"), (2, 5, "b"), (3, None, "c"), (4, 5, "d")])
    source = frame(spark, [(1, 5, "A"), (2, 6, "B"), (3, 9, "C"), (4, None, "D"), (5, None, "E")])
    merged = merge.merge_upsert(target, source, "k", newer_by="ts")
    assert rows(merged) == [(1, 5, "a"), (2, 6, "B"), (3, None, "c"), (4, 5, "d"), (5, None, "E")]


def test_update_columns_and_missing_columns(spark, rows):
    target = frame(spark, [(1, 1, "a"), (2, 1, "b")])
    source = frame(spark, [(2, 7, "B"), (3, 7, "c")])
    assert rows(merge.merge_upsert(target, source, "k", update_columns=["v"])) == [(1, 1, "a"), (2, 1, "B"), (3, 7, "c")]
    narrow = frame(spark, [(2, "B"), (3, "c")], "k INT, v STRING")
    assert rows(merge.merge_upsert(target, narrow, "k")) == [(1, 1, "a"), (2, 1, "B"), (3, None, "c")]


def test_target_rows_with_the_same_key_are_all_updated(spark, rows):
    target = frame(spark, [(1, 1, "a"), (1, 2, "b")])
    source = frame(spark, [(1, 3, "c")])
    assert rows(merge.merge_upsert(target, source, "k", newer_by="ts")) == [(1, 3, "c"), (1, 3, "c")]


def test_duplicate_source_keys_raise(spark):
    with pytest.raises(merge.DuplicateSourceKeys, match="1"):
        merge.merge_upsert(frame(spark, []), frame(spark, [(1, 1, "a"), (1, 2, "b")]), "k")


def test_unknown_source_columns_raise(spark):
    with pytest.raises(ValueError, match="extra"):
        merge.merge_upsert(frame(spark, []), frame(spark, [(1, 1)], "k INT, extra INT"), "k")


def test_empty_sides(spark, rows):
    some = [(1, 1, "a")]
    for newer in (None, "ts"):
        assert rows(merge.merge_upsert(frame(spark, []), frame(spark, some), "k", newer_by=newer)) == some
        assert rows(merge.merge_upsert(frame(spark, some), frame(spark, []), "k", newer_by=newer)) == some


states = st.dictionaries(st.integers(0, 6), st.tuples(st.integers(0, 3), st.sampled_from("abc")), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=states, new=states)
def test_merge_against_dictionaries(spark, rows, old, new):
    target = frame(spark, [(k, *v) for k, v in old.items()])
    source = frame(spark, [(k, *v) for k, v in new.items()])
    once = merge.merge_upsert(target, source, "k", check_duplicates=False)
    assert rows(once) == sorted(((k, *v) for k, v in {**old, **new}.items()), key=repr)
    assert rows(merge.merge_upsert(once, source, "k", check_duplicates=False)) == rows(once)
    newer = {k: v for k, v in new.items() if k not in old or v[0] > old[k][0]}
    conditional = merge.merge_upsert(target, source, "k", newer_by="ts", check_duplicates=False)
    assert rows(conditional) == sorted(((k, *v) for k, v in {**old, **newer}.items()), key=repr)


def test_incremental_filter(spark, rows):
    source = frame(spark, [(1, 1, "a"), (2, 5, "b"), (3, 6, "c")])
    mark = merge.high_water_mark(frame(spark, [(9, 5, "z")]), "ts")
    assert rows(merge.incremental_filter(source, "ts", mark), "k") == [(2,), (3,)]
    assert merge.incremental_filter(source, "ts", merge.high_water_mark(frame(spark, []), "ts")).count() == 3
    assert merge.incremental_filter(source, "ts", merge.high_water_mark(None, "ts")).count() == 3
    assert rows(merge.incremental_filter(source, "ts", mark, cutoff="6"), "k") == [(3,)]


def test_high_water_mark_reaches_the_scan(spark, plan, tmp_path):
    frame(spark, [(1, 1, "a"), (2, 5, "b")]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    text = plan(merge.incremental_filter(stored, "ts", "5").select("k", "ts"))
    assert "GreaterThanOrEqual(ts,5)" in text and "ReadSchema: struct<k:int,ts:int>" in text


def test_small_source_does_not_move_the_target(spark, plan, tmp_path):
    frame(spark, [(i, i, "a") for i in range(100)]).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    frame(spark, [(1, 1, "b")]).write.parquet(str(tmp_path / "s"))
    text = plan(merge.merge_upsert(target, spark.read.parquet(str(tmp_path / "s")), "k", check_duplicates=False))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
