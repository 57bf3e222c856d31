import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gneiss.operators import history

SCHEMA = "v INT, k INT, x STRING"


def brute_force(snapshots):
    """Histories by walking the versions in order: {key: [(value, start, end)]}."""
    open_rows, done = {}, []
    for version in sorted(snapshots):
        state = snapshots[version]
        for key in list(open_rows):
            if key not in state or state[key] != open_rows[key][0]:
                value, start = open_rows.pop(key)
                done.append((key, value, start, version))
        for key, value in state.items():
            open_rows.setdefault(key, (value, version))
    return sorted(done + [(k, v, s, None) for k, (v, s) in open_rows.items()], key=repr)


snapshots = st.dictionaries(
    st.integers(1, 9), st.dictionaries(st.integers(0, 4), st.sampled_from(["a", "b", None]), min_size=1, max_size=4), min_size=1, max_size=5
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(given_snapshots=snapshots)
def test_one_pass_and_folding_agree_with_brute_force(spark, rows, given_snapshots):
    data = [(v, k, x) for v, state in given_snapshots.items() for k, x in state.items()]
    want = brute_force(given_snapshots)
    assert rows(history.scd2_from_snapshots(spark.createDataFrame(data, SCHEMA), "k", "v")) == want
    folded = spark.createDataFrame([], "k INT, x STRING, __START_AT INT, __END_AT INT")
    for version in sorted(given_snapshots):
        taken = spark.createDataFrame(list(given_snapshots[version].items()), "k INT, x STRING")
        folded = spark.createDataFrame(history.scd2_apply_snapshot(folded, taken, "k", version).collect(), folded.schema)
    assert rows(folded) == want


def test_versions_must_increase(spark):
    past = spark.createDataFrame([(1, "a", 3, None)], "k INT, x STRING, __START_AT INT, __END_AT INT")
    with pytest.raises(ValueError, match="not above"):
        history.scd2_apply_snapshot(past, spark.createDataFrame([(1, "b")], "k INT, x STRING"), "k", 3)


def test_key_that_leaves_and_returns(spark, rows):
    data = [(1, 7, "a"), (2, 8, "z"), (3, 7, "a"), (3, 8, "z")]
    assert rows(history.scd2_from_snapshots(spark.createDataFrame(data, SCHEMA), "k", "v")) == [
        (7, "a", 1, 2), (7, "a", 3, None), (8, "z", 2, None),
    ]
