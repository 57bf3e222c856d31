"""A view refreshed by change feeds equals one computed anew."""

import random

import pytest

from gneiss.operators import changes
from gneiss.plans import views

SCHEMA = "id INT, g STRING, h INT, x DOUBLE, n INT"


def state(rng, before):
    rows = {k: r for k, r in before.items() if rng.random() < 0.8}
    for i in rng.sample(range(80), 25):
        rows[i] = (i, rng.choice(["a", "b", "c", None]), rng.choice([1, None]), rng.choice([None, 0.1, 0.7, 2.5, -3.3]), rng.choice([None, 1, 2, 3]))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_refresh_equals_recompute(spark, rows, seed):
    rng = random.Random(seed)
    view = views.AggregateView.of("g, h", ["x", "n"], ["x", "n"])
    states = [state(rng, {})]
    for _ in range(3):
        states.append(state(rng, states[-1]))
    states.append({})
    tables = [spark.createDataFrame(list(s.values()), SCHEMA) for s in states]
    stored = view.full(tables[0])
    for version, (old, new) in enumerate(zip(tables, tables[1:])):
        refreshed = view.refresh(stored, changes.change_feed(old, new, "id", version, "2024-01-01"), new)
        assert refreshed.columns == stored.columns and refreshed.schema.simpleString() == stored.schema.simpleString()
        assert rows(refreshed) == rows(view.full(new))
        stored = spark.createDataFrame(refreshed.collect(), stored.schema)
    assert stored.count() == 0


def test_only_groups_that_lost_an_extreme_are_read_again(spark, monkeypatch):
    view = views.AggregateView.of("g", ["x"], ["x"])
    old = spark.createDataFrame([(i, f"g{i % 5}", 1, float(i), 1) for i in range(50)], SCHEMA)
    # g0 loses its greatest value, g1 a middle one, g2 gets a new greatest in place of the old one.
    new = old.where("id not in (45, 21, 47)").union(spark.createDataFrame([(99, "g2", 1, 99.0, 1)], SCHEMA))
    read, full = [], views.AggregateView.full

    def spy(self, df):
        read.append({r.g for r in df.select("g").distinct().collect()})
        return full(self, df)

    stored = view.full(old)
    monkeypatch.setattr(views.AggregateView, "full", spy)
    view.refresh(stored, changes.change_feed(old, new, "id", 1, "2024-01-01"), new).collect()
    assert read == [{"g0"}]


def test_staged_groups_are_joined_once(spark, rows, plan, tmp_path):
    rng = random.Random(7)
    view = views.AggregateView.of("g, h", ["x", "n"], ["x", "n"])
    before = state(rng, {})
    old, new = (spark.createDataFrame(list(s.values()), SCHEMA) for s in (before, state(rng, before)))
    feed = changes.change_feed(old, new, "id", 1, "2024-01-01")
    staged = view.refresh(view.full(old), feed, new, str(tmp_path / "moved"))
    assert "FullOuter" in plan(view.refresh(view.full(old), feed, new)) and "FullOuter" not in plan(staged)
    assert staged.schema.simpleString() == view.full(new).schema.simpleString() and rows(staged) == rows(view.full(new))
    assert spark.read.parquet(str(tmp_path / "moved")).filter("_lost").count() > 0
