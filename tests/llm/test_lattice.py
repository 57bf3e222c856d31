"""Links, counts and components against all pairs; the lattice itself."""

import itertools

import numpy as np
import pytest

from gneiss.llm import lattice

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def plain(rows, cosine=0.98):
    good = {}
    for n, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[n] = np.array(v, np.float32).astype(float)
    links, group = {n: 0 for n in range(len(rows))}, list(range(len(rows)))

    def find(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in itertools.combinations(good, 2):
        u, v = good[a], good[b]
        if rows[a][2] == rows[b][2] and len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= cosine:
            links[a], links[b] = links[a] + 1, links[b] + 1
            x, y = sorted((find(a), find(b)))
            group[y] = x
    out = []
    for n, (i, _, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if find(m) == find(n) and rows[m][0] is not None]
        out.append((i, links[n], min(ids) if ids else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for c in range(30):
        centre = rng.standard_normal(64)
        for _ in range(int(rng.integers(1, 8))):
            rows.append((len(rows), (centre + 0.11 * rng.standard_normal(64)).tolist(), c % 3))
    hot = rng.standard_normal(64)
    rows += [(len(rows) + i, (hot + 0.07 * rng.standard_normal(64)).tolist(), 1) for i in range(120)]
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(4)] + [(2000, [3 * x for x in rows[5][1]], rows[5][2])]
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_links_equal_all_pairs(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    got = lattice.near_vectors(spark.createDataFrame(vectors, SCHEMA).repartition(3)).collect()
    want = plain(vectors)
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)
    assert len(found) == len(want) and all(r.kept == (r.vec_id == r.component_id) for r in got)
    total, true = sum(r[1] for r in found), sum(r[1] for r in want)
    assert 0.99 * true <= total <= true and all(a[1] <= b[1] for a, b in zip(found, want))
    assert sum(a[2] != b[2] for a, b in zip(found, want)) <= 0.01 * len(want)


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0, 2.0, 3.0]
    rows = [(1, None, 0), (2, [], 0), (3, [0.0] * 3, 0), (4, [nan, 1.0, 2.0], 0), (5, [inf, 1.0, 1.0], 0), (6, good, None), (7, good, 0), (7, good, 0),
            (None, good, 0), (8, good, 1), (9, [1.0, 2.0], 0), (10, [1.0, None, 3.0], 0), (None, [5.0, -1.0, 0.0], 1), (11, [1e30, 2e30, 3e30], 0)]
    got = lattice.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == plain(rows)
    assert [r.kept for r in got if r.vec_id in (1, 2, 3)] == [True] * 3
    assert lattice.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(1)
    y = rng.uniform(-2, 2, (200, 8))
    points = lattice.nearest_lattice(y)
    assert np.allclose((2 * points) % 1, 0) and np.allclose(points.sum(axis=1) % 2, 0)
    near = points[:, None] + lattice.neighbours()[None]
    assert ((y[:, None] - near) ** 2).sum(axis=2).min(axis=1).min() >= 0
    assert (((y - points) ** 2).sum(axis=1) <= ((y[:, None] - near) ** 2).sum(axis=2).min(axis=1) + 1e-9).all()
    assert len(lattice.neighbours()) == 240 and np.allclose((lattice.neighbours() ** 2).sum(axis=1), 2)
