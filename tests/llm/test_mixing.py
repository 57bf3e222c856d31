"""Targets and words taken against plain Python; training positions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gneiss.llm import mixing


def plain_targets(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Reshare the excess by weight until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, rest, left = {}, set(names), share * sum(sizes.values())
    while rest:
        total = sum(weight[s] for s in rest)
        over = {s for s in rest if left * weight[s] / total > most * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in rest})
            break
        target.update({s: most * sizes[s] for s in over})
        left -= sum(most * sizes[s] for s in over)
        rest -= over
    return target


@pytest.fixture
def mixed(documents):
    rows = [(i, "w " * (i * 7 % 40), "en", [None, "a", "b", "c", "d", "é"][i * i % 6] if i % 3 else "a") for i in range(200)]
    return documents([*rows, (500, None, "en", "z"), (501, "", "en", "a")])


def test_targets_and_taken_words(mixed):
    got = mixing.mix(mixed).collect()
    sizes = {}
    for r in mixed.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    want = plain_targets(sizes)
    source = {r.doc_id: r.source for r in mixed.collect()}
    taken, order = {}, {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], abs=1e-5) and 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
        order.setdefault(s, []).append((hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.size, r.place))
    assert all(abs(taken[s] - want[s]) <= 0.51 for s in taken)
    for rows in order.values():
        at = 0
        for _, size, place in sorted(rows):
            assert place == at
            at += size


def test_reruns_agree_and_odd_rows(odd):
    first, second = (sorted(map(tuple, mixing.mix(odd.repartition(n)).collect()), key=str) for n in (2, 7))
    assert first == second and len(first) == odd.count()
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.mixed_documents(odd.limit(0)).count() == 0


def test_positions_follow_the_schedules(spark):
    rows = spark.range(0, 101).selectExpr("id", "CAST(id % 3 AS INT) AS rank")
    at = mixing.position(F.col("id"), F.lit(100.0), F.col("rank"))
    for r in rows.withColumn("t", at).collect():
        a, b = mixing.SCHEDULES[r.rank]
        assert (a * r.t + (b - a) * r.t * r.t / 2) / ((a + b) / 2) == pytest.approx(r.id / 100)


def test_mixed_documents_are_whole_and_in_order(mixed):
    plan = {r.doc_id: round(r.taken / r.size) if r.size else 0 for r in mixing.mix(mixed).collect()}
    clash = mixed.selectExpr("*", "1 AS target", "'x' AS place", "2 AS rank", "3 AS size", "4 AS key", "5 AS bucket")
    out = mixing.mixed_documents(clash)
    assert out.columns == clash.columns
    got, texts = {}, {r.doc_id: r.text for r in mixed.collect()}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
        assert r.text == texts[r.doc_id]
    near = {d: n for d, n in plan.items() if n}
    assert {d for d in near if near[d] != got.get(d)} <= {d for d in near if abs(near[d] - got.get(d, 0)) <= 1}
    assert sum(got.values()) == pytest.approx(sum(near.values()), abs=6)


def test_positions_follow_the_schedules(documents, odd):
    rows = documents([(i, "w " * (1 + i * 7 % 30), "en", f"s{i % 3}") for i in range(600)]).unionByName(odd)
    got = mixing.curriculum(rows).collect()
    assert len(got) == 611
    for r in got:
        goal = round(r.target)
        first, second = (max(0, min(r.size, goal - p * r.source_size - r.place)) for p in (0, 1))
        assert r.taken == first + second and (r.first_position is None) == (first == 0) and (r.second_position is None) == (second == 0)
        a, b = mixing.SCHEDULES[r.rank % 3]
        for p, at in ((0, r.first_position), (1, r.second_position)):
            if at is not None:
                # The share of the source's words that the schedule has asked for by then.
                asked = (a * at + (b - a) * at * at / 2) / ((a + b) / 2)
                assert 0 <= at <= 1 and abs(asked * r.target - (r.place + p * r.source_size)) < 1e-6 * r.target + 1e-6
    # The result is sorted by position over all partitions.
    order = [r.first_position for r in got]
    assert [x for x in order if x is not None] == sorted(x for x in order if x is not None)


def test_repeated_rows_are_taken_equally_often_and_reruns_agree(documents):
    """Rows of one id and text, in one source and over two, among others; however they are spread."""
    rows = [(i, "w " * (1 + i % 9), "en", f"s{i % 3}") for i in range(60)]
    rows += [(7, "a b c", "en", "s1")] * 40 + [(8, "d e", "en", f"s{i % 2}") for i in range(30)]
    runs = []
    for n in (1, 5, 9):
        got = {}
        for r in mixing.mixed_documents(documents(rows).repartition(n)).collect():
            got[r.doc_id, r.text, r.source] = got.get((r.doc_id, r.text, r.source), 0) + 1
        runs.append(got)
    assert runs[0] == runs[1] == runs[2]
    plan = [r for r in mixing.mix(documents(rows)).collect()]
    for doc_id, size, copies in ((7, 3, 40), (8, 2, 30)):
        mine = [r for r in plan if r.doc_id == doc_id and r.size == size]
        extra = [r for r in rows if r[0] == doc_id and len(r[1].split()) == size]
        assert len(mine) == len(extra) == copies
        times = round(sum(r.taken for r in mine) / sum(r.size for r in mine))
        found = {k: n for k, n in runs[0].items() if k[0] == doc_id and len(k[1].split()) == size}
        assert sum(found.values()) == times * copies and len(found) <= 2
