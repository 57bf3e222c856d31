"""Removed words against brute force over all windows."""

import random
from collections import Counter

import pytest

from gneiss.llm import substring_dedup


def plain(rows, k):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    counts = Counter(tuple(w[p:p + k]) for _, w in words for p in range(len(w) - k + 1))
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - k + 1):
            if counts[tuple(w[p:p + k])] > 1:
                gone |= set(range(p, p + k))
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"p{j}_{i}" for i in range(n)] for j, n in enumerate((6, 12, 30, 80))]
    rows = []
    for i in range(60):
        words = [rng.choice("abcdefgh") if i % 5 == 0 else f"{i}.{j}" for j in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            a = rng.randint(0, len(passage) // 2)
            at = rng.randint(0, len(words))
            words[at:at] = passage[a:rng.randint(a, len(passage))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    return [*rows, (100, rows[3][1]), (101, "z " * 50), (102, "x y " * 30)]


@pytest.mark.parametrize("seed, k", [(1, 6), (2, 6), (3, 11), (4, 35), (5, 2), (6, 1)])
def test_removed_words_equal_brute_force(documents, seed, k):
    rows = corpus(seed)
    got = substring_dedup.substring_dedup(documents(rows), k).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, k)


def test_a_full_filter_changes_nothing(documents, monkeypatch):
    """All minimizers in one of few bits: the filter lets everything pass, the result stays."""
    monkeypatch.setattr(substring_dedup, "FILTER_BITS", 64)
    rows = corpus(9)
    got = substring_dedup.substring_dedup(documents(rows), 6).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, 6)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = substring_dedup.substring_dedup(odd.selectExpr("*", "1 AS key", "2 AS spans"), 3).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, 3)
    assert substring_dedup.substring_dedup(odd.limit(0), 3).count() == 0
