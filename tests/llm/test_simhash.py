"""Fingerprints against plain Python, groups against all pairs, near copies by similarity."""

import random
import re

import numpy as np
import pytest
import xxhash

from gneiss.llm import simhash


def plain_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(points, reach):
    """The least index reachable for each index, by all pairs."""
    group = list(range(len(points)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= reach:
                a, b = sorted((find(i), find(j)))
                group[b] = a
    return [find(i) for i in range(len(points))]


def test_fingerprints_and_odd_rows(spark, odd):
    got = simhash.near_groups(odd).collect()
    assert len(got) == odd.count()
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    want = sorted((plain_fingerprint(t) for _, t in texts if t is None or len(t) < 1000))
    assert set(want) <= {r.fp & (2**64 - 1) for r in got}
    zero = {r.doc_id: r.component_id for r in got if r.fp == 0}
    assert set(zero.values()) == {1} and {1, 2, 3, None} <= set(zero)
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}


@pytest.mark.parametrize("leaf_size, block, reach", [(40, 10**6, 2), (40, 32, 2), (10**6, 64, 2), (60, 100, 4)])
def test_groups_of_a_split_tree_equal_all_pairs(spark, monkeypatch, leaf_size, block, reach):
    rng = random.Random(leaf_size + block)
    points = [rng.getrandbits(64) for _ in range(300)]
    for i in range(250):
        near = rng.choice(points[:60] if i % 3 else points)
        for _ in range(rng.randint(1, 3)):
            near ^= 1 << rng.randrange(64)
        points.append(near)
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(i, [p], None) for i, p in enumerate(signed)], "node BIGINT, fps ARRAY<BIGINT>, sketch BINARY")
    edges = simhash.links(nodes, reach, block=block, leaf_size=leaf_size).collect()
    assert len(edges) < 6 * len(points)
    assert all(bin(points[e.a] ^ points[e.b]).count("1") <= reach for e in edges)
    group = list(range(len(points)))
    for _ in range(len(points)):
        before = list(group)
        for e in edges:
            group[e.a] = group[e.b] = min(group[e.a], group[e.b])
        if before == group:
            break
    assert group == plain_groups(points, reach)


def test_every_pair_within_reach_meets_in_a_leaf():
    rng = np.random.default_rng(5)
    points = np.unique(rng.integers(0, 2**64, 400, np.uint64) & np.uint64(0x0F0F0F0F0F0F0F0F))
    tree, leaves = simhash.fit_tree(points, len(points), 3, 20)
    assert leaves > 4
    met = set()
    for leaf in range(leaves):
        member = np.concatenate([x for n, x, m in simhash.route(tree, points, 3) if n == leaf and m] or [np.empty(0, int)])
        visit = np.concatenate([x for n, x, m in simhash.route(tree, points, 3) if n == leaf and not m] or [np.empty(0, int)])
        met |= {frozenset((int(a), int(b))) for a in member for b in [*member, *visit]}
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1:] ^ points[i]) <= 3):
            assert frozenset((i, int(i + 1 + j))) in met


def test_near_copies_go_and_clean_documents_stay(documents):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(60, 300))) for _ in range(60)]
    rows, copies = [(i, t) for i, t in enumerate(texts)], {}
    for i in range(20):
        words = texts[i].split()
        for at in rng.sample(range(len(words)), 1 + len(words) // 100):
            words[at] = rng.choice(vocabulary)
        copies[1000 + i] = i
        rows.append((1000 + i, " ".join(words)))
    rows += [(2000, texts[30]), (2001, texts[30])]
    kept = simhash.drop_near_duplicates(documents(rows), shingle=1, distinct=True, bits=2, number=6, similarity=0.8)
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(60)) <= ids and not ids & {2000, 2001}
    assert len(ids & set(copies)) <= 1


def test_dropping_keeps_columns_and_one_of_repeated_rows(spark, odd):
    extra = odd.withColumnsRenamed({"lang": "key"}).selectExpr("*", "1 AS node", "2 AS component_id")
    kept = simhash.drop_near_duplicates(extra)
    assert kept.columns == extra.columns
    got = kept.collect()
    assert sorted((r.doc_id for r in got if r.text == "a"), key=str) == [4] and len([r for r in got if r.doc_id in (5, 6)]) == 1
    assert simhash.drop_near_duplicates(odd.limit(0)).count() == 0


def jaccard(a, b, width=5):
    one, two = ({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} for w in (a.split(), b.split()))
    return len(one & two) / len(one | two)


@pytest.mark.parametrize("block", [4096, 8])
def test_links_ask_for_the_similarity_of_the_sets_themselves(spark, documents, monkeypatch, block):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(60):
        words = rng.choices(vocabulary, k=300)
        copy = list(words)
        # Equal words in another order keep the fingerprints, so the shingles alone decide: 0.74 to 0.86 similar.
        for at in range(10, 10 + 12 * (5 + i % 5), 12):
            copy[at], copy[at + 1] = copy[at + 1], copy[at]
        rows += [(i, " ".join(words)), (1000 + i, " ".join(copy))]
    monkeypatch.setattr(simhash.exact_links, "__defaults__", (block,))
    got = simhash.near_groups(documents(rows), shingle=1, distinct=True, bits=2, number=2, similarity=0.8).collect()
    group, texts = {r.doc_id: r.component_id for r in got}, dict(rows)
    similar = {i: jaccard(texts[i], texts[1000 + i]) for i in range(60)}
    assert {s >= 0.8 for s in similar.values()} == {True, False}
    assert {i: group[1000 + i] == group[i] for i in similar} == {i: s >= 0.8 for i, s in similar.items()}


@pytest.mark.parametrize("block", [10**6, 10])
def test_a_component_in_blocks_links_as_whole(spark, documents, block):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(words))]
    for i in range(1, 40):
        # Each differs a little more: neighbours link, the ends don't.
        words[i * 9] = f"x{rng.random()}"
        rows.append((i, " ".join(words)))
    docs = documents(rows)
    nodes = simhash.fingerprints(docs, 1, True, 5).selectExpr("doc_id AS node", "key", "sketch")
    groups = docs.selectExpr("doc_id AS node", "0L AS component")
    edges = simhash.exact_links(docs, nodes, groups, 0.8, 0.65, 5, block).collect()
    texts = dict(rows)
    assert edges and all(jaccard(texts[e.a], texts[e.b]) >= 0.8 for e in edges)
    group = list(range(40))
    for _ in range(40):
        for e in edges:
            group[e.a] = group[e.b] = min(group[e.a], group[e.b])
    assert set(group) == {0}
