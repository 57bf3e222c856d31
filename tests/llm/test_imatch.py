"""Edited texts and the order of documents by hand; fingerprints by their properties and against plain Python."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from gneiss.llm import imatch


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    common, rare = [f"c{i}" for i in range(5)], [f"r{i}" for i in range(400)]
    return [(i * 3, " ".join(rng.choices(common, k=20) + rng.choices(rare, k=rng.randint(0, 40)))) for i in range(80)]


def test_edited_texts_follow_descending_ids(documents, texts):
    rows = [*texts, (1000, "é中" * 51), (1001, "x"), (1002, "")]
    got = {r.doc_id: r for r in imatch.edit_likeness(documents(rows)).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, text) in enumerate(order):
        other, half = order[(k + 1) % len(order)][1], len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if edited == text:
            assert got[i].fingerprint == got[i].edited_fingerprint and got[i].near_edited == 1
    means = [sum(getattr(r, c) for r in got.values()) / len(got) for c in ("near_edited", "near_next")]
    assert means[0] > means[1]


def test_lexicon_is_the_band(documents, texts):
    docs = documents(texts)
    band = (math.log(1 / 0.2), math.log(1 / 0.03))
    frequency = {}
    for _, text in texts:
        for word in set(re.split(r"[^\w]+", text.lower())):
            frequency[word] = frequency.get(word, 0) + 1
    want = {w for w, n in frequency.items() if band[0] <= math.log(len(texts) / n) + 1e-9 and math.log(len(texts) / n) <= band[1] + 1e-9}
    assert imatch.lexicon(docs, band).count() == len(want) > 10
    # A subset's hash depends on the band's terms alone: common words and the order don't matter.
    found = {r.doc_id: r.signature for r in imatch.fingerprints(
        documents([*texts, (901, texts[7][1] + " c0 c1"), (902, " ".join(reversed(texts[7][1].split())))]), band).collect()}
    assert found[901] == found[902] == found[texts[7][0]]


def test_equal_texts_ties_nulls_and_repeated_rows(odd):
    rows = imatch.edit_likeness(odd.selectExpr("*", "1 AS key", "2 AS term", "3 AS signature")).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[5].fingerprint == by_id[6].fingerprint and by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint
    assert by_id[1].n_chars == 0 and by_id[6].near_next == 1
    assert imatch.edit_likeness(odd.limit(0)).count() == 0
    one = imatch.edit_likeness(odd.filter("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1


@pytest.mark.parametrize("ids", [range(40), [None, None, 5, 5, 5, 9, 10**15], [7] * 12, [None] * 6, [-(2**62), 2**62, 0]])
def test_next_rows(spark, ids):
    rows = spark.createDataFrame([(i, f"t{n}", n) for n, i in enumerate(ids)], "doc_id BIGINT, text STRING, key BIGINT").repartition(3)
    got = {r.key: r.next_key for r in imatch.with_next(rows, "key").collect()}
    order = [n for _, n in sorted(enumerate(ids), key=lambda x: 0)] and sorted(range(len(ids)), key=lambda n: (ids[n] is None, -(ids[n] or 0), n))
    assert got == {n: order[(k + 1) % len(order)] for k, n in enumerate(order)}


def by_hand(rows, band):
    """Signatures of the texts in plain Python, with Spark's hash of a term for each subset."""
    import xxhash

    def spark_hash(value, seed):
        """xxhash64 of a long, as Spark takes it: the hash of its eight bytes."""
        return xxhash.xxh64_intdigest((value % 2**64).to_bytes(8, "little"), seed)

    terms = {i: {xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split(r"[^\w]+", text.lower()) if w} for i, text in rows}
    n = {}
    for found in terms.values():
        for t in found:
            n[t] = n.get(t, 0) + 1
    inside = {t for t, c in n.items() if round(band[0], 9) <= round(math.log(len(rows) / c), 9) <= round(band[1], 9)}

    def subset(t, i):
        seed = spark_hash(t, 42)
        return xxhash.xxh64_intdigest(i.to_bytes(4, "little"), seed)

    out = {}
    for i, found in terms.items():
        row = []
        for k, bits in enumerate(imatch.SUBSETS):
            picked = [subset(t, k) for t in found & inside if subset(t, k) % 2**bits == 0]
            if k == 0 and not picked:
                picked = [subset(t, 0) for t in found]
            total = 0
            for h in picked:
                total ^= h
            row.append((total - 2**64 if total >= 2**63 else total) if picked else None)
        out[i] = row
    return out


@pytest.mark.parametrize("limit", [imatch.BROADCAST_TERMS, 0])
def test_signatures_equal_plain_python(documents, texts, monkeypatch, limit):
    """With a lexicon that is broadcast, and with one that is joined by a shuffle."""
    monkeypatch.setattr(imatch, "BROADCAST_TERMS", limit)
    band = (math.log(1 / 0.2), math.log(1 / 0.03))
    rows = [*texts, (1000, "c0 c1"), (1001, "")]
    want = by_hand(rows, band)
    got = {r.doc_id: r.signature for r in imatch.fingerprints(documents(rows), band).collect()}
    assert got == want


def test_likeness_of_edited_texts_equals_plain_python(documents, texts):
    want = by_hand(texts, imatch.BAND)
    got = {r.doc_id: r for r in imatch.edit_likeness(documents(texts)).collect()}
    order = [i for i, _ in sorted(texts, reverse=True)]
    for k, i in enumerate(order):
        a, b = want[i], want[order[(k + 1) % len(order)]]
        told = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
        assert got[i].near_next == pytest.approx(sum(x == y for x, y in told) / len(told) if told else 1)
        assert got[i].fingerprint == "".join("-" * 16 if x is None else f"{x % 2**64:016x}" for x in a)


def test_subsets_are_drawn_apart(spark):
    """Two subsets of a size share as many terms as chance has it: none holds the other."""
    rows = spark.range(20_000).select(F.xxhash64("id").alias("term"))
    two = [i for i, n in enumerate(imatch.SUBSETS) if n == 3][:2]
    hits = [imatch.subset_hash(F.col("term"), i).bitwiseAND(F.lit(7)) == 0 for i in two]
    found = rows.agg(*[F.count_if(h) for h in hits], F.count_if(hits[0] & hits[1])).first()
    assert all(2200 < n < 2800 for n in found[:2]) and 200 < found[2] < 430
