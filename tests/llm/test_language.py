"""The models equal a plain Kneser-Ney model, and held-out documents get their language."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gneiss.llm import language

SPEECH = {"en": "the and ing her hat his tha ere for ent", "de": "der die und sch ein ich nde den che gen", "fr": "les ent que une ais est des our ait ion"}


def text(rng, lang, words):
    return " ".join("".join(rng.choices(SPEECH[lang].split(), k=rng.randint(1, 4))).title() + rng.choice(["", "", ",", ".", " 7"]) for _ in range(words))


@pytest.fixture
def corpus(documents):
    rng = random.Random(13)
    rows = [(i, text(rng, lang, rng.randint(1, 40)), lang) for i in range(240) for lang in [rng.choice(list(SPEECH))]]
    return rows, documents(rows)


def spread(word):
    """The signs of a text as the models read it."""
    out = "".join(c.lower() if c.isalpha() else " " for c in word)
    return "   " + " ".join(out.split()) + " " if out.strip() else ""


def plain(texts):
    """p(letter | up to three letters before it) of a plain interpolated Kneser-Ney model."""
    grams = Counter(s[i - 3:i + 1] for s in map(spread, texts) for i in range(3, len(s)))
    orders = {4: grams}
    for n in (3, 2, 1):
        orders[n] = Counter(g[1:] for g in orders[n + 1])
    discount, total, kinds = {}, defaultdict(int), defaultdict(int)
    for n, table in orders.items():
        ones, twos = (sum(c == k for c in table.values()) for k in (1, 2))
        discount[n] = (ones + 0.5) / (ones + 2 * twos + 1)
        for g, c in table.items():
            total[n, g[:-1]] += c
            kinds[n, g[:-1]] += 1

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / 65536
        if not total[n, gram[:-1]]:
            return p(gram[1:])
        c = orders[n][gram]
        return (max(c - discount[n], 0) + discount[n] * kinds[n, gram[:-1]] * p(gram[1:])) / total[n, gram[:-1]]

    return p


@pytest.mark.parametrize("pass_entries", [10**6, 700])
def test_cross_entropy_equals_a_plain_model(corpus, pass_entries):
    source, docs = corpus
    learn = language.remainder().isin(0, 1)
    got = language.identify(docs, learn, language.remainder() == 3, pass_entries=pass_entries).collect()
    part = {lang: [t for i, t, x in source if x == lang and zlib.crc32(str(i).encode()) % 4 < 2] for lang in SPEECH}
    models = {lang: plain(t) for lang, t in part.items()}
    of = {i: t for i, t, _ in source}
    for r in got:
        s = spread(of[r.doc_id])
        if not s:
            assert r.lang_pred == "und"
            continue
        own = {lang: -sum(math.log(p(s[i - 3:i + 1])) for i in range(3, len(s))) / (len(s) - 3) for lang, p in models.items()}
        assert r.lang_pred == min(own, key=own.get) and r.cross_entropy == pytest.approx(own[r.lang_pred], rel=1e-5)


def test_held_out_accuracy_and_calibration(corpus):
    source, docs = corpus
    rows = docs.where(language.remainder() != 2).union(docs.where(language.remainder() == 2).withColumn("lang", F.lit("en")))
    got = {r.doc_id: r for r in language.identify(rows, language.remainder().isin(0, 1), language.remainder() == 3).collect()}
    held = [(got[i].lang_pred, x) for i, _, x in source if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values()) and np.mean([r.score for r in got.values()]) > 0.8


def test_odd_rows(odd, documents, rows):
    clashing = odd.withColumnsRenamed({"source": "gram"}).withColumn("n", F.lit(1)).withColumn("sums", F.lit("x"))
    got = rows(language.identify(clashing, F.lit(True), F.lit(True)), "doc_id", "lang_pred", "score")
    assert [r[1] for r in got if r[0] in (1, 2, 3)] == ["und"] * 3 and all(r[2] == 0 for r in got if r[1] == "und")
    assert [r[1] for r in got if r[0] in (4, 5, 6, 7, 8)] == ["en"] * 6 and len(got) == 11
    assert language.identify(odd.limit(0), F.lit(True), F.lit(True)).count() == 0
    nothing = language.identify(odd, F.lit(False), F.lit(True)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    tied = documents([(1, "abc", "b"), (2, "abc", "a"), (3, "abc", None), (4, "𐐀𐐨", "c"), (5, "İß1", "c")])
    found = dict(rows(language.identify(tied, F.lit(True), F.lit(True)), "doc_id", "lang_pred"))
    assert found == {1: "a", 2: "a", 3: "a", 4: "c", 5: "c"}


def test_shares_never_fall():
    right, total = np.array([1, 9, 2, 8, 10.0]), np.array([10, 10, 10, 10, 10.0])
    shares = language.rising(right, total)
    assert language.rising(np.zeros(3), np.zeros(3)).tolist() == [0.5] * 3
    assert (np.diff(shares) >= 0).all() and shares[1] == shares[2] == pytest.approx(11.5 / 21)
