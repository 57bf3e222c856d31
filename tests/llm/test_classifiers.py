"""Held-out accuracy of the toxicity chain and of co-training; their parts; odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gneiss.llm import cotraining, linear, toxicity

WORDS = [f"word{i}" for i in range(800)]
BAD = ["vexlor", "vexlina", "grumpf!", "Grumpf", "snarg,"]


def make(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(20, 200))
        toxic, junk = rng.random() < 0.2, rng.random() < 0.2
        if toxic:
            for at in rng.sample(range(len(words)), 3):
                words[at] = rng.choice(BAD)
        if junk:
            words = [w + rng.choice(["***", "&&&"]) for w in words]
        rows.append((seed * 10_000 + i, " ".join(words), "en", f"s{i % 5}"))
        labels.append((seed * 10_000 + i, int(not junk), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def data():
    return make(500, 1), make(300, 2)


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")


def test_toxicity_on_held_out_rows(spark, documents, data):
    (seen, labels), (fresh, truth) = data
    chain = toxicity.train(documents(seen), label_table(spark, labels))
    assert chain.names == ["toxic_prose", "toxic_junk", "toxic"]
    got = {r.doc_id: r.is_toxic for r in toxicity.score(documents(fresh), chain).collect()}
    right = sum(got[i] == bool(t) for i, _, t in truth)
    assert right >= 0.97 * len(truth) and not any(got[i] for i, _, t in truth if not t and i % 2)
    assert toxicity.Chain.from_json(chain.to_json()).predict([1, 2]) == chain.predict([1, 2])


def test_earlier_probabilities_reach_later_models():
    rng = np.random.default_rng(1)
    y = (rng.random(400) < 0.5).astype(int)
    rows = [np.array([1 if v else 2, 10 + int(rng.integers(5))], np.int64) for v in y]
    chain = toxicity.Chain.fit(rows, {"first": y, "second": y})
    assert len(chain.models[0].dense) == 0 and len(chain.models[1].dense) == 1 and chain.models[1].dense[0] > 0
    assert chain.predict([1])[-1] > 0.9 > 0.1 > chain.predict([2])[-1]


def test_toxic_documents_go_and_columns_stay(spark, documents, data, odd):
    (seen, labels), _ = data
    docs = documents(seen).withColumn("p_toxic_prose", F.lit("clash"))
    docs = docs.withColumns({"is_toxic": F.lit(True), "label": F.lit(7), "row": F.lit("r")})
    kept = toxicity.drop_toxic(docs, label_table(spark, labels))
    assert kept.columns == docs.columns
    toxic = {i for i, _, t in labels if t}
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids & toxic) <= 0.05 * len(toxic) and {i for i, _, t in labels if not t} <= ids
    chain = toxicity.train(documents(seen), label_table(spark, labels))
    assert toxicity.score(odd, chain).count() == odd.count() and toxicity.score(odd.limit(0), chain).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, None, None), (None, 0, 1), (2, 5, 7)], [(4, 1, 1), (4, 0, 0), (5, 1, 0)]])
def test_few_odd_or_one_sided_labels(spark, odd, labels):
    table = label_table(spark, labels)
    assert toxicity.drop_toxic(odd, table).count() <= odd.count()
    assert cotraining.score_quality(odd, cotraining.train(odd, table)).count() == odd.count()


def test_quality_on_held_out_rows(spark, documents, data):
    (seen, labels), (fresh, truth) = data
    some = label_table(spark, labels).filter("doc_id % 3 = 0")
    views = cotraining.train(documents(seen), some)
    got = {r.doc_id: r.keep for r in cotraining.score_quality(documents(fresh), views).collect()}
    assert sum(got[i] == bool(q) for i, q, _ in truth) >= 0.97 * len(truth)
    assert cotraining.Views.from_json(views.to_json()).predict([1], [2]) == views.predict([1], [2])


def test_views_teach_each_other():
    """The metadata view learns from the pool what the text view is sure of, though its own labels say nothing."""
    labelled = [([1 + i // 4 % 2], [50], 1 - i // 4 % 2) for i in range(400)]
    pool = [([1 + i % 2], [60 + i % 2]) for i in range(400)]
    alone, taught = (cotraining.co_train(labelled, pool, rounds) for rounds in (0, 3))
    assert alone.metadata.score([60]) == alone.metadata.score([61])
    assert taught.metadata.score([60]) > taught.metadata.score([61]) + 1


def test_odd_metadata(odd):
    clash = odd.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source", "CAST(NULL AS BIGINT) AS n_chars", "1 AS quality")
    assert cotraining.score_quality(clash, cotraining.Views(linear.Logistic(), linear.Logistic())).count() == odd.count()


def test_logistic_regression_separates_and_penalises():
    rows = [np.array([1, 5], np.int64)] * 50 + [np.array([2, 5], np.int64)] * 50
    model = linear.Logistic.fit(rows, np.array([1] * 50 + [0] * 50))
    assert model.score([1]) > 2 and model.score([2]) < -2 and abs(model.weights[5]) < 0.1
    assert linear.Logistic.fit(rows, np.zeros(100)).score([1]) < -4
    assert [len(r) for r in linear.pruned([np.array([1, 2]), np.array([1]), np.array([1, 3])])] == [1, 1, 1]


def test_training_on_spark_equals_rows_in_memory(spark, documents, data):
    """Every row without a label may teach: the models equal those of all rows in plain Python."""
    (seen, labels), _ = data
    docs, some = documents(seen), label_table(spark, labels).filter("doc_id % 5 = 0")
    views = cotraining.train(docs, some, rounds=2)
    rows = {r.doc_id: (r.text_features, r.metadata_features) for r in cotraining.with_features(docs).collect()}
    order = {r.doc_id: r.order for r in some.select("doc_id", F.xxhash64("doc_id").alias("order")).collect()}
    known = {i: q for i, q, _ in labels if i in order}
    labelled = [(*rows[i], known[i]) for i in sorted(known, key=order.get)]
    plain = cotraining.co_train(labelled, [row for i, row in rows.items() if i not in known], rounds=2)
    alone = cotraining.co_train(labelled, [], rounds=2)
    for row in rows.values():
        assert views.predict(*row) == pytest.approx(plain.predict(*row), abs=1e-6)
    # The text view is sure of rows here, and so teaches the metadata view.
    assert any(abs(views.metadata.score(m) - alone.metadata.score(m)) > 1e-3 for _, m in rows.values())


def test_sure_rows_are_bounded_by_hash_only(spark, documents, data):
    (seen, labels), _ = data
    features = cotraining.with_features(documents(seen)).repartition(5)
    views = cotraining.train(documents(seen), label_table(spark, labels), rounds=0)
    every, some = (cotraining.taught_rows(features, views, n).collect() for n in (10**6, 20))
    want = [(v, y) for r in features.collect() for v, y in enumerate(views.sure(r.text_features, r.metadata_features)) if y is not None]
    assert sorted((r.view, r.label) for r in every) == sorted(want) and len(want) > 100
    for key in set(want):
        assert sorted(r.order for r in some if (r.view, r.label) == key) == sorted(r.order for r in every if (r.view, r.label) == key)[:20]


def test_views_are_calibrated():
    """Scores of a view are the shares of good rows among those that it scores so."""
    rng = np.random.default_rng(5)
    labelled = []
    for _ in range(4000):
        y = int(rng.random() < 0.5)
        labelled.append(([1 if rng.random() < (0.8 if y else 0.2) else 2], [3 if rng.random() < (0.7 if y else 0.3) else 4], y))
    views = cotraining.fit_views(labelled, ([([1], 1)] * 500 + [([2], 0)] * 500, []))
    text = [views.predict(t, m)[0] for t, m, _ in labelled]
    for mark in (1, 2):
        chosen = [(p, y) for p, (t, _, y) in zip(text, labelled) if t == [mark]]
        assert abs(np.mean([p for p, _ in chosen]) - np.mean([y for _, y in chosen])) < 0.05


def test_repeated_labelled_ids_with_different_texts(spark, documents, data):
    """Which text of an id teaches doesn't depend on how rows are spread."""
    (seen, labels), _ = data
    again = [(i, f"{text} {'vexlor' if i % 2 else 'word1'}", *rest) for i, text, *rest in seen[:200]]
    table, rows = label_table(spark, labels), [*seen, *again, (seen[0][0], None, "en", "s")]
    chains = {toxicity.train(documents(some).repartition(n), table).to_json() for n, some in ((1, rows), (4, rows[::-1]), (7, rows))}
    assert len(chains) == 1
