"""Document quality by co-training a text view and a metadata view.

Each view has a linear classifier. In each round both score every unlabelled row of the table, and the
rows that one is sure of, by a threshold, are taught to the other. In the end each view is calibrated on
held-out labelled rows, and a logistic combination of the calibrated views scores all documents.

A fit takes a bounded sample of labelled rows, given or taught, of either class (``per_class``, by hash);
scores, sure rows and results cover all rows and their whole texts.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from gneiss.llm.common import stored
from gneiss.llm.linear import Logistic, labelled_sample, newton, sigmoid, trained

#: Rows of either class that a fit takes at most: so many given ones, and so many taught ones for each view.
PER_CLASS = 2500
ROUNDS = 3
#: A pseudo-label needs this probability.
SURE = 0.95
CACHED = 500_000
#: Tasks between the partitions and the one that has the least hashes of a view and label.
SPREAD = 64
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def word_kind(word: str) -> str:
    """Case, and the marks before and after the word."""
    core = word.strip(MARKS)
    if not core:
        return "." + "".join(sorted(set(word)))[:4]
    at = word.find(core)
    case = "d" if core.isdigit() else "u" if core.isupper() and len(core) > 1 else "t" if core[0].isupper() else "l"
    return case + "".join(sorted(set(word[:at])))[:4] + "|" + "".join(sorted(set(word[at + len(core) :])))[:4]


def _steps(name: str, share: float) -> list[str]:
    """Cumulative steps of a share: one for each power of two that it reaches."""
    return [f"{name}>={k}" for k in range(0, 9) if share >= 2.0**-k]


def text_view(text: str | None, kinds: dict[str, str]) -> list[str]:
    """Shares of word kinds, repetition of words and lines, and lengths."""
    text = text or ""
    words = text.split()
    counts, shares = Counter(words), Counter()
    for word, n in counts.items():
        kind = kinds.get(word)
        if kind is None:
            if len(kinds) >= CACHED:
                kinds.clear()
            kind = kinds[word] = word_kind(word)
        shares[kind] += n
    n = max(1, len(words))
    lines = text.split("\n")
    found = [s for kind, c in shares.items() for s in _steps(kind, c / n)]
    found += _steps("distinct", len(counts) / n) + _steps("lines", len(set(lines)) / len(lines))
    found += _steps("top", max(counts.values(), default=0) / n)
    found.append(f"length:{int(math.log2(n))}:{int(math.log2(max(1, round(len(text) / n))))}")
    found.append(f"long:{int(math.log2(n))}:{int(4 * math.log2(max(1, n / max(1, len(counts)))))}")
    return found


def metadata_view(source: str | None, lang: str | None, n_chars: int | None) -> list[str]:
    """Source, language and the stated length, which may be null."""
    size = "none" if n_chars is None else str(int(2 * math.log2(max(1, n_chars))))
    return [f"source:{source}", f"lang:{lang}", f"size:{size}", f"source:{source}:{lang}"]


def numbers(names: list[str]) -> list[int]:
    return sorted({xxhash.xxh3_64_intdigest(x.encode()) >> 1 for x in names})


@dataclass
class Views:
    """Both classifiers, the slope and intercept that calibrate each, and the weights of their calibrated log-odds."""

    text: Logistic
    metadata: Logistic
    a: float = 1.0
    b: float = 0.0
    c: float = 0.0
    text_scale: tuple[float, float] = (1.0, 0.0)
    metadata_scale: tuple[float, float] = (1.0, 0.0)

    def to_json(self) -> str:
        return json.dumps([self.text.to_list(), self.metadata.to_list(), self.a, self.b, self.c, self.text_scale, self.metadata_scale])

    @classmethod
    def from_json(cls, text: str) -> "Views":
        words, metadata, a, b, c, text_scale, metadata_scale = json.loads(text)
        return cls(Logistic.from_list(words), Logistic.from_list(metadata), a, b, c, tuple(text_scale), tuple(metadata_scale))

    def odds(self, text: list[int], metadata: list[int]) -> tuple[float, float]:
        """The calibrated log-odds of either view."""
        (a, b), (c, d) = self.text_scale, self.metadata_scale
        return a * self.text.score(text) + b, c * self.metadata.score(metadata) + d

    def predict(self, text: list[int], metadata: list[int]) -> tuple[float, float, float]:
        t, m = self.odds(text, metadata)
        return float(sigmoid(t)), float(sigmoid(m)), float(sigmoid(self.a * t + self.b * m + self.c))

    def sure(self, text: list[int], metadata: list[int]) -> tuple[int | None, int | None]:
        """The labels that a row teaches the text view and the metadata view, each from the other one."""

        def label(odds: float) -> int | None:
            p = float(sigmoid(odds))
            return 1 if p >= SURE else 0 if p <= 1 - SURE else None

        return label(self.metadata.score(metadata)), label(self.text.score(text))


#: A labelled row: text features, metadata features and label.
Row = tuple[list[int], list[int], int]


def fit_views(labelled: list[Row], taught: tuple[list, list]) -> Views:
    """Classifiers from the labelled rows but each fourth, which is held out, and (features, label) taught to each view.

    The held-out rows calibrate each view, and then weigh the calibrated views.
    """
    train, held = [r for i, r in enumerate(labelled) if i % 4], [r for i, r in enumerate(labelled) if i % 4 == 0]
    told = [[(r[v], r[2]) for r in train] + list(taught[v]) for v in (0, 1)]
    out = Views(*(Logistic.fit([np.array(x, np.int64) for x, _ in rows], np.array([y for _, y in rows])) for rows in told))
    y = np.array([r[2] for r in held], float)
    if len(y) and y.min() < y.max():

        def fitted(*columns: list[float]) -> list[float]:
            z = np.column_stack([*columns, np.ones(len(y))])
            return newton(lambda w: z @ w, lambda r: z.T @ r, y, z.shape[1], np.array([0.1] * len(columns) + [1e-6])).tolist()

        # A view that tells nothing, or the wrong way round, on held-out rows gets a slope of zero at least.
        scores = [out.text.score(r[0]) for r in held], [out.metadata.score(r[1]) for r in held]
        scales = [fitted(column) for column in scores]
        out.text_scale, out.metadata_scale = ((max(a, 0.0), b) for a, b in scales)
        odds = [out.odds(r[0], r[1]) for r in held]
        out.a, out.b, out.c = fitted([t for t, _ in odds], [m for _, m in odds])
    return out


def co_train(labelled: list[Row], pool: list[tuple[list[int], list[int]]], rounds: int = ROUNDS, per_class: int = PER_CLASS) -> Views:
    """What :func:`train` does, for rows in memory; of more sure rows of a class than a fit takes, the first."""
    views = fit_views(labelled, ([], []))
    for _ in range(rounds):
        sure = [views.sure(*row) for row in pool]
        taught = tuple([(pool[i][v], y) for y in (0, 1) for i in [i for i, labels in enumerate(sure) if labels[v] == y][:per_class]] for v in (0, 1))
        if not taught[0] and not taught[1]:
            break
        views = fit_views(labelled, taught)
    return views


FEATURES = "doc_id long, text_features array<long>, metadata_features array<long>"


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and the feature numbers of both views, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[str, str] = {}
        for batch in batches:
            text = [numbers(text_view(t.as_py(), kinds)) for t in batch.column("text")]
            metadata = [numbers(metadata_view(s.as_py(), lang.as_py(), n.as_py())) for s, lang, n in zip(*(batch.column(c) for c in ("source", "lang", "n_chars")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.list_(pa.int64())), pa.array(metadata, pa.list_(pa.int64()))],
                                             ["doc_id", "text_features", "metadata_features"])

    columns = [F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars")]
    return docs.select(*columns).mapInArrow(run, FEATURES)


def taught_rows(unlabelled: DataFrame, views: Views, per_class: int) -> DataFrame:
    """(view, label, features) of the rows that either view is sure of: for each view and label ``per_class`` at most, by hash.

    Every row is scored. The least hashes of each partition move, first to one of ``SPREAD`` tasks for each view and
    label and then to one, so no task gets more than it can hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(v, y, both[v], xxhash.xxh64_intdigest(str(doc_id)) >> 1)
                    for doc_id, *both in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_features", "metadata_features")))
                    for v, y in enumerate(views.sure(*both)) if y is not None]
            types = {"view": pa.int32(), "label": pa.int32(), "features": pa.list_(pa.int64()), "order": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types.values())], list(types))

    sure = unlabelled.mapInArrow(run, "view int, label int, features array<long>, order long")
    sure = sure.withColumn("task", F.spark_partition_id() % SPREAD)
    for keys in (["view", "label", "task"], ["view", "label"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("order", "features"))
        sure = sure.withColumn("place", place).where(F.col("place") <= per_class).drop("place")
    return sure.drop("task")


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, rounds: int = ROUNDS) -> Views:
    """Co-train on the labelled sample and on all rows without a label of quality.

    Of repeated labelled ids the row with the least features counts. Fits run in one task on a bounded number of rows;
    the driver gets the weights.
    """
    features = stored(with_features(docs), "quality_features")
    sample = labelled_sample(labels, "quality", per_class)
    # The sample is bounded, so the features stay where they are.
    row = F.min(F.struct("label", "text_features", "metadata_features")).alias("row")
    labelled = features.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(row)
    labelled = labelled.select(F.lit(-1).alias("view"), F.col("row.label").cast("int").alias("label"), "row.text_features", "row.metadata_features",
                               F.xxhash64("doc_id").alias("order"))
    labelled = stored(labelled, "labelled")
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    # Rows without an id are apart, so that they aren't one key of the join.
    named = features.where("doc_id IS NOT NULL").join(known, "doc_id", "left_anti")
    unlabelled = stored(named.unionByName(features.where("doc_id IS NULL")), "unlabelled")

    def fit(table: pa.Table) -> str:
        got = sorted(table.to_pylist(), key=lambda r: (r["order"], r["text_features"] or [], r["metadata_features"] or []))
        taught = tuple([(r[name], r["label"]) for r in got if r["view"] == v] for v, name in enumerate(("text_features", "metadata_features")))
        return fit_views([(r["text_features"], r["metadata_features"], r["label"]) for r in got if r["view"] < 0], taught).to_json()

    views = Views.from_json(trained(labelled, fit))
    for _ in range(rounds):
        taught = stored(taught_rows(unlabelled, views, per_class), "taught")
        if taught.isEmpty():
            break
        own = [F.when(F.col("view") == v, F.col("features")).alias(name) for v, name in enumerate(("text_features", "metadata_features"))]
        views = Views.from_json(trained(labelled.unionByName(taught.select("view", "label", *own, "order")), fit))
    return views


def score_quality(docs: DataFrame, views: Views, threshold: float = 0.5) -> DataFrame:
    """Per document row: doc_id, text_score, metadata_score, quality and keep.

    A null or empty text has the features of a text without words; null metadata are values
    of their own. Null ids and repeated rows are scored like others; an empty table gives no rows.
    """
    schema = "doc_id long, text_score double, metadata_score double, quality double, keep boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[str, str] = {}
        for batch in batches:
            out = [views.predict(numbers(text_view(t.as_py(), kinds)), numbers(metadata_view(s.as_py(), lang.as_py(), n.as_py())))
                   for t, s, lang, n in zip(*(batch.column(c) for c in ("text", "source", "lang", "n_chars")))]
            columns = [pa.array([p[i] for p in out], pa.float64()) for i in range(3)]
            keep = pa.array([p[2] >= threshold for p in out], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, keep], ["doc_id", "text_score", "metadata_score", "quality", "keep"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars")).mapInArrow(run, schema)
