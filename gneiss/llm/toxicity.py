"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other. The model of a category sees the words of a text
and the probabilities of the categories before it. While training, these probabilities are
out-of-fold: each row's come from models that haven't seen the row, as will be the case later.

Features are the distinct words of a text, lower-cased and without punctuation around them,
and their beginnings, which words of one stem share. Models are trained on a bounded sample of
labelled rows (``per_class`` of either class); every document is scored, over its whole text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from gneiss.llm.linear import Logistic, labelled_sample, logit, pruned, sigmoid, trained

PER_CLASS = 2500
FOLDS = 5
AROUND = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "\xa0¡¿«»“”„‘’…–—"
#: Words a worker remembers.
CACHED = 500_000


def word_features(word: str) -> tuple[int, ...]:
    """Numbers for a word and its beginnings of three to six letters."""
    word = word.strip(AROUND).lower()
    digest = xxhash.xxh3_64_intdigest
    return tuple({digest(x.encode()) >> 1 for x in (f"={word}", *(f"^{word[:n]}" for n in (3, 4, 5, 6) if len(word) >= n))}) if word else ()


def text_features(text: str | None) -> np.ndarray:
    found: set[int] = set()
    for word in set((text or "").split()):
        found.update(word_features(word))
    return np.fromiter(found, np.int64, len(found))


@dataclass
class Chain:
    """Category names, their models in order, and the threshold of the last one."""

    names: list[str]
    models: list[Logistic]
    threshold: float

    @classmethod
    def fit(cls, rows: list[np.ndarray], targets: dict[str, np.ndarray], folds: int = FOLDS) -> "Chain":
        """One model for each category in the order of ``targets``; the last is the verdict.

        The threshold is where the out-of-fold verdicts have about the best F1.
        """
        names, models, earlier = list(targets), [], np.zeros((len(rows), 0))
        fold = np.arange(len(rows)) % folds
        for name in names:
            y = np.asarray(targets[name], float)
            models.append(Logistic.fit(rows, y, logit(earlier)))
            out = np.zeros(len(rows))
            for f in range(folds):
                test = np.flatnonzero(fold == f)
                train = np.flatnonzero(fold != f)
                model = Logistic.fit([rows[i] for i in train], y[train], logit(earlier[train]))
                out[test] = [sigmoid(model.score(rows[i].tolist(), logit(earlier[i]))) for i in test]
            earlier = np.column_stack([earlier, out])
        return cls(names, models, best_threshold(out, y) if names and len(rows) else 0.5)

    def to_json(self) -> str:
        return json.dumps([self.names, [m.to_list() for m in self.models], self.threshold])

    @classmethod
    def from_json(cls, text: str) -> "Chain":
        names, models, threshold = json.loads(text)
        return cls(names, [Logistic.from_list(m) for m in models], threshold)

    def predict(self, features) -> list[float]:
        """The probability of each category, in order."""
        out: list[float] = []
        for model in self.models:
            out.append(float(sigmoid(model.score(features, [logit(p) for p in out]))))
        return out


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Of the thresholds on a grid with about the best F1 the highest, which spares clean rows; 0.5 if there is only one class."""
    if y.min() == y.max():
        return 0.5
    grid = np.arange(0.05, 0.96, 0.05)
    f1 = np.array([2 * ((p >= t) & (y == 1)).sum() / max(1, (p >= t).sum() + y.sum()) for t in grid])
    return float(grid[f1 >= f1.max() - 0.002][-1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Chain:
    """A chain on the labelled sample: toxic prose, toxic junk (of low quality), toxic.

    Of repeated labelled ids the row with the least hash of its text counts, null texts first. One task trains on the sample, whose rows are bounded by ``per_class``; the driver gets the weights.
    """
    sample = labelled_sample(labels, "toxic", per_class).withColumnRenamed("label", "toxic")
    quality = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marked = quality.join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "toxic", "quality", "order"]).columns, pa.array(found, pa.list_(pa.int64()))],
                ["doc_id", "toxic", "quality", "order", "features"])

    # The sample's size is bounded, so the texts stay where they are.
    texts = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").select(
        F.col("doc_id").cast("long").alias("doc_id"), "toxic", "quality", "text",
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("order"))
    rows = texts.mapInArrow(run, "doc_id long, toxic int, quality int, order long, features array<long>")
    row = F.min(F.struct("order", "features", "toxic", "quality")).alias("row")
    rows = rows.groupBy("doc_id").agg(row).select("doc_id", "row.toxic", "row.quality", "row.features")

    def fit(table: pa.Table) -> str:
        order = sorted(range(len(table)), key=lambda i: xxhash.xxh64_intdigest(str(table.column("doc_id")[i].as_py())))
        table = table.take(pa.array(order, pa.int64()))
        toxic = table.column("toxic").to_numpy().astype(int)
        junk = np.array([q == 0 for q in table.column("quality").to_pylist()], bool)
        found = [f.values.to_numpy() for f in table.column("features")]
        return Chain.fit(pruned(found), {"toxic_prose": toxic * ~junk, "toxic_junk": toxic * junk, "toxic": toxic}).to_json()

    return Chain.from_json(trained(rows, fit))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs`` with ``p_<category>`` for each category and the verdict ``is_toxic``.

    A null or empty text has no features and gets the models' intercepts. Rows, ids and other
    columns stay as they are, repeated rows too; columns of the added names are replaced. An empty
    table gives no rows.
    """
    docs = docs.drop("is_toxic", *[f"p_{n}" for n in chain.names])
    known = set().union(*(m.weights for m in chain.models)) if chain.models else set()
    names = [f"p_{n}" for n in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            out = []
            for text in batch.column("text"):
                found: set[int] = set()
                for word in set((text.as_py() or "").split()):
                    own = memory.get(word)
                    if own is None:
                        if len(memory) >= CACHED:
                            memory.clear()
                        own = memory[word] = tuple(f for f in word_features(word) if f in known)
                    if own:
                        found.update(own)
                out.append(chain.predict(sorted(found)))
            columns = [pa.array([p[i] for p in out], pa.float64()) for i in range(len(names))]
            verdict = pa.array([p[-1] >= chain.threshold for p in out], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, verdict], [*batch.schema.names, *names, "is_toxic"])

    added = [T.StructField(n, T.DoubleType()) for n in names] + [T.StructField("is_toxic", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The documents that the chain doesn't call toxic, with all their columns whatever their names."""
    names = ["text" if c == "text" else f"__{i}" for i, c in enumerate(docs.columns)]
    scored = score(docs.toDF(*names), train(docs, labels, per_class))
    return scored.where(~F.col("is_toxic")).select(*names).toDF(*docs.columns)
