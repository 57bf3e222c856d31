"""Logistic regression on sparse binary features, trained on bounded samples of labelled rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Features kept by a model: those that say most about the label.
WIDTH = 2048


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def newton(product, transposed, y: np.ndarray, width: int, penalty: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Weights of a penalised logistic regression, by Newton steps with conjugate gradients."""
    w = np.zeros(width)
    for _ in range(rounds):
        p = sigmoid(product(w))
        gradient = transposed(p - y) + penalty * w
        if np.abs(gradient).max(initial=0) < 1e-4 * max(1, len(y)) ** 0.5:
            break
        curve = np.maximum(p * (1 - p), 1e-6)
        step, rest = np.zeros(width), gradient.copy()
        direction, size = rest.copy(), rest @ rest
        for _ in range(20):
            across = transposed(curve * product(direction)) + penalty * direction
            alpha = size / max(direction @ across, 1e-12)
            step += alpha * direction
            rest -= alpha * across
            before, size = size, rest @ rest
            if size < 1e-8 * (gradient @ gradient):
                break
            direction = rest + size / before * direction
        w -= step
    return w


@dataclass
class Logistic:
    """A weight for each kept feature, further weights for dense inputs, and an intercept."""

    weights: dict[int, float] = field(default_factory=dict)
    dense: tuple[float, ...] = ()
    intercept: float = 0.0

    @classmethod
    def fit(cls, rows: list[np.ndarray], y: np.ndarray, dense: np.ndarray | None = None, ridge: float = 1.0) -> "Logistic":
        """``rows`` are distinct feature numbers of each row. One class alone gives a constant model."""
        y = np.asarray(y, float)
        extra = np.zeros((len(rows), 0)) if dense is None else np.asarray(dense, float)
        if len(y) == 0 or y.min() == y.max():
            constant = float(logit((y.sum() + 0.5) / (len(y) + 1)))
            return cls({}, (0.0,) * extra.shape[1], constant)
        of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        values, column = np.unique(np.concatenate(rows) if of.size else np.empty(0, np.int64), return_inverse=True)
        hits = np.bincount(column, minlength=len(values))
        hits_1 = np.bincount(column, weights=y[of], minlength=len(values))
        # The features whose share of positive rows is furthest from that of all rows, by chi-square.
        share = y.mean()
        told = (hits_1 - hits * share) ** 2 / np.maximum(hits * share * (1 - share) * (1 - hits / len(y)), 1e-9)
        kept = np.sort(np.argsort(-told * (hits >= 3), kind="stable")[:WIDTH])
        place = np.full(len(values), -1)
        place[kept] = np.arange(len(kept))
        inside = place[column] >= 0
        row, col, n = of[inside], place[column][inside], len(kept)

        def product(w: np.ndarray) -> np.ndarray:
            return np.bincount(row, weights=w[col], minlength=len(y)) + extra @ w[n:-1] + w[-1]

        def transposed(r: np.ndarray) -> np.ndarray:
            return np.concatenate([np.bincount(col, weights=r[row], minlength=n), extra.T @ r, [r.sum()]])

        width = n + extra.shape[1] + 1
        penalty = np.full(width, float(ridge))
        penalty[-1] = 1e-6
        w = newton(product, transposed, y, width, penalty)
        return cls(dict(zip(values[kept].tolist(), w[:n].tolist())), tuple(w[n:-1].tolist()), float(w[-1]))

    def to_list(self) -> list:
        return [[list(x) for x in self.weights.items()], list(self.dense), self.intercept]

    @classmethod
    def from_list(cls, row: list) -> "Logistic":
        return cls({int(f): w for f, w in row[0]}, tuple(row[1]), row[2])

    def score(self, features, dense=()) -> float:
        """The log-odds of a row."""
        get = self.weights.get
        return self.intercept + sum(get(f, 0.0) for f in features) + sum(a * b for a, b in zip(self.dense, dense))


def pruned(rows: list[np.ndarray], least: int = 3) -> list[np.ndarray]:
    """The rows without features that fewer than ``least`` of them have; most words occur in one text only."""
    if not rows:
        return rows
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate(rows)
    values, counts = np.unique(flat, return_counts=True)
    often = values[counts >= least]
    at = np.searchsorted(often, flat)
    stays = at < len(often)
    stays[stays] = often[at[stays]] == flat[stays]
    return [flat[a:b][stays[a:b]] for a, b in zip(np.concatenate([[0], np.cumsum(lengths)[:-1]]), np.cumsum(lengths))]


def trained(rows: DataFrame, fit) -> str:
    """``fit(table)`` of the bounded ``rows`` in one task; the driver gets its result, a text."""

    def run(table: pa.Table) -> pa.Table:
        return pa.table({"model": [fit(table.drop_columns(["one"]))]})

    found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(run, "model string").collect()
    return found[0].model if found else fit(rows.limit(0).toArrow())


def labelled_sample(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id and label of at most ``per_class`` rows of either class, by the hash of the id.

    Labels that are neither 0 nor 1 and null ids are left out; of several labels of an id the largest counts.
    """
    clean = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
    order = F.md5(F.col("doc_id").cast("string"))
    picks = [clean.where(F.col("label") == c).orderBy(order).limit(per_class) for c in (0, 1)]
    return picks[0].union(picks[1])
