"""Toxicity by a classifier chain (operator 3).

Categories are predicted one after the other, each by a linear model over hashed text
features and the probabilities of the categories before it. While fitting, a row's
earlier probabilities come from models that have not seen it (out of fold), as they
will when other texts are scored; the final model of a category is fitted on all rows.
A category's decision threshold is the one with the best F1 on its out-of-fold
probabilities.

The chain is fitted on at most ``TRAIN_ROWS`` labelled rows; every text is scored whole,
where it is read, without an exchange.

Defined results: text that is NULL or has no words has probability 0 and is not toxic. Every row
gives one row, also repeated ones and those without doc_id. Labels with NULL are left
out; without any labelled text, or where a category has one value only, its probability
is the share of that value (0 without labels), which is decided as false unless it is 1.
Equal probabilities are decided alike; texts of any length are scored whole. Scoring
ignores other columns, filtering passes them unchanged, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import received, sent
from pricelake.llm.hashed_text import (
    BUCKETS,
    FEATURES,
    TRAIN_ROWS,
    Matrix,
    chosen_features,
    filtered,
    minimise,
    narrowed,
    scored,
    sigmoid,
    training_rows,
)

FOLDS = 3
PENALTY = 1.0


@dataclass
class Linear:
    """Logistic model over chosen hashed features and dense columns."""

    kept: np.ndarray
    weights: np.ndarray  # of the kept features, then of the dense columns, then the intercept

    def __post_init__(self) -> None:
        self.table = np.zeros(BUCKETS, np.float32)
        self.table[self.kept] = self.weights[: len(self.kept)]

    def margin(self, sets: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        sparse = np.array([self.table[s].sum(dtype=np.float64) for s in sets])
        rest = self.weights[len(self.kept) :]
        return sparse + dense @ rest[:-1] + rest[-1]

    def probability(self, sets: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(sets, dense))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_linear(sets: list[np.ndarray], dense: np.ndarray, y: np.ndarray) -> Linear:
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        rest = np.zeros(dense.shape[1] + 1)
        rest[-1] = 40.0 if share else -40.0
        return Linear(np.zeros(0, np.int64), rest)
    kept = chosen_features(sets, y, FEATURES)
    x = Matrix(narrowed(sets, kept), len(kept))
    k = len(kept)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        margin = x.dot(w[:k]) + dense @ w[k:-1] + w[-1]
        p = sigmoid(margin)
        value = np.logaddexp(0, margin) - y * margin
        error = p - y
        grad = np.concatenate([x.back(error), dense.T @ error, [error.sum()]])
        grad[:-1] += PENALTY * w[:-1]
        return float(value.sum() + 0.5 * PENALTY * (w[:-1] ** 2).sum()), grad

    start = np.zeros(k + dense.shape[1] + 1)
    start[-1] = np.log(share / (1 - share))
    return Linear(kept, minimise(loss, start))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Probability from which on deciding for the category has the best F1."""
    if not len(y) or y.all() or not y.any():
        return 1.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.r_[np.diff(p[order]) != 0, True]  # equal probabilities are decided alike
    best = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


@dataclass
class Chain:
    models: list[Linear]
    thresholds: list[float]

    def probabilities(self, sets: list[np.ndarray]) -> np.ndarray:
        """One column a category; each model reads the columns before its own."""
        dense = np.zeros((len(sets), 0))
        worded = np.array([len(s) > 0 for s in sets], float)
        columns = []
        for model in self.models:
            columns.append(model.probability(sets, dense) * worded)
            dense = np.column_stack([dense, logit(columns[-1])])
        return np.array(columns).reshape(len(self.models), len(sets))


def fit_chain(sets: list[np.ndarray], labels: np.ndarray, folds: int = FOLDS) -> Chain:
    fold = np.arange(len(sets)) % folds  # rows come in the order of a hash
    earlier = np.zeros((len(sets), 0))
    models, thresholds = [], []
    for category in range(labels.shape[1]):
        y = labels[:, category].astype(float)
        unseen = np.zeros(len(sets))
        for f in range(folds):
            here, there = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            model = fit_linear([sets[i] for i in here], earlier[here], y[here])
            unseen[there] = model.probability([sets[i] for i in there], earlier[there])
        models.append(fit_linear(sets, earlier, y))
        thresholds.append(best_threshold(unseen, y > 0))
        earlier = np.column_stack([earlier, logit(unseen)])
    return Chain(models, thresholds)


def toxicity_chain(docs: DataFrame, labels: DataFrame, categories: list[str], rows: int = TRAIN_ROWS) -> Chain:
    """A chain over the 0/1 columns ``categories`` of ``labels`` (doc_id, ...), in their order."""
    sets, y = training_rows(docs, labels, categories, rows)
    return fit_chain(sets, y)


def scores(docs: DataFrame, chain: Chain, categories: list[str]) -> DataFrame:
    """doc_id, the probability ``p_<category>`` of each, and the decision on the last one."""
    shared = sent(docs.sparkSession, chain)

    def score_of() -> Callable:
        return received(shared).probabilities

    columns = ", ".join(f"p_{c} double" for c in categories)
    given = scored(docs, score_of, columns)
    last = categories[-1]
    return given.withColumn(last, F.col(f"p_{last}") >= chain.thresholds[-1])


def without_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` without the rows that the chain's last category takes in."""
    shared = sent(docs.sparkSession, chain)

    def keep_of() -> Callable:
        own = received(shared)
        return lambda sets: own.probabilities(sets)[-1] < own.thresholds[-1]

    return filtered(docs, keep_of)


def graded_labels(labels: DataFrame) -> DataFrame:
    """The labels table with its grade as 0/1 categories: low_quality, toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


CATEGORIES = ["low_quality", "toxic"]
