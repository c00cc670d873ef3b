"""Ordinal quality by cumulative-link regression (operator 10).

Graded ratings 0 .. G are modelled with one set of hashed-text weights and G ordered
thresholds: P(grade > k) = sigmoid(w x - t_k), t_1 < t_2 < ... A text gets its expected
grade and the tail probability of each grade; it is selected when the probability of
reaching ``reach`` is at least ``least``.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows; every text is scored whole,
where it is read, without an exchange.

Defined results: NULL text is scored as empty. Every row gives one row, also repeated
ones and those without doc_id. Ratings that are NULL are left out. A grade that no
rating has gets a threshold as its neighbours allow; without any rating each tail
probability is one half. Equal probabilities are decided alike; texts of any length are
scored whole. Other columns are ignored, whatever their names; an empty table gives no
rows.
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
    minimise,
    narrowed,
    scored,
    sigmoid,
    training_rows,
)

PENALTY = 1.0
THRESHOLD_PENALTY = 1e-3  # keeps thresholds finite where a grade has no rating
REACH, LEAST = 2, 0.5


@dataclass
class Ordinal:
    kept: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def __post_init__(self) -> None:
        self.table = np.zeros(BUCKETS, np.float32)
        self.table[self.kept] = self.weights

    def tails(self, sets: list[np.ndarray]) -> np.ndarray:
        """P(grade >= k) for k = 1 .. G, one row a grade; never rising with k."""
        margin = np.array([self.table[s].sum(dtype=np.float64) for s in sets])
        return sigmoid(margin[None] - self.thresholds[:, None])


def ordered(raw: np.ndarray) -> np.ndarray:
    """Thresholds from the first one and the logarithms of the gaps."""
    return np.cumsum(np.r_[raw[:1], np.exp(np.clip(raw[1:], -20, 20))])


def fit_ordinal(sets: list[np.ndarray], grades: np.ndarray, top: int) -> Ordinal:
    kept = chosen_features(sets, grades.astype(float), FEATURES)
    x = Matrix(narrowed(sets, kept), len(kept))
    k, n = len(kept), len(sets)
    rows = np.arange(n)

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, raw = p[:k], p[k:]
        t = ordered(raw)
        margin = x.dot(w)
        above = np.ones((n, top + 2))  # P(grade >= g) for g = 0 .. top + 1
        above[:, -1] = 0
        above[:, 1:-1] = sigmoid(margin[:, None] - t[None])
        slope = above * (1 - above)
        share = np.maximum(above[rows, grades] - above[rows, grades + 1], 1e-12)
        by_margin = (slope[rows, grades] - slope[rows, grades + 1]) / share
        by_threshold = np.zeros((n, top + 2))
        by_threshold[rows, grades] -= slope[rows, grades] / share
        by_threshold[rows, grades + 1] += slope[rows, grades + 1] / share
        t_grad = -by_threshold[:, 1:-1].sum(axis=0)
        tail = np.cumsum(t_grad[::-1])[::-1]
        raw_grad = np.r_[tail[:1], tail[1:] * np.exp(np.clip(raw[1:], -20, 20))]
        value = -np.log(share).sum() + 0.5 * PENALTY * (w**2).sum()
        value += 0.5 * THRESHOLD_PENALTY * (raw**2).sum()
        return float(value), np.concatenate(
            [PENALTY * w - x.back(by_margin), raw_grad + THRESHOLD_PENALTY * raw]
        )

    fitted = minimise(loss, np.zeros(k + top), rounds=200)
    return Ordinal(kept, fitted[:k], ordered(fitted[k:]))


def quality_model(docs: DataFrame, ratings: DataFrame, top: int, rows: int = TRAIN_ROWS) -> Ordinal:
    """A model of ``ratings`` (doc_id, grade), grades from 0 to ``top``."""
    sets, y = training_rows(docs, ratings.where(F.col("grade").between(0, top)), ["grade"], rows)
    return fit_ordinal(sets, y[:, 0], top)


def grades(docs: DataFrame, model: Ordinal, reach: int = REACH, least: float = LEAST) -> DataFrame:
    """(doc_id, expected_grade, p_at_least_1 .. p_at_least_G, selected) of each row of ``docs``."""
    shared = sent(docs.sparkSession, model)
    top = len(model.thresholds)

    def score_of() -> Callable:
        own = received(shared)

        def score(sets: list[np.ndarray]) -> list[np.ndarray]:
            tails = own.tails(sets)
            return [tails.sum(axis=0), *tails]

        return score

    tails = ", ".join(f"p_at_least_{k + 1} double" for k in range(top))
    given = scored(docs, score_of, f"expected_grade double, {tails}")
    return given.withColumn("selected", F.col(f"p_at_least_{reach}") >= least)


def graded_ratings(labels: DataFrame) -> DataFrame:
    """Grades of the labels table: 0 low quality, 1 good but toxic, 2 good and clean."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    return labels.select("doc_id", F.when(F.col("quality").isNotNull(), grade).alias("grade"))


TOP_GRADE = 2
