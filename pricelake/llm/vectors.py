"""Vectors of the embeddings table inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import pricelake.llm.common  # noqa: F401  (ships these functions to tasks)


def usable(column: str = "embedding") -> Column:
    """Vectors that have an angle: no NULL, NaN or infinite component, not all zero."""
    finite = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0)


def doubles(df: DataFrame, column: str = "embedding") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("array<double>"))


def matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest component first, so none overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no digit, so that no square overflows."""
    exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]
    return np.ldexp(x, -exponent)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with the same row of ``y``; equal rows give equal values."""
    x, y = _scaled(x), _scaled(y)
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
