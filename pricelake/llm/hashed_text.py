"""Hashed text features of whole texts and linear models over them, inside tasks.

A text's features are the distinct hashed words it holds, lower-cased and without
punctuation around them, beginnings of words, unusual signs that words end on, and
hashed marks of its shape: levels of its length, of its share of distinct words,
capitals, digits and signs, and of how long its words are. Models read which features a
text has, not how often.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import pricelake.llm.common  # noqa: F401  (ships these functions to tasks)
from pricelake.llm.shingles import binary

BUCKETS = 1 << 18
TRAIN_ROWS = 10_000  # labelled rows that a model is fitted on at most
FEATURES = 6_000  # hashed features that a model keeps at most
LEAST_STRENGTH = 15  # chi-square that a feature needs; chance gives few of 2^18 buckets so much
_CACHE = 50_000
_STEMS = (4, 5, 6, 7)  # bytes of the beginning of a word that make features of their own
_USUAL_ENDS = (b".", b",", b";", b":", b"?", b")")
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"


def bucket(kind: bytes, value: bytes) -> int:
    return xxhash.xxh3_64_intdigest(kind + value) % BUCKETS


class Buckets(dict):
    """Buckets of each word, kept for the most recent ones."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= _CACHE:
            self.clear()
        bare = word.lower().strip(_SIGNS)
        end = word[len(word.rstrip(_SIGNS)) :]
        value = [bucket(b"word ", bare or word)]
        value += [bucket(b"stem ", bare[:n]) for n in _STEMS if len(bare) > n]
        if end and end not in _USUAL_ENDS:
            value.append(bucket(b"end ", end[:3]))
        self[word] = value = tuple(value)
        return value


def _level(share: float) -> int:
    """Coarse logarithmic level of a share or count."""
    return int(np.floor(2 * np.log2(share + 1e-4)))


def _shape(text: bytes, words: list[bytes], distinct: int) -> list[int]:
    n, w = max(1, len(text)), max(1, len(words))
    marks = {
        "length": _level(len(text)),
        "words": _level(len(words)),
        "distinct": int(20 * distinct / w),
        "capitals": int(20 * (n - len(text.translate(None, _CAPITALS))) / n),
        "digits": int(20 * (n - len(text.translate(None, _DIGITS))) / n),
        "signs": int(25 * (n - len(text.translate(None, _SIGNS))) / n),
        "word length": int((n - w) / w),
    }
    return [bucket(b"shape ", f"{k} {v}".encode()) for k, v in marks.items()]


def features(text: bytes, cache: Buckets) -> np.ndarray:
    """Sorted distinct buckets of a text; none without words."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int32)
    distinct = set(words)
    own = list(chain.from_iterable(map(cache.__getitem__, distinct)))
    own += _shape(text, words, len(distinct))
    return np.unique(np.array(own, np.int32))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, the text, by its buckets (packed 32-bit numbers)."""
    cache = Buckets()
    for batch in batches:
        packed = [
            features(t, cache).tobytes() for t in binary(batch.column(batch.num_columns - 1))
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(packed, pa.binary())],
            names=[*batch.schema.names[:-1], "buckets"],
        )


def training_rows(docs: DataFrame, labels: DataFrame, columns: list[str], rows: int = TRAIN_ROWS):
    """Buckets and labels of at most ``rows`` labelled documents, chosen by a hash of doc_id.

    Only whole label rows count (no NULL among ``columns``). Where a doc_id has several
    texts or label rows, each pair is a row; if that makes more than ``rows``, those first
    by the hashes of doc_id and text count, in whatever order tasks end.
    """
    names = [f"label_{i}" for i in range(len(columns))]
    some = (
        labels.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            *(F.col(c).cast("int").alias(n) for c, n in zip(columns, names, strict=True)),
        )
        .dropna()
        .orderBy(F.xxhash64("doc_id"), "doc_id", *names)
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the sample is bounded by ``rows``, so it may be broadcast
    found = texts.join(F.broadcast(some), "doc_id").select("doc_id", *names, "text")
    got = (
        found.mapInArrow(_feature_rows, found.drop("text").schema.simpleString()[7:-1] + ",buckets:binary")
        .orderBy(F.xxhash64("doc_id"), "doc_id", *names, F.xxhash64("buckets"), "buckets")
        .limit(rows)
        .toArrow()
    )
    y = np.stack([got.column(n).to_numpy() for n in names], 1).astype(np.int64)
    sets = [np.frombuffer(b.as_buffer(), np.int32) for b in got.column("buckets")]
    # an order that has nothing to do with where the rows lie
    keys = [xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets]
    order = sorted(range(len(sets)), key=lambda i: (keys[i], y[i].tolist()))
    return [sets[i] for i in order], y[order].reshape(len(sets), len(columns))


class Matrix:
    """Rows of features as flat numbers; products with weights are sums by row."""

    def __init__(self, sets: list[np.ndarray], size: int) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.flat = np.concatenate(sets) if sets else np.zeros(0, np.int32)
        self.row = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        self.size = size

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.flat], len(self.sizes))

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.flat, errors[self.row], self.size)


def chosen_features(sets: list[np.ndarray], target: np.ndarray, keep: int = FEATURES) -> np.ndarray:
    """The buckets most associated with the target (by chi-square of presence)."""
    n = max(1, len(sets))
    centred = target - target.mean() if len(target) else target
    have, with_target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at in range(0, len(sets), 1000):  # in parts, to bound what the driver holds
        part = sets[at : at + 1000]
        flat = np.concatenate(part)
        weight = np.repeat(centred[at : at + 1000], [len(s) for s in part])
        have += np.bincount(flat, minlength=BUCKETS)
        with_target += np.bincount(flat, weight, BUCKETS)
    spread = have * (1 - have / n) * max(float((centred**2).mean()) if len(target) else 0, 1e-12)
    strength = np.where(have >= 3, with_target**2 / np.maximum(spread, 1e-9), 0)
    best = np.argsort(-strength, kind="stable")[:keep]
    return np.sort(best[strength[best] > LEAST_STRENGTH])


def narrowed(sets: list[np.ndarray], kept: np.ndarray) -> list[np.ndarray]:
    """Places in ``kept`` of the buckets of each row that it holds."""
    place = np.full(BUCKETS, -1, np.int32)
    place[kept] = np.arange(len(kept))
    out = []
    for s in sets:
        p = place[s]
        out.append(p[p >= 0])
    return out


def minimise(loss: Callable, x: np.ndarray, rounds: int = 100, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; ``loss`` gives value and gradient."""
    value, grad = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q = grad.copy()
        parts = []
        for s, y in reversed(steps):
            a = (s @ q) / (y @ s)
            q -= a * y
            parts.append(a)
        if steps:
            s, y = steps[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(parts), strict=True):
            q += s * (a - (y @ q) / (y @ s))
        slope = -(grad @ q)
        if slope > -1e-10:
            break
        step = 1.0 if steps else min(1.0, 1 / max(1e-9, np.abs(grad).max()))
        for _ in range(30):
            new, new_grad = loss(x - step * q)
            if new <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = -step * q, new_grad - grad
        x = x + s
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        done = abs(value - new) <= 1e-7 * max(1.0, abs(value))
        value, grad = new, new_grad
        if done:
            break
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def scored(docs: DataFrame, score_of: Callable, schema: str) -> DataFrame:
    """doc_id and the columns that ``score_of()`` gives for the feature sets of a batch."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    names = ["doc_id", *(c.split()[0] for c in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, score = Buckets(), score_of()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                columns = score([features(t, cache) for t in binary(part.column(1))])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c) for c in columns)], names=names
                )

    return rows.mapInArrow(run, f"doc_id long, {schema}")


def filtered(docs: DataFrame, keep_of: Callable) -> DataFrame:
    """The rows of ``docs``, unchanged, whose feature sets ``keep_of()`` marks with True."""
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, keep = Buckets(), keep_of()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                mask = keep([features(t, cache) for t in binary(part.column(column))])
                yield part.filter(pa.array(mask))

    return docs.mapInArrow(run, docs.schema)
