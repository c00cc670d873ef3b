"""Embedding near-duplicates through a pivot-permutation index (operator 1).

Vectors of one label link when their cosine is at least 0.93.

* Equal vectors of a label form a class, counted before anything is shuffled by vector.
* The pivots of a vector length are a bounded sample of its vectors, thinned so that no
  two are closer than ``apart``: a dense group of near copies holds one or a few pivots
  however large it is, so the places of its members in the order of the pivots outside
  it describe them. Each class is described by its ordered nearest pivots (the head of
  its pivot permutation). Vectors of a length that few have are all compared.
* An inverted list holds, for a label and a pivot, the classes that have the pivot in
  their description. Two classes are candidates when they share at least ``shared``
  pivots; the shared pivots of all pairs of a list are counted at once.
* Candidates are verified by cosine in double precision. A pair is settled in the list
  of the first pivot it shares, so it counts once.
* Long lists are cut into blocks, and pairs of blocks are tasks of their own. A task
  returns the number of links of each class and edges that span its linked groups,
  never the pairs: a group of many near copies costs rows in proportion to its size.

Pivots are broadcast, at most MOST_PIVOTS for each length that over WHOLE classes have.
Where a whole length lies within a few such angles it has few pivots, down to one, and
ever more of its pairs are compared: no link is lost, the time is quadratic.

Which candidates the index finds is approximate; ``recall`` of the links against brute
force is measured in the tests. No pair below the threshold is ever linked.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components, and those without label, link with nothing; so do vectors of different
lengths. Every row gives one row, also repeated ones. A NULL vec_id takes part; a
component's id is its least vec_id that is not NULL, and a row without vec_id is never
``kept``. Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import components, saved
from pricelake.llm.vectors import cosines, doubles, matrix, unit, usable

THRESHOLD = 0.93
DESCRIPTION = 8  # nearest pivots that describe a vector
SHARED = 3  # of them two vectors must have in common
PIVOTS_PER_ROOT = 2  # pivots for the square root of the number of vectors
LEAST_PIVOTS, MOST_PIVOTS = 32, 16_384
WHOLE = 128  # classes of one length that are all compared, without pivots
BLOCK = 512
ROUNDING = 1e-9  # more than a product of unit vectors can be off


def apart(threshold: float) -> float:
    """Largest cosine of two pivots: twice the threshold's squared distance."""
    return 2 * threshold - 1


def thinned(points: np.ndarray, most: int, cosine: float) -> np.ndarray:
    """The first ``most`` unit vectors that no earlier one of them is close to."""
    kept = points[:0]
    for at in range(0, len(points), 256):
        some = points[at : at + 256]
        some = some[(some @ kept.T < cosine).all(axis=1)]
        close = some @ some.T >= cosine
        chosen: list[int] = []
        for i in range(len(some)):
            if not close[i, chosen].any():
                chosen.append(i)
        kept = np.concatenate([kept, some[chosen]])
        if len(kept) >= most:
            break
    return kept[:most]


def _describe(pivots, n: int) -> Callable:
    """Adds the ordered numbers of the nearest pivots of the same length; 0 if it has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            described = np.empty(len(batch), object)
            dims = batch.embedding.map(len).to_numpy()
            for dim in np.unique(dims):
                points = pivots.value.get(int(dim))
                rows = np.flatnonzero(dims == dim)
                if points is None:
                    for row in rows:
                        described[row] = np.zeros(1, np.int64)
                    continue
                for at in range(0, len(rows), 4096):
                    some = rows[at : at + 4096]
                    near = unit(matrix(batch.embedding.iloc[some])) @ points.T
                    order = np.argsort(-near, axis=1, kind="stable")[:, :n]
                    for row, chosen in zip(some, order, strict=True):
                        described[row] = chosen
            yield batch.assign(pivots=described)

    return run


def _groups(pairs: np.ndarray, n: int) -> np.ndarray:
    """Least member of the linked group of each of n nodes."""
    root = np.arange(n)
    i, j = np.nonzero(pairs)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verify(threshold: float, shared: int) -> Callable:
    """Links of one pair of blocks of an inverted list."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pivot = key[2]
        i = np.flatnonzero(pdf.side.to_numpy() != 1)
        j = np.flatnonzero(pdf.side.to_numpy() != 0)
        whole = matrix(pdf.embedding)
        vectors = unit(whole)
        numbers, flat = np.unique(np.concatenate(pdf.pivots.to_list()), return_inverse=True)
        member = np.zeros((len(pdf), len(numbers)), np.float32)
        member[np.repeat(np.arange(len(pdf)), pdf.pivots.map(len)), flat] = 1
        common = member[i] @ member[j].T
        # pivots below this one that a pair shares: it is settled in the list of the first
        earlier = member[:, numbers < pivot]
        candidate = (common >= min(shared, pdf.pivots.map(len).min())) & (earlier[i] @ earlier[j].T == 0)
        candidate &= i[:, None] != j[None] if key[3] != key[4] else i[:, None] < j[None]
        product = vectors[i] @ vectors[j].T
        linked = candidate & (product >= threshold)
        # products depend on the block's shape in their last digits: such pairs one by one
        x, y = np.nonzero(candidate & (np.abs(product - threshold) < ROUNDING))
        if len(x):
            linked[x, y] = cosines(whole[i[x]], whole[j[y]]) >= threshold
        near = np.zeros((len(pdf), len(pdf)), bool)
        near[np.ix_(i, j)] = linked
        size = pdf["size"].to_numpy()
        links = near @ size + near.T @ size
        root = _groups(near, len(pdf))
        cid = pdf.cid.to_numpy()
        hit = links > 0
        return pd.DataFrame({"cid": cid[hit], "links": links[hit], "root": cid[root[hit]]})

    return run


def near_duplicates(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    description: int = DESCRIPTION,
    shared: int = SHARED,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``rows`` (vec_id, embedding, label).

    ``rows`` must be a table on disk: it is read twice.
    """
    spark = rows.sparkSession
    rows = doubles(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label"))
    rows = rows.withColumn("linkable", usable() & F.col("label").isNotNull())
    classes = saved(
        rows.where("linkable")
        .groupBy("label", "embedding")
        .agg(F.count("*").alias("size"), F.min("vec_id").alias("least")),
        "classes",
    )
    classes = saved(classes.withColumn("cid", F.monotonically_increasing_id()), "numbered")
    dim = F.size("embedding")
    many = classes.groupBy(dim.alias("dim")).agg(F.count("*").alias("n")).where(F.col("n") > WHOLE)
    points = {}
    for length in many.toLocalIterator():
        wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, PIVOTS_PER_ROOT * math.isqrt(length["n"])))
        drawn = (
            classes.where(dim == length["dim"])
            .select("cid", "embedding")
            .orderBy(F.xxhash64("cid"), "cid")
            .limit(2 * wanted)
        )
        sample = unit(np.array([row["embedding"] for row in drawn.toLocalIterator()]))
        points[length["dim"]] = thinned(sample, wanted, apart(threshold))
    shared_points = spark.sparkContext.broadcast(points)
    described = classes.mapInPandas(
        _describe(shared_points, description),
        f"label {classes.schema['label'].dataType.simpleString()}, embedding array<double>, "
        "size long, least long, cid long, pivots array<long>",
    )
    listed = saved(
        described.withColumn("dim", dim).drop("least"), "described"
    ).withColumn("pivot", F.explode("pivots"))
    key = ["label", "dim", "pivot"]
    lengths = listed.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = (
        listed.join(lengths, key)
        .withColumn("own", F.expr("cast(pmod(xxhash64(cid), blocks) as int)"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    # side 0 and 1: a row of the first and the second block; 2: both are the same block
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") > F.col("other"), 1).otherwise(0)
    found = saved(
        dealt.select(
            *key,
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            side.alias("side"),
            "cid",
            "size",
            "embedding",
            "pivots",
        )
        .groupBy(*key, "i", "j")
        .applyInPandas(_verify(threshold, shared), "cid long, links long, root long"),
        "links",
    )
    links = found.groupBy("cid").agg(F.sum("links").alias("others"))
    roots = components(found.where("cid <> root"), "cid", "root")
    named = (
        classes.join(links, "cid", "left")
        .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = named.join(ids, "root").select(
        "label",
        "embedding",
        (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        "component_id",
    )
    linked = rows.where("linkable").join(of_class, ["label", "embedding"])
    alone = rows.where("not coalesce(linkable, false)").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        linked.select("vec_id", "n_links", "component_id")
        .union(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
