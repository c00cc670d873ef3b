"""Helpers the operators share: reading, cutting lineage, connected components."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.session import scratch_dir

# Task functions travel with the job, so executors need no copy of this repository.
cloudpickle.register_pickle_by_value(sys.modules["pricelake.llm"])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the query that wrote them ends, not with the driver's next GC."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors.

    What was shuffled for it is not needed afterwards and leaves the disk at once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sent(spark: SparkSession, value):
    """A broadcast of a value of bounded size whose classes executors need not have."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(broadcast):
    return pickle.loads(broadcast.value)


def partitions(spark: SparkSession, units: int, per_task: int) -> int:
    """Tasks for ``units`` of work at ``per_task`` each, not below the session's shuffle width."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(width, -(-int(units) // per_task))


def text_of(column: str = "text") -> Column:
    """The text with NULL read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.select(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
    ).first()
    return row["n"], row["x"]


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root) of every node with an edge; root is the least node of its component.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which
    shrink every component to a star in a logarithmic number of rounds. Both steps
    are a grouped minimum and a join on the node, so a node with many edges is
    summed on the map side and split by adaptive execution; no component is
    gathered anywhere. Only a row count and a checksum reach the driver.
    """
    stars = saved(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    before = _fingerprint(stars)
    while before[0]:
        # large star: every larger neighbour of u points at the least of u's neighbourhood
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # small star: u and its smaller neighbours point at the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        stars = saved(small, "stars")
        after = _fingerprint(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        stars.select("v", "v").distinct().toDF("node", "root")
    )
