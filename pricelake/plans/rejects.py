"""The batch table with its rejects: two outputs of one pass, and counts that add up."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.batch import REASONS, expand_time, reject_reason
from pricelake.schemas import BATCH, BATCH_A_COLUMNS, CORRUPT

ACCEPTED = "accepted"
_OUTCOMES = (ACCEPTED, *REASONS)


class BatchCounts(NamedTuple):
    read: int
    accepted: int
    rejected: dict[str, int]


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """A writer keeps a file open for each outcome, so that rows need not be sorted by it."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_batch_with_rejects(lines: DataFrame, path: str) -> BatchCounts:
    """Write the batch rows of ``read_combined_lines`` and the lines that are none.

    One narrow pass over the text and one write to the new ``path``, foldered by outcome:
    ``accepted``, or the reason for which a line was rejected. Rejected lines keep their
    text. Lines are counted where they are read and rows where they are written; if the
    counts differ the build fails. No second pass counts anything.
    """
    read, written = Observation("read"), Observation("written")
    outcome = F.coalesce(reject_reason(), F.lit(ACCEPTED))
    marked = (
        lines.observe(read, F.count(F.lit(1)).alias("lines"))
        .withColumn("outcome", outcome)
        .withColumn("raw", F.when(F.col("outcome") != ACCEPTED, F.col("raw")))
        .drop(CORRUPT)
    )
    rows = expand_time(marked).select(*BATCH_A_COLUMNS, "time_ms", "raw", "outcome")
    counts = [F.count_if(F.col("outcome") == name).alias(name) for name in _OUTCOMES]
    with _open_files(lines.sparkSession, len(_OUTCOMES)):
        (
            rows.observe(written, *counts)
            .write.mode("errorifexists")
            .partitionBy("outcome")
            .parquet(path)
        )
    found = BatchCounts(
        read.get["lines"],
        written.get[ACCEPTED],
        {name: written.get[name] for name in REASONS},
    )
    if found.accepted + sum(found.rejected.values()) != found.read:
        raise RuntimeError(f"{path}: of the lines read some were not written, or twice: {found}")
    return found


def _outcomes(spark: SparkSession, path: str) -> DataFrame:
    layout = f"{BATCH}, raw string, outcome string"
    return spark.read.schema(layout).parquet(path)


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """The batch rows; the folders of rejects are not opened."""
    rows = _outcomes(spark, path).where(F.col("outcome") == ACCEPTED)
    return rows.drop("raw", "outcome")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(raw, reason) of the lines that are no bars."""
    rows = _outcomes(spark, path).where(F.col("outcome") != ACCEPTED)
    return rows.select("raw", F.col("outcome").alias("reason"))
