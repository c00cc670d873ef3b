"""Stored layouts that spare a query its exchange or its scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, key: str = "pair", order: str = "time_ms"
) -> DataFrame:
    """Catalog table at the new ``path``, bucketed by ``key`` and sorted by ``order`` in each.

    Rows are dealt by the key once, when they are written; a window or an aggregate by the
    key, or by more columns beside it, then reads a bucket a task and exchanges nothing. All
    rows of a key are in one bucket, so a key with a third of the rows is one task's work,
    in writing and in reading: for such keys use the unbucketed table, whose windows limit
    each key before the exchange.
    """
    spark = df.sparkSession
    (
        df.repartition(buckets, key)
        .write.format("parquet")
        .mode("errorifexists")
        .bucketBy(buckets, key)
        .sortBy(order)
        .option("path", path)
        .saveAsTable(name)
    )
    return spark.table(name)


def footers_only(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet counts and spans come from file footers.

    count, min and max of numbers and days, also by partition folder, are pushed into the
    reader; no column is read. Filters on other columns than folders need the rows and
    are read as ever.
    """
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other
