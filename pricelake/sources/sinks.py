"""Writers for the lake, exports and managed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_lake(df: DataFrame, path: str, regroup: bool = False) -> None:
    """Combined bars as Parquet at a new path, one folder per instrument.

    Bar files hold one instrument each, so their tasks already write few
    folders and no shuffle is needed. ``regroup`` is for mixed input: a
    rebalance by instrument, which AQE splits where an instrument is hot.
    A lake is rebuilt at another path, so a failed rebuild costs nothing.
    """
    if regroup:
        df = df.hint("rebalance", "pair")
    nameless = F.raise_error(F.lit("a bar with an empty pair has no folder in the lake"))
    df = df.withColumn("pair", F.when(F.col("pair") == "", nameless).otherwise(F.col("pair")))
    df.write.mode("errorifexists").partitionBy("pair").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Text export to a new folder of parts, with a header per file."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_table(df: DataFrame, name: str, path: str, if_not_exists: bool = False) -> DataFrame:
    """Catalog table over Parquet at the new ``path``: replaced, or left alone when it exists.

    A replaced table's rows are written in full before the name moves to them, in one
    step of the catalog: a reader finds the old rows or the new ones. The old rows stay
    where they are until they are expired. Rows of another layout are refused, as a name
    cannot move to them in one step. ``if_not_exists`` leaves the decision to the catalog,
    so a table created meanwhile is kept.
    """
    spark = df.sparkSession
    if if_not_exists:
        df.write.mode("ignore").format("parquet").option("path", path).saveAsTable(name)
        return spark.table(name)
    exists = spark.catalog.tableExists(name)
    if exists and _layout(spark.table(name)) != _layout(df):
        raise ValueError(f"{name} holds {_layout(spark.table(name))}, not {_layout(df)}")
    df.write.mode("errorifexists").parquet(path)
    if exists:
        quoted = path.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)
    return spark.table(name)


def _layout(df: DataFrame) -> str:
    return df.schema.simpleString()


def table_location(spark: SparkSession, name: str) -> str:
    """The folder a catalog table's rows are in."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.where("col_name = 'Location'").first()["data_type"]


def audit_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named frame, as one job."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, frame in frames.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result
