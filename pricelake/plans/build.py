"""Batch builds: files to lake, lake to batch table, batch table to serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from pricelake.functions import shard_of
from pricelake.operators.batch import combine, drop_header_rows, expand_time
from pricelake.operators.serving import build_daily, build_full, latest_seconds, with_texts
from pricelake.schemas import FULL, SHARD_FOLDERS, SHARDS
from pricelake.sources.bars import read_bar_files, read_lake
from pricelake.sources.sinks import write_lake


def read_or_none(read) -> DataFrame | None:
    """The frame ``read`` gives, or None where its path does not exist (yet)."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(0).select(*columns)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the write to ``path`` was committed as a whole."""
    return read_or_none(lambda: spark.read.text(f"{path}/_SUCCESS")) is not None


def build_lake(spark: SparkSession, bar_files: str, lake: str, by_name: bool = False) -> DataFrame:
    """Bar files to the partitioned lake at a new path: one narrow pass, no shuffle."""
    write_lake(combine(read_bar_files(spark, bar_files, by_name=by_name)), lake)
    return read_lake(spark, lake)


def batch_rows(combined: DataFrame, variant: str = "a") -> DataFrame:
    """Combined rows to batch rows (not written)."""
    return expand_time(drop_header_rows(combined), variant)


def build_batch(
    combined: DataFrame, path: str, variant: str = "a", if_not_exists: bool = False
) -> DataFrame:
    """Write the batch table to a new path and return it as stored.

    ``if_not_exists`` returns a table that is there already, but only a whole one
    of the same variant: a build that broke off is not taken for a table.
    """
    spark = combined.sparkSession
    rows = batch_rows(combined, variant)
    if if_not_exists and is_complete(spark, path):
        existing = spark.read.parquet(path)
        if existing.columns != rows.columns:
            raise ValueError(f"{path} holds {existing.columns}, not {rows.columns}")
        return existing
    rows.write.mode("errorifexists").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def by_shard(df: DataFrame, *order: str) -> DataFrame:
    """Rows laid out for their shard folders, sorted by ``order`` within each.

    Ranges over the whole order split a hot pair; sorted rows let the Parquet
    statistics skip the other pairs of a shard. Keys are expected to be unique,
    so reduce first.
    """
    columns = ["shard", *order]
    sharded = df.withColumns({"shards": F.lit(SHARDS), "shard": shard_of(F.col("pair"))})
    return sharded.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_shards(df: DataFrame, path: str) -> None:
    """The number of shards is a folder too, so a reader that expects another one notices."""
    df.write.mode("errorifexists").partitionBy("shards", "shard").parquet(path)


def write_full(batch: DataFrame, path: str) -> None:
    """The minute serving table.

    Reduced by a hash exchange, which limits each key on the map side, and laid
    out by a range exchange. A range exchange alone would bring equal keys
    together too, but would gather a much repeated key in one task.
    """
    rows = by_shard(latest_seconds(batch), "pair", "_second")
    write_shards(with_texts(rows, ["shards", "shard"]), path)


def read_sharded(
    spark: SparkSession, path: str, schema: StructType, pair: str | None = None
) -> DataFrame:
    """A sharded table, or only the rows of one pair.

    For one pair a single folder is listed and opened, however many there are.
    A pair without a folder has no rows; a path without such a table is an error.
    """
    layout = StructType([*schema.fields, *SHARD_FOLDERS])
    reader = spark.read.schema(layout).option("basePath", path)
    if pair is None:
        return reader.parquet(path).select(*schema.names)
    number = spark.sql("SELECT 1").select(shard_of(F.lit(pair))).first()[0]
    top = f"{path}/shards={SHARDS}"
    folder = read_or_none(lambda: reader.parquet(f"{top}/shard={number}"))
    if folder is None:
        if not is_complete(spark, path):
            raise ValueError(f"there is no (whole) sharded table at {path}")
        stored = reader.parquet(path).where(F.col("shards") != SHARDS)
        if not stored.isEmpty():
            raise ValueError(f"{path} was not written with {SHARDS} shards")
        return empty(spark, schema)
    return folder.where(F.col("pair") == pair).select(*schema.names)


def read_full(spark: SparkSession, path: str, pair: str | None = None) -> DataFrame:
    return read_sharded(spark, path, FULL, pair)


def register_views(combined: DataFrame) -> None:
    """The tables as views for SQL users; a query over them plans like the operators."""
    batch = batch_rows(combined)
    views = {
        "bars": combined,
        "batch_prices": batch,
        "minute_prices": build_full(batch),
        "daily_prices": build_daily(batch),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def daily_table(batch: DataFrame) -> DataFrame:
    return build_daily(batch).orderBy("pair", "price_date")
