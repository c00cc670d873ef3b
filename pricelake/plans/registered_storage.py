"""Registered queries of the stored layouts: rejects, keys, buckets, folders and footers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import build_daily, select_products
from pricelake.plans import (
    batch_rows,
    build_batch_with_rejects,
    read_accepted,
    read_rejects,
    stored_key_range,
    write_base,
)
from pricelake.plans.given import bars, replay, ticks
from pricelake.schemas import COMBINED_COLUMNS, DAILY_COLUMNS
from pricelake.session import scratch_dir
from pricelake.sources import (
    footers_only,
    read_combined_lines,
    read_lake,
    write_bucketed,
    write_lake,
)
from pricelake.streaming import to_messages

BUCKETS = 8


def bar_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick as a line of the combined text: two kinds good, three bad in two ways each."""
    early = F.hour("event_time") < 12
    text = lambda name: F.col(name).cast("string")
    cents = F.round(F.col("close") * 100).cast("bigint").cast("string")
    line = lambda pair, time, close=cents, rest="1,2,3": F.concat_ws(
        ",", pair, time, text("seq"), close, F.lit(rest)
    )
    pair, time, none = F.col("pair"), text("time_ms"), F.lit("")
    lines = ticks(spark, sf_dir).select(
        F.when((pair == "error") & early, line(pair, F.concat(time, F.lit("x"))))
        .when(pair == "error", line(pair, F.lit("9" * 17)))
        .when((pair == "signup") & early, line(none, time))
        .when(pair == "signup", line(pair, none))
        .when((pair == "view") & early, line(pair, time, F.lit("n/a")))
        .when(pair == "view", line(pair, time, rest="1,2"))
        .otherwise(line(pair, time))
        .alias("value")
    )
    header = spark.sql("SELECT 1").select(F.lit(",".join(COMBINED_COLUMNS)).alias("value"))
    return lines.union(header)


def batch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of one pass over text with bad numbers, times, pairs and field counts."""
    text, batch = scratch_dir(spark, "lines"), scratch_dir(spark, "checked")
    bar_lines(spark, sf_dir).write.text(text)
    build_batch_with_rejects(read_combined_lines(spark, text), batch)
    whole = lambda name: F.col(name).cast("bigint").alias(name)
    accepted = read_accepted(spark, batch).select(
        F.lit("accepted").alias("outcome"),
        F.lit(None).cast("string").alias("raw"),
        "pair",
        "full_timestamp",
        whole("open"),
        whole("close"),
    )
    empty = [F.lit(None).cast(t).alias(n) for n, t in accepted.dtypes[2:]]
    return read_rejects(spark, batch).select(F.col("reason").alias("outcome"), "raw", *empty).union(accepted)


def base_and_stream(spark: SparkSession, sf_dir: str) -> str:
    """Every tick, half in the snapshot and half streamed on top of it.

    In the first half of the month the snapshot has the afternoons and is newer,
    in the second half it has the mornings and is older.
    """
    root = scratch_dir(spark, "store")
    rows = ticks(spark, sf_dir)
    afternoon = F.hour("event_time") >= 12
    first_half = F.col("price_date") <= F.lit("2024-01-15").cast("date")
    in_base = afternoon == first_half
    write_base(build_daily(rows.where(in_base), keep=["event_time", "seq"]), root)
    replay(spark, [to_messages(rows.where(~in_base).drop("time_ms"))], root)
    return root


def key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of the stored text key, from one pair's last days over another to a third's first."""
    root = base_and_stream(spark, sf_dir)
    return stored_key_range(spark, root, "click_2024-01-25", "purchase_2024-01-10").select(
        *DAILY_COLUMNS
    )


def daily_close_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "bucketed")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    batch = batch_rows(bars(spark, sf_dir).select(*COMBINED_COLUMNS))
    return build_daily(write_bucketed(batch, name, path, BUCKETS))


def lake_product_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake's rows of the products on a list that is a table: pairs with less than a fifth of the ticks.

    The list is known when the query runs only; its pairs prune the lake's folders then.
    """
    lake, products = scratch_dir(spark, "lake"), scratch_dir(spark, "products")
    rows = bars(spark, sf_dir)
    write_lake(rows.select(*COMBINED_COLUMNS), lake, regroup=True)
    counts = rows.groupBy("pair").agg(F.count(F.lit(1)).alias("ticks"))
    counts.select(F.col("pair").alias("product_id"), "ticks").write.parquet(products)
    few = F.lit(rows.count() / 5)
    listed = spark.read.parquet(products).where(F.col("ticks") < few)
    stored = read_lake(spark, lake).withColumnRenamed("pair", "product_id")
    return select_products(stored, listed).withColumnRenamed("product_id", "pair")


def stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, span of times and of prices of each pair of the lake, from file footers alone."""
    lake = scratch_dir(spark, "lake")
    write_lake(bars(spark, sf_dir).select(*COMBINED_COLUMNS), lake, regroup=True)
    return (
        read_lake(footers_only(spark), lake)
        .groupBy("pair")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("volume").alias("volumes"),
            F.min("time").alias("first_ms"),
            F.max("time").alias("last_ms"),
            F.min("close").alias("least"),
            F.max("close").alias("most"),
        )
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "batch_rejects": batch_rejects,
    "stored_key_range": key_range,
    "daily_close_bucketed": daily_close_bucketed,
    "lake_product_list": lake_product_list,
    "stored_counts": stored_counts,
}
