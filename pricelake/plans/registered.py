"""The registered queries: each operator run over whole tables.

``events`` is the tick table (its type is the pair), ``orders`` and ``lineitem``
give larger closing-row builds. Files, queue messages and streams are written by
Spark from those tables into a fresh folder of the shared scratch area.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import (
    day_key,
    pair_from_path,
    pair_from_product,
    stem_from_path,
)
from pricelake.operators import (
    build_daily,
    build_full,
    closing_rows,
    combine,
    drop_header_rows,
    expand_time,
    format_row,
    from_cells,
    key_range_scan,
    latest_by_key,
    latest_n,
    pairs,
    parse_feed,
    price_history,
    select_products,
    ticker_only,
    to_backend,
    to_cells,
    to_frontend,
    with_day_key,
)
from pricelake.plans import (
    batch_rows,
    build_batch,
    compact,
    current_view,
    daily_table,
    read_base,
    read_full,
    read_quarantine,
    register_views,
    stored_history,
    write_base,
    write_full,
)
from pricelake.plans import registered_live, registered_storage
from pricelake.plans.given import (
    ALL_AVAILABLE,
    bars,
    daily,
    deliver,
    feed_messages,
    quarters,
    replay,
    table,
    ticks,
)
from pricelake.schemas import (
    BATCH_A_COLUMNS,
    COMBINED_COLUMNS,
    DAILY_COLUMNS,
    RAW_BAR_COLUMNS,
)
from pricelake.session import scratch_dir
from pricelake.sources import (
    audit_counts,
    export_csv,
    read_bar_files,
    read_combined,
    read_lake,
    table_location,
    write_lake,
    write_table,
)
from pricelake.streaming import (
    fan_out,
    latest_n_stream,
    parquet_batches,
    parse_ticks,
    read_board,
    split_valid,
    to_messages,
)

Query = Callable[[SparkSession, str], DataFrame]

PRODUCTS = ["CLICK-USD-X", "VIEW-USD-X"]


# -- batch -------------------------------------------------------------------


def batch_expand_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = bars(spark, sf_dir).withColumn("time", F.col("time").cast("string"))
    return expand_time(text).select(*BATCH_A_COLUMNS, "seq")


def batch_expand_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_time(bars(spark, sf_dir), "b").select(
        "pair", "date", "time", "close", "volume", "seq"
    )


def header_sentinel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("pair")
    marked = F.when(kind == "error", "pair").when(kind != "view", kind)
    return drop_header_rows(ticks(spark, sf_dir).withColumn("pair", marked)).select(
        "pair", "close", "seq"
    )


def combine_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    raw = events.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("close"),
        (F.col("value") + 1).alias("open"),
        (F.col("value") + 2).alias("high"),
        (F.col("value") - 1).alias("low"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        millis.alias("time"),
    )
    return combine(raw)


def file_pair_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name of the file each row came from, over several tables, with counts."""
    parts = [
        table(spark, sf_dir, name).select(F.col("_metadata.file_path").alias("path"))
        for name in ("events", "orders", "lineitem", "customer")
    ]
    paths = parts[0]
    for part in parts[1:]:
        paths = paths.unionByName(part)
    # Reduced by path first: one name to decode per file, not per row.
    files = paths.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    return (
        files.select(
            pair_from_path(F.col("path")).alias("pair"),
            stem_from_path(F.col("path")).alias("stem"),
            "rows",
        )
        .groupBy("pair", "stem")
        .agg(F.sum("rows").alias("rows"))
        .orderBy("pair")
    )


def pair_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(ticks(spark, sf_dir))


def bar_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars written as text with two header orders, read back by name."""
    folder = scratch_dir(spark, "bar-files")
    rows = bars(spark, sf_dir)
    swapped = ["time", "close", "open", "low", "high", "volume"]
    morning = F.hour(F.timestamp_millis("time")) < 12
    for part, columns in ((rows.where(morning), RAW_BAR_COLUMNS), (rows.where(~morning), swapped)):
        part.select(*columns).write.mode("append").option("header", True).csv(folder)
    return read_bar_files(spark, folder, by_name=True).select(*RAW_BAR_COLUMNS)


def csv_daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined text export, read back, to the daily closing rows.

    Milliseconds are all the text keeps, so ties fall to close and volume.
    """
    folder = scratch_dir(spark, "combined")
    export_csv(bars(spark, sf_dir).select(*COMBINED_COLUMNS), folder)
    return build_daily(batch_rows(read_combined(spark, folder)))


def csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, separators and escapes inside a field survive the text form."""
    folder = scratch_dir(spark, "quoted")
    named = F.concat(F.lit('"'), F.col("pair"), F.lit('", \\n'))
    export_csv(bars(spark, sf_dir).withColumn("pair", named).select(*COMBINED_COLUMNS), folder)
    return read_combined(spark, folder, quoted=True)


def batch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch table as stored; a second build finds it and leaves it alone."""
    path = scratch_dir(spark, "batch")
    rows = bars(spark, sf_dir).select(*COMBINED_COLUMNS)
    build_batch(rows, path)
    return build_batch(rows, path, if_not_exists=True).select(*BATCH_A_COLUMNS, "time_ms")


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table left alone because it exists, and one replaced by a later build."""
    rows = ticks(spark, sf_dir).select("pair", "price_date", "close", "volume", "seq")
    early = rows.where(F.col("price_date") <= F.lit("2024-01-15").cast("date"))
    parts = []
    for label, if_not_exists in (("kept", True), ("replaced", False)):
        paths = [scratch_dir(spark, label) for _ in range(2)]
        name = paths[0].rsplit("/", 1)[-1].replace("-", "_")
        write_table(early, name, paths[0])
        write_table(rows, name, paths[1], if_not_exists=if_not_exists)
        folder = table_location(spark, name)
        spark.sql(f"DROP TABLE {name}")  # its rows stay where they were written
        stored = spark.read.schema(rows.schema).parquet(folder)
        parts.append(stored.select(F.lit(label).alias("label"), *rows.columns))
    return parts[0].unionByName(parts[1])


def lake_daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "lake")
    write_lake(bars(spark, sf_dir).select(*COMBINED_COLUMNS), path, regroup=True)
    return build_daily(batch_rows(read_lake(spark, path)))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ticks(spark, sf_dir)
    return audit_counts(
        {
            "batch": batch_rows(bars(spark, sf_dir)),
            "daily": build_daily(rows),
            "orders": table(spark, sf_dir, "orders"),
            "lineitem": table(spark, sf_dir, "lineitem"),
        }
    )


# -- serving -----------------------------------------------------------------


def daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_table(ticks(spark, sf_dir))


def daily_close_maxby(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ticks(spark, sf_dir).drop("time_ms")
    return with_day_key(latest_by_key(rows, ["pair", "price_date"])).select(*DAILY_COLUMNS)


def sql_closing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closing rows as an aggregate in SQL, over the batch view."""
    register_views(bars(spark, sf_dir).select(*COMBINED_COLUMNS))
    return spark.sql(
        """
        SELECT pair, price_date, closing.close, closing.volume
        FROM (
          SELECT pair, price_date, max(struct(time_ms, close, volume)) AS closing
          FROM batch_prices
          GROUP BY pair, price_date
        )
        """
    )


def sql_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts and the span of days of each view, in SQL."""
    register_views(bars(spark, sf_dir).select(*COMBINED_COLUMNS))
    return spark.sql(
        """
        SELECT 'batch' AS name, count(*) AS rows, min(price_date) AS first, max(price_date) AS last
        FROM batch_prices
        UNION ALL
        SELECT 'minute', count(*), min(price_date), max(price_date) FROM minute_prices
        UNION ALL
        SELECT 'daily', count(*), min(price_date), max(price_date) FROM daily_prices
        """
    )


def daily_close_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("pair"),
        F.to_date(at).alias("price_date"),
        F.unix_millis(at).alias("time_ms"),
        F.col("o_totalprice").alias("close"),
        F.col("o_custkey").cast("double").alias("volume"),
        F.col("o_orderkey").alias("seq"),
    )
    return build_daily(rows)


def daily_close_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No column set of this table is unique: equal order means equal output."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("pair"),
        F.to_date("l_shipdate").alias("price_date"),
        F.col("l_orderkey").alias("seq"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").alias("volume"),
    )
    last = closing_rows(rows, ["pair", "price_date"], ["seq"], ["close", "volume"])
    return with_day_key(last).select(*DAILY_COLUMNS)


def minute_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_full(batch_rows(bars(spark, sf_dir)))


def minute_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute table as stored: a week of one pair, by folder and key range."""
    path = scratch_dir(spark, "full")
    write_full(batch_rows(bars(spark, sf_dir)), path)
    stored = read_full(spark, path, "purchase")
    return key_range_scan(
        stored, "pair_date_time", "purchase_2024-01-09", "purchase_2024-01-16"
    )


def daily_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "store")
    write_base(build_daily(ticks(spark, sf_dir), keep=["event_time", "seq"]), root)
    return read_base(spark, root).select("pair", "price_date", "close", "volume", "volume_kind")


def snapshot_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch load replaces its own keys, here by older rows, and no others."""
    root = scratch_dir(spark, "store")
    rows = ticks(spark, sf_dir)
    reloaded = (F.col("price_date") > F.lit("2024-01-15").cast("date")) & (
        F.hour("event_time") < 12
    )
    for part in (rows.where(~reloaded), rows.where(reloaded)):
        write_base(build_daily(part, keep=["event_time", "seq"]), root)
    return current_view(spark, root).select(*DAILY_COLUMNS)


def price_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_history(daily(spark, sf_dir), "click", "2024-01-08", "2024-01-14")


def price_range_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_row(price_history(daily(spark, sf_dir), "view", "2024-01-20", "2024-02-20"))


def key_range_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_range_scan(
        daily(spark, sf_dir), "pair_date", "click_2024-01-05", "click_2024-01-12"
    ).select(*DAILY_COLUMNS)


def key_range_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_range_scan(
        daily(spark, sf_dir), "pair_date", "click_2024-01-05", "click_2024-01-12\x00"
    ).select(*DAILY_COLUMNS)


def cells_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_cells(
        daily(spark, sf_dir), "pair_date", ["pair", "price_date", "close", "volume"]
    ).withColumnRenamed("pair_date", "key")


def _typed(wide: DataFrame) -> DataFrame:
    return wide.select(
        F.col("key").alias("pair_date"),
        "pair",
        F.col("price_date").cast("date").alias("price_date"),
        F.col("close").cast("double").alias("close"),
        F.col("volume").cast("double").alias("volume"),
    )


def cells_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cells_unpivot(spark, sf_dir).withColumn("version", F.lit(1).cast("bigint"))
    return _typed(from_cells(cells, ["pair", "price_date", "close", "volume"]))


def cells_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick is a version of its day's cells; the newest one is read."""
    rows = ticks(spark, sf_dir).withColumn("key", day_key(F.col("pair"), F.col("price_date")))
    columns = ["pair", "price_date", "close", "volume"]
    cells = to_cells(rows, "key", columns, version="seq")
    return _typed(from_cells(cells, columns, version="seq"))


# -- feed and messages -------------------------------------------------------


def _numbers(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: F.col(name).try_cast("double") for name in ("close", "volume")}
    )


def product_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = select_products(ticker_only(parse_feed(feed_messages(spark, sf_dir))), PRODUCTS)
    return feed.select(
        "product_id", pair_from_product(F.col("product_id")).alias("pair"), "sequence"
    )


def product_list_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wanted products come from a table: the types ever worth over 100."""
    feed = parse_feed(feed_messages(spark, sf_dir))
    wanted = (
        ticks(spark, sf_dir)
        .groupBy("pair")
        .agg(F.min("close").alias("least"), F.max("close").alias("most"))
        .where("most > 100")
        .select(F.concat(F.upper("pair"), F.lit("-USD-X")).alias("product_id"))
    )
    return select_products(ticker_only(feed), wanted).select("product_id", "sequence")


def backend_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_backend(ticker_only(parse_feed(feed_messages(spark, sf_dir))))
    return _numbers(rows).drop("event_time")


def frontend_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(to_frontend(ticker_only(parse_feed(feed_messages(spark, sf_dir)))))


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages of the ticks, keyed by pair."""
    rows = ticks(spark, sf_dir)
    return to_messages(
        rows.select("pair", "price_date", "close", "volume", "event_time", "seq")
    )


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tick_messages(spark, sf_dir).select(
        "value",
        F.lit(None).cast("timestamp").alias("source_time"),
        F.lit(None).cast("bigint").alias("source_seq"),
    )
    valid, _ = split_valid(parse_ticks(messages))
    micros = F.unix_micros("event_time").alias("event_us")
    return valid.select("pair", "price_date", "close", "volume", "seq", micros)


# -- streams -----------------------------------------------------------------


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "store")
    replay(spark, quarters(spark, sf_dir, (3, 1, 4, 2)), root)
    return registered_live.view(spark, root)


def stream_upsert_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "store")
    replay(spark, quarters(spark, sf_dir, (3, 1, 4, 2)), root)
    return registered_live.view(spark, root, "arrival")


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compaction between two deliveries and after the last one changes nothing."""
    root = scratch_dir(spark, "store")
    first, second, *rest = quarters(spark, sf_dir, (4, 2, 3, 1))
    replay(spark, [first, second], root)
    compact(spark, root)
    replay(spark, rest, root)
    compact(spark, root)
    return registered_live.view(spark, root, "arrival")


def merge_current_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registered_live.view(spark, registered_storage.base_and_stream(spark, sf_dir))


def merge_arrival_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registered_live.view(spark, registered_storage.base_and_stream(spark, sf_dir), "arrival")


def merged_price_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup on the merged view, from days the snapshot wins to days it loses."""
    root = registered_storage.base_and_stream(spark, sf_dir)
    return stored_history(spark, root, "purchase", "2024-01-14", "2024-01-24")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of the five kinds of event are sent as three kinds of bad record."""
    kind = F.col("pair")
    head = F.concat(F.lit('{"pair":"'), kind, F.lit('","seq":'), F.col("seq").cast("string"))
    dated = F.concat(head, F.lit(',"price_date":"'), F.col("price_date").cast("string"), F.lit('"'))
    message = (
        F.when(kind == "error", F.concat(F.lit("{bad "), F.col("seq").cast("string")))
        .when(kind == "view", F.concat(dated, F.lit(',"volume":"1"}')))
        .when(kind == "signup", F.concat(dated, F.lit(',"close":"n/a","volume":"1"}')))
        .otherwise(F.concat(dated, F.lit(',"close":"1","volume":"1","extra":true}')))
    )
    root = scratch_dir(spark, "store")
    replay(spark, [ticks(spark, sf_dir).select(message.alias("value"))], root)
    return read_quarantine(spark, root).select("raw", "reason")


def _fan_out(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    paths = {name: scratch_dir(spark, name) for name in ("backend", "frontend")}
    outputs = {
        "backend": (to_backend, parquet_batches(paths["backend"])),
        "frontend": (to_frontend, parquet_batches(paths["frontend"])),
    }
    deliver(
        spark,
        [feed_messages(spark, sf_dir)],
        lambda stream, checkpoint: fan_out(
            ticker_only(parse_feed(stream)), outputs, checkpoint, ALL_AVAILABLE
        ),
    )
    return paths


def fan_out_backend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(_fan_out(spark, sf_dir)["backend"])
    return _numbers(rows).drop("event_time", "run", "batch")


def fan_out_frontend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark.read.parquet(_fan_out(spark, sf_dir)["frontend"])).drop("run", "batch")


def latest_nine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_n(ticks(spark, sf_dir)).select("pair", "rank", "seq", "close", "volume")


def latest_nine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "board")

    def start(stream: DataFrame, checkpoint: str):
        valid, _ = split_valid(parse_ticks(stream))
        return latest_n_stream(valid, path, checkpoint, trigger=ALL_AVAILABLE)

    deliver(spark, quarters(spark, sf_dir, (2, 4, 1, 3)), start)
    return read_board(spark, path).select("pair", "rank", "seq", "close", "volume")


QUERIES: dict[str, Query] = {
    "batch_expand_a": batch_expand_a,
    "batch_expand_b": batch_expand_b,
    "header_sentinel_filter": header_sentinel_filter,
    "combine_projection": combine_projection,
    "file_pair_catalog": file_pair_catalog,
    "pair_catalog": pair_catalog,
    "bar_file_ingest": bar_file_ingest,
    "csv_daily_close": csv_daily_close,
    "csv_quoted": csv_quoted,
    "batch_table": batch_table,
    "catalog_tables": catalog_tables,
    "lake_daily_close": lake_daily_close,
    "audit_counts": audit,
    "daily_close": daily_close,
    "daily_close_maxby": daily_close_maxby,
    "sql_closing_rows": sql_closing_rows,
    "sql_counts": sql_counts,
    "daily_close_orders": daily_close_orders,
    "daily_close_lineitem": daily_close_lineitem,
    "minute_serving": minute_serving,
    "minute_snapshot": minute_snapshot,
    "daily_snapshot": daily_snapshot,
    "snapshot_reload": snapshot_reload,
    "price_range": price_range,
    "price_range_display": price_range_display,
    "key_range_scan": key_range_exclusive,
    "key_range_scan_inclusive": key_range_inclusive,
    "cells_unpivot": cells_unpivot,
    "cells_pivot": cells_pivot,
    "cells_latest_version": cells_latest_version,
    "product_normalize": product_normalize,
    "product_list_join": product_list_join,
    "backend_projection": backend_projection,
    "frontend_projection": frontend_projection,
    "tick_messages": tick_messages,
    "json_round_trip": json_round_trip,
    "stream_upsert": stream_upsert,
    "stream_upsert_arrival": stream_upsert_arrival,
    "stream_compacted": stream_compacted,
    "merge_current_view": merge_current_view,
    "merge_arrival_view": merge_arrival_view,
    "merged_price_range": merged_price_range,
    "stream_quarantine": stream_quarantine,
    "fan_out_backend": fan_out_backend,
    "fan_out_frontend": fan_out_frontend,
    "latest_n": latest_nine,
    "latest_n_stream": latest_nine_stream,
    **registered_storage.QUERIES,
    **registered_live.QUERIES,
}
