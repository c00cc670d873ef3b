"""The steps as jobs: ``python -m pricelake.jobs <step> ...``, or this file to spark-submit.

    lake    bar files -> partitioned Parquet lake
    batch   lake or combined text -> batch table
    full    batch table -> minute serving table
    daily   batch table -> next snapshot of the daily serving store
    feed    feed messages -> back-end ticks (queue or files), front-end rows, quarantine
    stream  queued ticks -> delta log of the store, until stopped
    board   queued ticks -> newest nine per pair, until stopped
    compact delta log -> next snapshot
    expire  snapshots, delta batches and old quarantine that nothing reads any more
    lookup  pair and dates -> rows
    pairs   known pairs of a folder of bar files

``lookup`` and ``pairs`` write all rows below --out, print the first ones of a --peek,
or both.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelake.operators import (
    build_daily,
    format_row,
    pairs_from_files,
    parse_feed,
    select_products,
    ticker_only,
    to_backend,
    to_frontend,
)
from pricelake.plans import (
    build_batch,
    build_batch_with_rejects,
    build_lake,
    compact,
    expire,
    stored_history,
    write_base,
    write_full,
)
from pricelake.schemas import CORRUPT
from pricelake.session import DEFAULTS, configure
from pricelake.sources import export_csv, read_combined, read_combined_lines, read_lake
from pricelake.streaming import (
    arrival_board_stream,
    board_rows,
    fan_out,
    latest_n_stream,
    parquet_batches,
    parse_ticks,
    queue_batches,
    read_ticks,
    split_valid,
    start_upsert,
)

def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pricelake.jobs", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, *positional: str) -> argparse.ArgumentParser:
        sub = steps.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    lake = step("lake", "files", "lake")
    lake.add_argument("--by-name", action="store_true")
    batch = step("batch", "source", "batch")
    batch.add_argument("--text", action="store_true", help="source is the combined text file")
    batch.add_argument("--quoted", action="store_true")
    batch.add_argument("--variant", choices=("a", "b"), default="a")
    batch.add_argument("--if-not-exists", action="store_true")
    batch.add_argument(
        "--rejects", action="store_true",
        help="plain text source: write bars and rejected lines below the new path, and tell how many",
    )
    step("full", "batch", "table")
    step("daily", "batch", "store")
    feed = step("feed", "outputs", "checkpoint")
    feed.add_argument("--products", nargs="*", help="product ids to keep; all by default")
    feed.add_argument("--out-topic", help="publish back-end ticks here instead of to files")
    for stream in (feed, step("stream", "store", "checkpoint"), step("board", "path", "checkpoint")):
        stream.add_argument("--brokers")
        stream.add_argument("--topic")
        stream.add_argument("--inbox", help="read text files of this folder instead of a queue")
        stream.add_argument(
            "--option", action="append", default=[], metavar="KEY=VALUE",
            help="queue option, such as maxOffsetsPerTrigger=1000000 to pace a backlog",
        )
        stream.add_argument("--interval", default="30 seconds")
        stream.add_argument("--once", action="store_true", help="stop when nothing is left to read")
    steps.choices["board"].add_argument(
        "--arrival", action="store_true", help="feed messages, newest arrival first"
    )
    step("compact", "store")
    expiry = step("expire", "store")
    expiry.add_argument("--rejects-older-than", type=float, metavar="DAYS")
    lookup = step("lookup", "store", "pair", "start", "end")
    lookup.add_argument("--order", choices=("event_time", "arrival"), default="event_time")
    listing = step("pairs", "files")
    for sub in (lookup, listing):
        sub.add_argument("--out", help="write all rows as text to this new folder")
        sub.add_argument("--peek", type=int, help="print so many of the rows")
    return parser


def _give(rows: DataFrame, args: argparse.Namespace) -> None:
    if args.out:
        export_csv(rows, args.out)
    if args.peek:
        print(f"The first {args.peek} rows at most:")
        rows.show(args.peek, truncate=False)


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.inbox:
        return read_ticks(spark, "text", path=args.inbox)
    options = {"kafka.bootstrap.servers": args.brokers, "subscribe": args.topic}
    options |= dict(pair.split("=", 1) for pair in args.option)
    return read_ticks(spark, "kafka", options)


def _feed_outputs(args: argparse.Namespace) -> dict:
    if args.out_topic:
        options = {"kafka.bootstrap.servers": args.brokers, "topic": args.out_topic}
        backend = queue_batches(options)
    else:
        backend = parquet_batches(f"{args.outputs}/backend")

    def chosen(feed: DataFrame) -> DataFrame:
        tickers = ticker_only(feed)
        return select_products(tickers, args.products) if args.products else tickers

    def malformed(feed: DataFrame) -> DataFrame:
        """Texts that are no JSON object; messages of other types are none of them."""
        return feed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw"))

    return {
        "backend": (lambda feed: to_backend(chosen(feed)), backend),
        "frontend": (
            lambda feed: to_frontend(chosen(feed)),
            parquet_batches(f"{args.outputs}/frontend"),
        ),
        "quarantine": (malformed, parquet_batches(f"{args.outputs}/quarantine")),
    }


def _start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    trigger = {"availableNow": True} if args.once else {"processingTime": args.interval}
    messages = _messages(spark, args)
    if args.step == "stream":
        return start_upsert(parse_ticks(messages), args.store, args.checkpoint, trigger)
    if args.step == "board" and args.arrival:
        rows = board_rows(ticker_only(parse_feed(messages.select("value"))))
        return arrival_board_stream(rows, args.path, args.checkpoint, trigger=trigger)
    if args.step == "board":
        valid, _ = split_valid(parse_ticks(messages))
        return latest_n_stream(valid, args.path, args.checkpoint, trigger=trigger)
    feed = parse_feed(messages.select("value"), corrupt=CORRUPT)
    return fan_out(feed, _feed_outputs(args), args.checkpoint, trigger)


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    parser = _arguments()
    args = parser.parse_args(argv)
    if args.step in ("lookup", "pairs") and not (args.out or args.peek):
        parser.error(f"{args.step} needs --out or --peek")
    configure(spark)
    if args.step == "lake":
        build_lake(spark, args.files, args.lake, args.by_name)
    elif args.step == "batch" and args.rejects:
        if args.quoted or args.if_not_exists or args.variant != "a":
            parser.error("--rejects reads plain text and writes variant a to a new path")
        print(build_batch_with_rejects(read_combined_lines(spark, args.source), args.batch))
    elif args.step == "batch":
        if args.text:
            source = read_combined(spark, args.source, quoted=args.quoted)
        else:
            source = read_lake(spark, args.source)
        build_batch(source, args.batch, args.variant, args.if_not_exists)
    elif args.step == "full":
        write_full(spark.read.parquet(args.batch), args.table)
    elif args.step == "daily":
        write_base(build_daily(spark.read.parquet(args.batch), keep=["time_ms"]), args.store)
    elif args.step in ("feed", "stream", "board"):
        _start(spark, args).awaitTermination()
    elif args.step == "compact":
        compact(spark, args.store)
    elif args.step == "expire":
        days = args.rejects_older_than
        limit = dt.datetime.now(dt.UTC) - dt.timedelta(days=days) if days is not None else None
        print(expire(spark, args.store, limit))
    elif args.step == "lookup":
        found = stored_history(spark, args.store, args.pair, args.start, args.end, args.order)
        _give(format_row(found), args)
    elif args.step == "pairs":
        _give(pairs_from_files(spark, args.files), args)


def main() -> None:
    builder = SparkSession.builder.appName("pricelake")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        run(spark)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
