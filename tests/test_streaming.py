import datetime as dt
import json

from tests.conftest import rows
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pricelake.operators import (
    latest_by_key,
    latest_n,
    parse_feed,
    select_products,
    ticker_only,
    to_backend,
    to_frontend,
)
from pricelake.plans import compact, current_view, read_base, read_delta, read_quarantine, write_base
from pricelake.plans.store import _manifest_head
from pricelake.streaming import (
    fan_out,
    latest_n_stream,
    merge_board,
    parquet_batches,
    parse_ticks,
    queue_batches,
    read_board,
    read_ticks,
    split_valid,
    start_upsert,
    to_messages,
    write_ticks,
)

NOW = {"availableNow": True}


def message(pair="btcusd", day="2024-01-01", close="1.5", volume="2", at="12:00:00", seq=0, **more):
    body = dict(pair=pair, price_date=day, close=close, volume=volume, seq=seq)
    body["event_time"] = f"{day}T{at}Z"
    body.update(more)
    return json.dumps(body)


def put(folder, name, *lines):
    with open(f"{folder}/{name}", "w") as file:
        file.write("\n".join(lines) + "\n")


def run(spark, inbox, root, checkpoint, **options):
    stream = parse_ticks(read_ticks(spark, "text", options, inbox))
    query = start_upsert(stream, root, checkpoint, NOW)
    query.awaitTermination()
    return query


def closes(view):
    return {row["pair_date"]: row["close"] for row in view.collect()}


def test_feed_types_products_and_projections(spark):
    def feed(**more):
        body = {
            "type": "ticker",
            "product_id": "BTC-USD",
            "time": "2024-01-05T23:59:59.999999Z",
            "price": "10.50",
            "volume_24h": "7",
            "last_size": "0.1",
            "side": "buy",
        }
        body.update(more)
        return (json.dumps({k: v for k, v in body.items() if v is not None}),)

    raw = [
        feed(),
        feed(type="subscriptions"),
        feed(type="error"),
        feed(type=None),
        feed(product_id="ETH-USD"),
        feed(product_id="DOGE-USD"),
        ("{bad",),
    ]
    parsed = ticker_only(parse_feed(spark.createDataFrame(raw, "value string")))
    assert parsed.count() == 3
    wanted = select_products(parsed, ["BTC-USD", "ETH-USD"])
    listed = spark.createDataFrame([("BTC-USD",), ("ETH-USD",)], "product_id string")
    assert rows(wanted) == rows(select_products(parsed, listed)) and wanted.count() == 2
    back = to_backend(wanted).where("pair = 'btcusd'").first()
    assert (back["price_date"], back["close"], back["volume"]) == (dt.date(2024, 1, 5), "10.50", "7")
    front = to_frontend(wanted).where("pair = 'BTC-USD'").first()
    assert tuple(front) == ("BTC-USD", "January 5, 2024 at 11:59:59 PM", "10.50", "0.1")


def test_bad_records_are_quarantined_with_a_reason(spark, folder):
    good = [message(seq=1), message(pair="x", extra={"a": 1})]
    bad = {
        "{bad": "malformed",
        "[]": "malformed",
        message(pair=None): "missing pair",
        message(pair=""): "missing pair",
        message(price_date=None): "missing price_date",
        message(close=None): "missing close",
        message(volume=None): "missing volume",
        message(close="n/a"): "bad close",
        message(volume="many"): "bad volume",
        message(volume="NaN"): "bad volume",
        message(price_date="soon"): "bad price_date",
        message(price_date="2024-01"): "bad price_date",
        message(price_date="2024-01-01T10"): "bad price_date",
    }
    put(folder, "m", *good, *bad)
    parsed = parse_ticks(
        spark.read.text(f"{folder}/m").select(
            "value",
            F.lit(None).cast("timestamp").alias("source_time"),
            F.lit(None).cast("bigint").alias("source_seq"),
        )
    )
    valid, rejected = split_valid(parsed)
    assert sorted(row["pair"] for row in valid.collect()) == ["btcusd", "x"]
    assert {row["raw"]: row["reason"] for row in rejected.collect()} == bad


def test_every_record_of_a_busy_batch_is_written(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    put(folder, "in/a", *[message(pair=f"p{i}") for i in range(30)])
    run(spark, f"{folder}/in", f"{folder}/store", f"{folder}/cp")
    assert read_delta(spark, f"{folder}/store").count() == 30
    assert read_quarantine(spark, f"{folder}/store").count() == 0


def test_order_restart_and_replay(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    inbox, root, checkpoint = f"{folder}/in", f"{folder}/store", f"{folder}/cp"
    times = {1: "01:00:00", 2: "02:00:00", 3: "03:00:00", 4: "04:00:00"}
    for number in (3, 1, 4, 2):
        put(folder, f"in/f{number}", message(close=str(number), at=times[number], seq=number), "{bad")
        run(spark, inbox, root, checkpoint)
    key = "btcusd_2024-01-01"
    assert closes(current_view(spark, root)) == {key: 4.0}
    assert closes(current_view(spark, root, "arrival")) == {key: 2.0}
    assert read_delta(spark, root).count() == 4
    assert read_quarantine(spark, root).count() == 4

    run(spark, inbox, root, checkpoint)
    assert read_delta(spark, root).count() == 4

    # The same files under a new checkpoint: logged again, nothing changes.
    run(spark, inbox, root, f"{folder}/cp2", maxFilesPerTrigger="1")
    assert read_delta(spark, root).select("run").distinct().count() == 2
    assert closes(current_view(spark, root)) == {key: 4.0}

    # The second run's last batch stays in the log, everything else is folded.
    before = rows(current_view(spark, root, "arrival"))
    compact(spark, root)
    folded = _manifest_head(spark, root)["folded"]
    assert sorted(folded.values()) == [2, 2]
    assert rows(current_view(spark, root, "arrival")) == before
    assert closes(current_view(spark, root)) == {key: 4.0}
    compact(spark, root)
    assert _manifest_head(spark, root)["folded"] == folded
    assert rows(current_view(spark, root, "arrival")) == before

    put(folder, "in/f9", message(close="9", at="09:00:00", seq=9))
    run(spark, inbox, root, checkpoint)
    assert closes(current_view(spark, root)) == {key: 9.0}


def test_a_retried_batch_replaces_its_own_rows(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    put(folder, "in/a", *[message(pair=f"p{i}") for i in range(5)])
    query = run(spark, f"{folder}/in", f"{folder}/store", f"{folder}/cp")
    # Forget that batch 0 was committed, as after a crash before the commit.
    commit = tmp_path / "cp" / "commits" / "0"
    commit.unlink()
    (tmp_path / "cp" / "commits" / ".0.crc").unlink()
    again = run(spark, f"{folder}/in", f"{folder}/store", f"{folder}/cp")
    assert again.id == query.id and again.lastProgress.batchId == 0
    assert read_delta(spark, f"{folder}/store").count() == 5


def test_batch_and_stream_meet_under_one_key(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    root = f"{folder}/store"
    base = spark.createDataFrame(
        [("btcusd", dt.date(2024, 1, d), float(d), 1.0, dt.datetime(2024, 1, d, 12)) for d in (1, 2, 3)],
        "pair string, price_date date, close double, volume double, event_time timestamp",
    )
    write_base(base, root)
    put(
        folder,
        "in/a",
        message(day="2024-01-02", close="20", at="13:00:00"),
        message(day="2024-01-03", close="30", at="11:00:00"),
        message(day="2024-01-04", close="40"),
    )
    run(spark, f"{folder}/in", root, f"{folder}/cp")
    keys = [f"btcusd_2024-01-0{d}" for d in (1, 2, 3, 4)]
    assert closes(current_view(spark, root)) == dict(zip(keys, (1.0, 20.0, 3.0, 40.0)))
    assert closes(current_view(spark, root, "arrival")) == dict(zip(keys, (1.0, 20.0, 30.0, 40.0)))
    kinds = {r["price_date"].day: r["volume_kind"] for r in current_view(spark, root).collect()}
    assert kinds == {1: "last_bar", 2: "rolling_24h", 3: "last_bar", 4: "rolling_24h"}


def test_a_batch_reload_keeps_what_was_streamed(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    root = f"{folder}/store"
    schema = "pair string, price_date date, close double, volume double, event_time timestamp"

    def load(close, hour):
        at = dt.datetime(2024, 1, 1, hour)
        write_base(spark.createDataFrame([("btcusd", at.date(), close, 1.0, at)], schema), root)

    load(1.0, 9)
    for name, at in (("a", "10:00:00"), ("b", "11:00:00")):
        put(folder, f"in/{name}", message(close=at[:2], at=at), message(pair="x", at=at, close="5"))
        run(spark, f"{folder}/in", root, f"{folder}/cp")
    compact(spark, root)
    folded = _manifest_head(spark, root)["folded"]
    load(2.0, 10)
    assert _manifest_head(spark, root)["folded"] == folded
    keys = ("btcusd_2024-01-01", "x_2024-01-01")
    assert closes(current_view(spark, root)) == dict(zip(keys, (11.0, 5.0)))
    load(3.0, 12)
    assert closes(current_view(spark, root)) == dict(zip(keys, (3.0, 5.0)))
    assert closes(current_view(spark, root, "arrival")) == dict(zip(keys, (11.0, 5.0)))


def test_compaction_keeps_both_orders(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    root = f"{folder}/store"
    for name, at in (("a", "05:00:00"), ("b", "04:00:00"), ("c", "03:00:00")):
        put(folder, f"in/{name}", message(close=at[1], at=at))
        run(spark, f"{folder}/in", root, f"{folder}/cp")
    compact(spark, root)
    assert read_base(spark, root).count() == 2
    key = "btcusd_2024-01-01"
    assert closes(current_view(spark, root)) == {key: 5.0}
    assert closes(current_view(spark, root, "arrival")) == {key: 3.0}


def test_fan_out_reads_once_and_writes_both(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    feed = [
        {"type": "ticker", "product_id": "BTC-USD", "sequence": i, "price": str(i), "volume_24h": "5",
         "last_size": "1", "time": "2024-01-05T10:00:00Z"}
        for i in range(40)
    ]
    put(folder, "in/a", *[json.dumps(item) for item in feed], '{"type":"error"}')
    stream = ticker_only(parse_feed(read_ticks(spark, "text", path=f"{folder}/in")))
    (tmp_path / "queue").mkdir()
    outputs = {
        "backend": (to_backend, parquet_batches(f"{folder}/backend")),
        "frontend": (to_frontend, parquet_batches(f"{folder}/frontend")),
        "queue": (to_backend, queue_batches({"path": f"{folder}/queue/m"}, "json")),
    }
    fan_out(stream, outputs, f"{folder}/cp", NOW).awaitTermination()
    back, front = (spark.read.parquet(f"{folder}/{name}") for name in ("backend", "frontend"))
    assert back.count() == front.count() == 40
    assert {row[0] for row in back.select("pair").distinct().collect()} == {"btcusd"}
    assert {row[0] for row in front.select("volume").distinct().collect()} == {"1"}
    queued = spark.read.json(f"{folder}/queue/m")
    assert queued.count() == 40 and queued.first()["key"] == "btcusd"
    assert json.loads(queued.first()["value"])["volume_kind"] == "rolling_24h"


def test_published_ticks_can_be_consumed(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "topic").mkdir()
    feed = {"type": "ticker", "product_id": "BTC-USD", "sequence": 4, "price": "10.5",
            "volume_24h": "5", "last_size": "1", "time": "2024-01-05T10:00:00.123456Z"}
    put(folder, "in/a", json.dumps(feed))
    ticks = to_backend(ticker_only(parse_feed(read_ticks(spark, "text", path=f"{folder}/in"))))
    write_ticks(ticks, "text", {"path": f"{folder}/topic"}, f"{folder}/cp1", NOW).awaitTermination()
    run(spark, f"{folder}/topic", f"{folder}/store", f"{folder}/cp2")
    row = current_view(spark, f"{folder}/store").first()
    assert (row["pair_date"], row["close"], row["volume"], row["seq"]) == (
        "btcusd_2024-01-05", 10.5, 5.0, 4)
    assert row["event_time"].microsecond == 123456


def test_four_text_fields_are_enough(spark, folder, tmp_path):
    """A payload without order fields falls back to when its file was written."""
    (tmp_path / "in").mkdir()
    plain = {"pair": "btcusd", "price_date": "2024-01-01", "close": "1", "volume": "2"}
    put(folder, "in/a", json.dumps(plain))
    run(spark, f"{folder}/in", f"{folder}/store", f"{folder}/cp")
    assert closes(current_view(spark, f"{folder}/store")) == {"btcusd_2024-01-01": 1.0}


def test_messages_carry_their_key(spark):
    frame = spark.createDataFrame([("p", 1.0)], "pair string, close double")
    assert tuple(to_messages(frame).first()) == ("p", '{"pair":"p","close":1.0}')


def test_stream_board_equals_batch_board(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    sizes = {"p8": 8, "p9": 9, "p10": 10, "p25": 25}
    sent = [
        message(pair=pair, at=f"00:{i:02d}:00", seq=i) for pair, n in sizes.items() for i in range(n)
    ]
    order = sorted(range(len(sent)), key=lambda i: i * 37 % len(sent))
    for part in range(4):
        put(folder, f"in/f{part}", *[sent[i] for i in order[part::4]])
        valid, _ = split_valid(parse_ticks(read_ticks(spark, "text", path=f"{folder}/in")))
        latest_n_stream(valid, f"{folder}/board", f"{folder}/cp", trigger=NOW).awaitTermination()
    columns = ["pair", "rank", "seq"]
    board = read_board(spark, f"{folder}/board").select(*columns)
    messages = spark.read.text(f"{folder}/in").select(
        "value",
        F.lit(None).cast("timestamp").alias("source_time"),
        F.lit(None).cast("bigint").alias("source_seq"),
    )
    want = latest_n(split_valid(parse_ticks(messages))[0]).select(*columns)
    assert rows(board) == rows(want) and board.count() == 35

    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        latest_n_stream(valid, f"{folder}/board", f"{folder}/cp2", trigger=NOW).awaitTermination()


def test_kafka_is_named_with_its_defaults(spark, monkeypatch):
    """The connector is not installed here; only its options can be checked."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self, path=None):
            return spark.createDataFrame(
                [("k", bytearray(b"{}"), dt.datetime(2024, 1, 1), 5)],
                "key string, value binary, timestamp timestamp, offset long",
            )

    class Session:
        readStream = Reader()

    got = read_ticks(Session(), options={"subscribe": "ticks"})
    assert got.columns == ["value", "source_time", "source_seq"]
    assert seen == {"format": "kafka", "subscribe": "ticks", "startingOffsets": "latest"}
    assert (got.first()["value"], got.first()["source_seq"]) == ("{}", 5)


def test_board_merge_does_not_depend_on_how_ticks_are_cut(spark):
    schema = "pair string, event_time timestamp, seq long, close double, volume double"
    start = dt.datetime(2024, 1, 1)
    data = [
        (f"p{i % 3}", start + dt.timedelta(seconds=i * 7 % 20), i, float(i), 1.0) for i in range(60)
    ]
    whole = rows(merge_board(None, spark.createDataFrame(data, schema)))
    for cut in (1, 5, 17, 40):
        board = None
        for part in (data[:cut], data[cut:50], data[50:]):
            board = merge_board(board, spark.createDataFrame(part, schema))
        assert rows(board) == whole


def test_last_write_wins_as_a_streaming_aggregate(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    for number in (2, 3, 1):
        put(folder, f"in/f{number}", message(close=str(number), seq=number), message(pair="x", seq=9))
    stream = read_ticks(spark, "text", {"maxFilesPerTrigger": "1"}, f"{folder}/in")
    valid, _ = split_valid(parse_ticks(stream))
    seen = {}

    def keep(batch_df, batch):
        seen.update({row["pair"]: row["close"] for row in batch_df.collect()})

    query = (
        latest_by_key(valid.drop("arrived_at"), ["pair", "price_date"])
        .writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/cp")
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    assert seen == {"btcusd": 3.0, "x": 1.5}


def test_the_ticks_of_one_day_are_written_by_several_tasks(spark, folder, tmp_path):
    inbox = tmp_path / "in"
    spark.range(40_000).selectExpr(
        "to_json(named_struct('pair', concat('p', id), 'price_date', '2024-01-05', 'close', '1.5', "
        "'volume', '1', 'event_time', '2024-01-05T01:00:00Z', 'seq', id)) as value"
    ).write.text(str(inbox))
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advisory, "64k")
    try:
        stream = parse_ticks(read_ticks(spark, "text", path=str(inbox)))
        start_upsert(stream, f"{folder}/store", f"{folder}/cp", NOW).awaitTermination()
    finally:
        spark.conf.unset(advisory)
    delta = read_delta(spark, f"{folder}/store")
    assert delta.count() == 40_000 and len(delta.inputFiles()) > 1
