"""All steps in sequence, as a user of the jobs runs them."""

import json

import pytest

from pricelake import jobs
from pricelake.plans import read_accepted, write_base
from pricelake.streaming import read_arrival_board, read_board

HEADER = "time,open,close,high,low,volume"
MINUTE = 60_000
START = 1_704_067_200_000


def test_files_to_lookup(spark, tmp_path, capsys):
    files, inbox = tmp_path / "files", tmp_path / "in"
    files.mkdir()
    inbox.mkdir()
    for pair, price in (("btcusd", 100), ("ethusd", 10)):
        lines = [HEADER]
        for minute in range(3 * 1440):
            lines.append(f"{START + minute * MINUTE},{price},{price + minute},9,1,{minute}")
        (files / f"{pair}.csv").write_text("\n".join(lines) + "\n")
    tick = dict(pair="btcusd", price_date="2024-01-04", close="7.5", volume="1",
                event_time="2024-01-04T01:00:00Z", seq=1)
    (inbox / "a").write_text(json.dumps(tick) + "\n")

    def run(*argv):
        jobs.run(spark, [str(arg) for arg in argv])
        return capsys.readouterr().out

    run("lake", files, tmp_path / "lake")
    run("batch", tmp_path / "lake", tmp_path / "batch")
    run("full", tmp_path / "batch", tmp_path / "full")
    run("daily", tmp_path / "batch", tmp_path / "store")
    run("stream", tmp_path / "store", tmp_path / "cp", "--inbox", inbox, "--once")
    run("board", tmp_path / "board", tmp_path / "cp2", "--inbox", inbox, "--once")
    assert read_board(spark, str(tmp_path / "board")).count() == 1
    run("compact", tmp_path / "store")
    assert spark.read.parquet(str(tmp_path / "full")).count() == 2 * 3 * 1440
    out = run("lookup", tmp_path / "store", "btcusd", "2024-01-02", "2024-01-31", "--peek", "9")
    shown = [[cell.strip() for cell in line.strip("|").split("|")] for line in out.splitlines() if "2024" in line]
    assert shown == [
        ["btcusd", "2024-01-02", str(100.0 + 2 * 1440 - 1), str(2 * 1440 - 1.0)],
        ["btcusd", "2024-01-03", str(100.0 + 3 * 1440 - 1), str(3 * 1440 - 1.0)],
        ["btcusd", "2024-01-04", "7.5", "1.0"],
    ]
    assert "ethusd" in run("pairs", files, "--peek", "5")
    run("pairs", files, "--out", tmp_path / "listed")
    assert spark.read.csv(str(tmp_path / "listed"), header=True).count() == 2
    with pytest.raises(ValueError):
        run("lookup", tmp_path / "store", "btcusd", "2024-1-2", "2024-01-31", "--peek", "9")
    with pytest.raises(SystemExit):
        run("pairs", files)


def test_a_long_lookup_is_written_whole(spark, tmp_path):
    days = spark.range(1500).selectExpr(
        "'p' as pair", "date_add(date'2020-01-01', cast(id as int)) as price_date",
        "cast(id as double) as close", "1.0D as volume",
    )
    write_base(days, str(tmp_path / "store"))
    argv = ["lookup", tmp_path / "store", "p", "2020-01-01", "2030-01-01", "--out", tmp_path / "out"]
    jobs.run(spark, [str(arg) for arg in argv])
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 1500


def test_feed_to_both_outputs(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    lines = [
        json.dumps(dict(type="ticker", product_id=product, time="2024-01-05T10:00:00Z", price="1",
                        volume_24h="2", last_size="3"))
        for product in ("BTC-USD", "ETH-USD", "DOGE-USD")
    ]
    (inbox / "a").write_text("\n".join([*lines, '{"type":"heartbeat"}', '{"other": 1}', "{broken", "no json"]) + "\n")
    argv = ["feed", tmp_path / "out", tmp_path / "cp", "--inbox", inbox, "--once",
            "--products", "BTC-USD", "ETH-USD"]
    jobs.run(spark, [str(arg) for arg in argv])
    for name, pairs in (("backend", {"btcusd", "ethusd"}), ("frontend", {"BTC-USD", "ETH-USD"})):
        stored = spark.read.parquet(str(tmp_path / "out" / name))
        assert {row["pair"] for row in stored.collect()} == pairs
    refused = spark.read.parquet(str(tmp_path / "out" / "quarantine"))
    assert sorted(row["raw"] for row in refused.collect()) == ["no json", "{broken"]


def test_text_source_and_second_variant(spark, tmp_path):
    text = tmp_path / "combined"
    text.mkdir()
    (text / "part.csv").write_text(f'pair,{HEADER}\n"a,b",{START},1,2,3,0.5,7\n')
    argv = ["batch", text, tmp_path / "batch", "--text", "--quoted", "--variant", "b"]
    for extra in ([], ["--if-not-exists"]):
        jobs.run(spark, [str(arg) for arg in [*argv, *extra]])
    row = spark.read.parquet(str(tmp_path / "batch")).first()
    assert (row["pair"], row["time"], row["close"]) == ("a,b", "2024-01-01 00:00:00", 2.0)


def test_rejects_expiry_and_arrivals(spark, tmp_path, capsys):
    def run(*argv):
        jobs.run(spark, [str(arg) for arg in argv])
        return capsys.readouterr().out

    text, inbox = tmp_path / "bars.csv", tmp_path / "in"
    inbox.mkdir()
    text.write_text(f"pair,{HEADER}\nbtc,{START},1,2,3,4,5\nbtc,never,1,2,3,4,5\n")
    out = run("batch", text, tmp_path / "batch", "--rejects")
    assert "read=3, accepted=1" in out and "'bad time': 1" in out
    assert read_accepted(spark, str(tmp_path / "batch")).count() == 1
    with pytest.raises(SystemExit):
        run("batch", text, tmp_path / "other", "--rejects", "--quoted")
    days = spark.sql("SELECT 'p' AS pair, DATE '2024-01-01' AS price_date, 1.0D AS close, 1.0D AS volume")
    for _ in range(3):
        write_base(days, str(tmp_path / "store"))
    assert "'base': 1" in run("expire", tmp_path / "store", "--rejects-older-than", "1")
    tick = dict(type="ticker", product_id="BTC-USD", time="2024-01-05T10:00:00Z", price="1", last_size="3", sequence=1)
    (inbox / "a").write_text(json.dumps(tick) + "\n")
    run("board", tmp_path / "board", tmp_path / "cp", "--inbox", inbox, "--once", "--arrival")
    assert read_arrival_board(spark, str(tmp_path / "board")).first()["price"] == "1"
