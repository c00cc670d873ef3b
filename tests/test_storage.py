"""Rejects, stored keys, buckets, folders, footers and replaced tables."""

import json

import pytest
from pyspark.sql import functions as F

from pricelake.operators import build_daily, price_history, select_products
from pricelake.operators.batch import REASONS
from pricelake.plans import (
    batch_rows,
    build_batch_with_rejects,
    current_view,
    read_accepted,
    read_rejects,
    stored_key_range,
    write_base,
)
from pricelake.plans.build import by_shard, write_shards
from pricelake.plans.registered_storage import lake_product_list
from pricelake.schemas import SERVING
from pricelake.sources import (
    footers_only,
    read_combined,
    read_combined_lines,
    read_lake,
    table_location,
    write_bucketed,
    write_lake,
    write_table,
)
from pricelake.streaming import parse_ticks, read_ticks, start_upsert
from tests.conftest import plan, rows
from tests.test_streaming import message, put

SF_DIR = "/root/testdata/sf0.001"
GOOD = ["btc,1364774820000,93.25,93.3,93.3,93.25,93.3", "eth,1364774880000.0,1,2,3,4,5", "x,-5,1,,3,4,5"]
BAD = {
    "header row": ["pair,time,open,close,high,low,volume"] * 2,
    "unreadable line": ["btc,1364774820000,abc,1,1,1,1", "btc,1364774820000,1,1,1,1", "btc,1,1,1,1,1,1,1", "btc"],
    "missing pair": [",1364774820000,1,1,1,1,1", "  ,1364774820000,1,1,1,1,1"],
    "missing time": ["btc,,1,1,1,1,1", "btc, ,1,1,1,1,1"],
    "bad time": ["btc,12x,1,1,1,1,1", "btc,99999999999999999,1,1,1,1,1", "btc,2024-01-01,1,1,1,1,1"],
}


def checked(spark, tmp_path, lines):
    put(tmp_path, "lines.csv", *lines)
    path = str(tmp_path / "out")
    return build_batch_with_rejects(read_combined_lines(spark, str(tmp_path / "lines.csv")), path), path


def test_rejects_are_told_apart_and_counted(spark, tmp_path):
    lines = [*GOOD, "", *(line for some in BAD.values() for line in some), "   "]
    counts, path = checked(spark, tmp_path, lines)
    assert counts.rejected == {reason: len(BAD[reason]) for reason in REASONS}
    assert counts.accepted == len(GOOD)
    assert counts.read == counts.accepted + sum(counts.rejected.values())
    assert rows(read_rejects(spark, path)) == sorted(
        ((raw, reason) for reason, some in BAD.items() for raw in some), key=lambda r: [str(v) for v in r]
    )
    put(tmp_path, "good.csv", *GOOD)
    plain = batch_rows(read_combined(spark, str(tmp_path / "good.csv"), header=False))
    assert rows(read_accepted(spark, path)) == rows(plain)


@pytest.mark.parametrize("lines", [[], GOOD, BAD["bad time"]])
def test_one_outcome_only(spark, tmp_path, lines):
    counts, path = checked(spark, tmp_path, lines)
    assert counts.read == len(lines)
    assert read_accepted(spark, path).count() == counts.accepted
    assert read_rejects(spark, path).count() == sum(counts.rejected.values())


def test_rejects_take_one_pass_and_no_sort(spark, tmp_path):
    put(tmp_path, "lines.csv", *GOOD)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    _, path = checked(spark, tmp_path, GOOD)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    text = plan(read_accepted(spark, path))
    assert "PartitionFilters: [isnotnull(outcome" in text and "raw" not in text.split("ReadSchema")[1]


def daily_rows(spark, pairs, days=20):
    made = [
        (pair, f"2024-01-{day:02d}", float(day), 1.0, day)
        for pair in pairs
        for day in range(1, days + 1)
    ]
    return spark.createDataFrame(made, "pair string, day string, close double, volume double, seq bigint").select(
        "pair", F.to_date("day").alias("price_date"), "close", "volume", "seq"
    )


def test_key_range_is_pushed_into_the_scan(spark, folder):
    pairs = ["a", "a b", "a_b", "A", "b", "é"]
    write_base(daily_rows(spark, pairs), folder)
    got = stored_key_range(spark, folder, "a_2024-01-03", "a_2024-01-08")
    text = plan(got)
    assert "GreaterThanOrEqual(pair_date,a_2024-01-03)" in text and "LessThan(pair_date,a_2024-01-08)" in text
    history = price_history(current_view(spark, folder), "a", "2024-01-03", "2024-01-07")
    assert rows(got.select("pair", "price_date", "close", "volume")) == rows(history)
    everything = current_view(spark, folder)
    for start, stop in (("a", "b"), ("a b_2024-01-15", "a_2024-01-05"), ("", "\U0010ffff"), ("b", "a")):
        want = everything.where((F.col("pair_date") >= start) & (F.col("pair_date") < stop))
        found = [r["pair_date"] for r in stored_key_range(spark, folder, start, stop).collect()]
        assert found == sorted(found, key=str.encode)
        assert sorted(found) == sorted(r["pair_date"] for r in want.collect())


def test_key_range_of_snapshot_and_stream(spark, folder, tmp_path):
    root = f"{folder}/store"
    write_base(daily_rows(spark, ["btcusd"], 3), root)
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    put(inbox, "1", message(day="2024-01-03", close="7"), message(day="2024-01-04", close="8"))
    stream = parse_ticks(read_ticks(spark, "text", path=str(inbox)))
    start_upsert(stream, root, f"{folder}/cp", {"availableNow": True}).awaitTermination()
    got = stored_key_range(spark, root, "btcusd_2024-01-02", "btcusd_2024-01-09")
    assert [(r["pair_date"][-2:], r["close"]) for r in got.collect()] == [("02", 2.0), ("03", 7.0), ("04", 8.0)]


def test_key_range_of_a_snapshot_without_keys(spark, folder):
    """As earlier versions wrote it: neither the column nor its mark in the manifest."""
    stored = daily_rows(spark, ["a", "b"], 4)
    columns = [
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in stored.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in SERVING.fields
    ]
    write_shards(by_shard(stored.select(*columns), "pair", "price_date"), f"{folder}/base/1-x")
    entry = json.dumps({"version": 1, "path": f"{folder}/base/1-x", "folded": {}})
    spark.createDataFrame([(entry,)], "value string").write.text(f"{folder}/manifest/v=1")
    got = stored_key_range(spark, folder, "a_2024-01-02", "b_2024-01-02")
    assert [r["pair_date"] for r in got.collect()] == ["a_2024-01-02", "a_2024-01-03", "a_2024-01-04", "b_2024-01-01"]


def test_key_range_needs_a_store(spark, folder):
    with pytest.raises(ValueError, match="no store"):
        stored_key_range(spark, f"{folder}/none", "a", "b")


def bars_of(spark, pairs=("a", "b", "c"), days=5):
    return spark.createDataFrame(
        [(p, 1_700_000_000_000 + 3_600_000 * i, 1.0, float(i), 2.0, 0.0, 3.0) for p in pairs for i in range(24 * days)],
        "pair string, time bigint, open double, close double, high double, low double, volume double",
    )


def test_bucketed_table_needs_no_exchange(spark, folder):
    batch = batch_rows(bars_of(spark))
    stored = write_bucketed(batch, "bucketed_test", f"{folder}/b", 4)
    got = build_daily(stored)
    assert "Exchange" not in plan(got) and "Bucketed: true" in plan(got)
    assert rows(got) == rows(build_daily(batch))
    assert "Exchange" not in plan(stored.groupBy("pair").agg(F.max("close")))


def test_a_list_in_a_table_prunes_the_lakes_folders(spark, folder):
    write_lake(bars_of(spark), f"{folder}/lake", regroup=True)
    products = [("a", 5), ("b", 50), ("z", 5)]
    spark.createDataFrame(products, "product_id string, ticks int").write.parquet(f"{folder}/list")
    listed = spark.read.parquet(f"{folder}/list").where("ticks < 10")
    lake = read_lake(spark, f"{folder}/lake").withColumnRenamed("pair", "product_id")
    got = select_products(lake, listed)
    assert {r["product_id"] for r in got.collect()} == {"a"} and got.count() == 120
    assert "dynamicpruning" in plan(got) and "dynamicpruning" in plan(lake_product_list(spark, SF_DIR))


def test_counts_and_spans_come_from_footers(spark, folder):
    write_lake(bars_of(spark), f"{folder}/lake", regroup=True)
    lake = read_lake(footers_only(spark), f"{folder}/lake")
    got = lake.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("a"), F.max("time").alias("z"))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(1)" in text or "PushedAggregation: [COUNT(*)" in text, text
    first, last = 1_700_000_000_000, 1_700_000_000_000 + 3_600_000 * 119
    assert rows(got) == [(p, 120, first, last) for p in "abc"]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_a_replace_that_stops_leaves_the_old_table(spark, folder, monkeypatch):
    old, new = spark.range(3), spark.range(10)
    write_table(old, "replaced_test", f"{folder}/1")
    with monkeypatch.context() as patch:

        def stop(session, statement, *args, **more):
            raise KeyboardInterrupt(statement)

        patch.setattr(type(spark), "sql", stop)
        with pytest.raises(KeyboardInterrupt, match="ALTER TABLE"):
            write_table(new, "replaced_test", f"{folder}/2")
    assert spark.table("replaced_test").count() == 3
    assert write_table(new, "replaced_test", f"{folder}/3").count() == 10
    assert table_location(spark, "replaced_test").endswith(f"{folder}/3")
    with pytest.raises(ValueError, match="holds"):
        write_table(spark.range(2).toDF("other"), "replaced_test", f"{folder}/4")
    assert spark.table("replaced_test").count() == 10
    spark.sql("DROP TABLE replaced_test")
