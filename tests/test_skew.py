"""Reductions against brute force where one key holds most of the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pricelake.operators import (
    build_daily,
    build_full,
    closing_rows,
    expand_time,
    from_cells,
    latest_by_key,
    latest_n,
    to_cells,
)
from pricelake.plans import read_full, write_full
from pricelake.plans.build import by_shard, read_sharded, write_shards
from pricelake.schemas import SERVING
from pricelake.sources import read_lake, write_lake
from tests.conftest import rows

START = 1_704_067_200_000
BARS = "pair string, time long, open double, close double, high double, low double, volume double, seq long"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    pairs = ["hot"] * 4 + [f"p{i}" for i in range(8)]
    # The hot pair repeats a single second too, so its key is hot as well.
    items = []
    for seq in range(6000):
        pair = rng.choice(pairs)
        at = 0 if pair == "hot" and rng.random() < 0.7 else rng.randrange(3 * 86_400_000)
        close = float(rng.randrange(50))
        items.append((pair, START + at, close, close, close, close, float(seq), seq))
    return items


@pytest.fixture(scope="module")
def bars(spark, data):
    return spark.createDataFrame(data, BARS).repartition(16)


def best(data, key, order):
    found = {}
    for item in data:
        name = key(item)
        if name not in found or order(item) > order(found[name]):
            found[name] = item
    return found


def day(item):
    return (item[0], dt.datetime.fromtimestamp(item[1] / 1000, dt.UTC).date())


def test_daily(bars, data):
    want = best(data, day, lambda item: (item[1], item[7]))
    got = build_daily(expand_time(bars))
    assert {(r["pair"], r["price_date"]): (r["close"], r["volume"]) for r in got.collect()} == {
        key: (item[3], item[6]) for key, item in want.items()
    }


def test_minute_rows_in_memory_and_stored(spark, bars, data, folder):
    want = best(data, lambda item: (item[0], item[1] // 1000), lambda item: (item[1], item[7]))
    batch = expand_time(bars)
    write_full(batch, folder + "/full")
    for got in (build_full(batch), read_full(spark, folder + "/full")):
        stored = {r["pair_date_time"]: (r["close"], r["volume"]) for r in got.collect()}
        assert len(stored) == len(want) and got.count() == len(want)
        assert sorted(stored.values()) == sorted((item[3], item[6]) for item in want.values())
    hot = read_full(spark, folder + "/full", "hot")
    assert hot.count() == sum(1 for key in want if key[0] == "hot")


def test_last_write_wins(bars, data):
    frame = bars.select("pair", F.col("time").alias("event_time"), "seq", "close")
    want = best(data, lambda item: item[0], lambda item: (item[1], item[7]))
    for got in (latest_by_key(frame, ["pair"]), closing_rows(frame, ["pair"], ["event_time", "seq"])):
        assert rows(got) == sorted((i[0], i[1], i[7], i[3]) for i in want.values())


def test_newest_nine(bars, data):
    frame = bars.select("pair", F.col("time").alias("event_time"), "seq")
    got = rows(latest_n(frame).select("pair", "rank", "seq"))
    want = []
    for pair in {item[0] for item in data}:
        mine = sorted((i for i in data if i[0] == pair), key=lambda i: (i[1], i[7]), reverse=True)
        want += [(pair, rank, item[7]) for rank, item in enumerate(mine[:9], 1)]
    assert sorted(got) == sorted(want)


def test_newest_cells(bars, data):
    cells = to_cells(bars.withColumnRenamed("pair", "key"), "key", ["close", "volume"], "seq")
    want = best(data, lambda item: item[0], lambda item: item[7])
    got = from_cells(cells, ["close", "volume"], version="seq").collect()
    assert {r["key"]: (float(r["close"]), float(r["volume"])) for r in got} == {
        key: (item[3], item[6]) for key, item in want.items()
    }


def test_nothing_is_lost_in_lake_and_shards(spark, bars, folder):
    combined = bars.drop("seq")
    write_lake(combined, folder + "/lake", regroup=True)
    assert rows(read_lake(spark, folder + "/lake").select(*combined.columns)) == rows(combined)
    serving = bars.select(
        *[
            (F.col(f.name) if f.name in bars.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SERVING.fields
        ]
    )
    write_shards(by_shard(serving, "pair", "seq"), folder + "/shards")
    assert rows(read_sharded(spark, folder + "/shards", SERVING)) == rows(serving)
    hot = read_sharded(spark, folder + "/shards", SERVING, "hot")
    assert hot.count() == serving.where("pair = 'hot'").count()
