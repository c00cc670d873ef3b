import datetime as dt
import random

import pytest
from tests.conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelake.operators import (
    build_daily,
    build_full,
    closing_rows,
    expand_time,
    format_row,
    from_cells,
    key_range_scan,
    latest_by_either_order,
    latest_by_key,
    latest_n,
    price_history,
    to_cells,
)
from pricelake.plans import (
    compact,
    current_view,
    read_base,
    read_full,
    stored_history,
    write_base,
    write_full,
)
from pricelake.plans.store import _manifest_head

BARS = "pair string, time long, open double, close double, high double, low double, volume double"
MINUTE = 60_000
DAY = 86_400_000
START = 1_704_067_200_000  # 2024-01-01T00:00:00Z


def bars(spark, *items):
    data = [(p, START + at, c, c, c, c, v) for p, at, c, v in items]
    return expand_time(spark.createDataFrame(data, BARS))


def test_daily_close_takes_the_last_bar_of_the_day(spark):
    batch = bars(
        spark, ("p", DAY - 1, 3.0, 1.0), ("p", 0, 9.0, 8.0), ("p", DAY, 4.0, 2.0), ("q", 5, 1.0, 1.0)
    )
    assert rows(build_daily(batch)) == [
        ("p_2024-01-01", "p", dt.date(2024, 1, 1), 3.0, 1.0),
        ("p_2024-01-02", "p", dt.date(2024, 1, 2), 4.0, 2.0),
        ("q_2024-01-01", "q", dt.date(2024, 1, 1), 1.0, 1.0),
    ]


def test_ties_are_picked_the_same_way_every_time(spark):
    items = [("p", 0, float(i % 7), float(i)) for i in range(50)]
    for _ in range(3):
        random.shuffle(items)
        picked = build_daily(bars(spark, *items).repartition(5)).first()
        assert (picked["close"], picked["volume"]) == (6.0, 48.0)


def test_rows_without_key_are_not_served(spark):
    data = [(None, START, 1.0), ("p", None, 1.0), ("p", START, 2.0)]
    frame = spark.createDataFrame(data, "pair string, time long, close double")
    for name in ("open", "high", "low", "volume"):
        frame = frame.withColumn(name, F.lit(0.0))
    batch = expand_time(frame)
    assert build_daily(batch).count() == 1
    assert build_full(batch).count() == 1


def test_full_rows_collapse_to_the_second(spark):
    batch = bars(spark, ("p", 100, 1.0, 1.0), ("p", 900, 2.0, 1.0), ("p", 1000, 3.0, 1.0))
    got = build_full(batch)
    assert got.columns[0] == "pair_date_time"
    assert [(row["pair_date_time"], row["close"]) for row in got.orderBy("pair_date_time").collect()] == [
        ("p_2024-01-01_00:00:00", 2.0),
        ("p_2024-01-01_00:00:01", 3.0),
    ]


def test_window_and_aggregate_agree(spark):
    data = [(f"p{i % 5}", i * 7919 % 1000, i) for i in range(2000)]
    frame = spark.createDataFrame(data, "pair string, event_time long, seq long")
    a = closing_rows(frame, ["pair"], ["event_time", "seq"])
    b = latest_by_key(frame, ["pair"])
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5)), min_size=1, max_size=30), st.randoms())
def test_last_write_wins_in_any_order(spark, items, rng):
    ticks = [(pair, at, i, float(i)) for i, (pair, at) in enumerate(items)]
    want = {}
    for tick in ticks:
        want[tick[0]] = max(want.get(tick[0], tick), tick, key=lambda t: (t[1], t[2]))
    rng.shuffle(ticks)
    frame = spark.createDataFrame(ticks, "pair string, event_time long, seq long, close double")
    assert rows(latest_by_key(frame, ["pair"])) == sorted(want.values())


def test_reduction_keeps_the_winner_of_either_order(spark):
    data = [("p", 1, 9, 3, 0), ("p", 9, 1, 1, 0), ("p", 5, 5, 2, 0), ("q", 1, 1, 1, 0)]
    frame = spark.createDataFrame(
        data, "pair string, event_time long, seq long, arrived_at long, batch long"
    )
    reduced = latest_by_either_order(frame, ["pair"])
    assert rows(reduced) == sorted([data[0], data[1], data[3]])
    for order in ("event_time", "arrival"):
        assert rows(latest_by_key(reduced, ["pair"], order)) == rows(
            latest_by_key(frame, ["pair"], order)
        )
    with pytest.raises(ValueError):
        latest_by_key(frame, ["pair"], "size")


def test_cells_take_the_newest_version_and_miss_nothing(spark):
    cells = spark.createDataFrame(
        [
            ("k1", "cf:close", "1", 1),
            ("k1", "cf:close", "2", 2),
            ("k1", "cf:volume", "7", 1),
            ("k2", "cf:volume", "8", 1),
            ("k2", "cf:other", "9", 9),
        ],
        "key string, column string, value string, version long",
    )
    assert rows(from_cells(cells, ["close", "volume"])) == [("k1", "2", "7"), ("k2", None, "8")]


def test_cells_round_trip(spark):
    wide = spark.createDataFrame(
        [("k1", "a", 1.5, 1), ("k2", None, 2.5, 1)], "key string, pair string, close double, version long"
    )
    cells = to_cells(wide, "key", ["pair", "close"], version="version")
    assert cells.count() == 3
    assert rows(cells.select("column").distinct()) == [("cf:close",), ("cf:pair",)]
    back = from_cells(cells, ["pair", "close"])
    assert rows(back.withColumn("close", F.col("close").cast("double"))) == rows(wide.drop("version"))


DAILY = "pair string, price_date date, close double, volume double"


def daily(spark, pairs=("p",), days=5):
    data = [(p, dt.date(2024, 1, d + 1), float(d), 1.0) for p in pairs for d in range(days)]
    return spark.createDataFrame(data, DAILY)


def test_lookup_bounds(spark):
    frame = daily(spark)

    def days(start, end, pair="p"):
        return [row["price_date"].day for row in price_history(frame, pair, start, end).collect()]

    assert days("2024-01-01", "2024-01-05") == [1, 2, 3, 4, 5]
    assert days("2024-01-02", "2024-01-02") == [2]
    assert days(dt.date(2024, 1, 4), "2025-01-01") == [4, 5]
    assert days("2024-01-04", "2024-01-02") == []
    assert days("2024-01-01", "2024-01-05", "nobody") == []


@pytest.mark.parametrize(
    "pair,start,end",
    [
        ("", "2024-01-01", "2024-01-02"),
        ("p", None, "2024-01-02"),
        ("p", "2024-01-01", ""),
        ("p", "2024-1-5", "2024-01-06"),
        ("p", "2024-01-01", "2024-02-30"),
    ],
)
def test_lookup_refuses_bad_parameters(spark, pair, start, end):
    with pytest.raises(ValueError):
        price_history(daily(spark), pair, start, end)


def test_key_range_is_half_open(spark):
    frame = daily(spark, ("btc", "btc1", "btcusd")).withColumn(
        "pair_date", F.concat_ws("_", "pair", "price_date")
    )

    def keys(start, stop):
        return [row["pair_date"] for row in key_range_scan(frame, "pair_date", start, stop).collect()]

    assert keys("btc_2024-01-04", "btc_2024-01-05") == ["btc_2024-01-04"]
    assert keys("btc_2024-01-04", "btc_2024-01-05\x00") == ["btc_2024-01-04", "btc_2024-01-05"]
    typed = price_history(frame, "btc", "2024-01-01", "2024-01-05")
    assert typed.count() == len(keys("btc_2024-01-01", "btc_2024-01-05\x00")) == 5


def test_display_rows_are_text(spark):
    got = format_row(price_history(daily(spark), "p", "2024-01-02", "2024-01-02")).first()
    assert tuple(got) == ("p", "2024-01-02", "1.0", "1.0")


def test_latest_nine(spark):
    data = [(f"p{n}", i, i, 1.0, 1.0) for n in (8, 9, 10, 25) for i in range(n)]
    frame = spark.createDataFrame(
        data, "pair string, event_time long, seq long, close double, volume double"
    )
    got = latest_n(frame.repartition(7))
    counts = {row["pair"]: row["count"] for row in got.groupBy("pair").count().collect()}
    assert counts == {"p8": 8, "p9": 9, "p10": 9, "p25": 9}
    newest = got.where("pair = 'p25'").orderBy("rank").collect()
    assert [row["seq"] for row in newest] == list(range(24, 15, -1))
    assert [row["rank"] for row in newest] == list(range(1, 10))


def test_store_without_stream(spark, folder):
    assert current_view(spark, folder).count() == 0
    assert read_base(spark, folder) is None
    odd = spark.createDataFrame(
        [("007", dt.date(2024, 1, 1), 1.0, 1.0), ("a/b=c%", dt.date(2024, 1, 1), 1.0, 1.0), (None, None, 1.0, 1.0)],
        DAILY,
    )
    assert write_base(daily(spark, ("p", "q")).unionByName(odd), folder) == 1
    view = current_view(spark, folder)
    assert view.count() == 12 and view.where("pair = '007'").count() == 1
    assert {row[0] for row in view.select("volume_kind").distinct().collect()} == {"last_bar"}
    before = rows(view)
    assert compact(spark, folder) == 2
    assert rows(current_view(spark, folder)) == before
    for pair, count in (("p", 5), ("a/b=c%", 1), ("007", 1), ("nobody", 0)):
        assert stored_history(spark, folder, pair, "2024-01-01", "2024-01-31").count() == count
        assert current_view(spark, folder, pair=pair).count() == count
    assert _manifest_head(spark, folder)["version"] == 2


def test_a_batch_reload_replaces_its_own_keys_only(spark, folder):
    write_base(daily(spark, ("p", "q"), 3), folder)
    again = daily(spark, ("p", "z"), 2).withColumn("close", F.col("close") + 100)
    assert write_base(again, folder) == 2
    closes = {row["pair_date"]: row["close"] for row in current_view(spark, folder).collect()}
    assert closes == {
        "p_2024-01-01": 100.0,
        "p_2024-01-02": 101.0,
        "p_2024-01-03": 2.0,
        "q_2024-01-01": 0.0,
        "q_2024-01-02": 1.0,
        "q_2024-01-03": 2.0,
        "z_2024-01-01": 100.0,
        "z_2024-01-02": 101.0,
    }
    # Lower prices replace as well: it is the load that counts.
    write_base(daily(spark, ("p",), 1), folder)
    assert stored_history(spark, folder, "p", "2024-01-01", "2024-01-01").first()["close"] == 0.0
    assert write_base(daily(spark).where("false"), folder) == 4
    assert current_view(spark, folder).count() == 8


def test_an_empty_store_can_be_read(spark, folder):
    write_base(daily(spark).where("false"), folder)
    assert current_view(spark, folder).count() == 0
    assert stored_history(spark, folder, "p", "2024-01-01", "2024-01-02").count() == 0


def test_minute_table_is_stored_by_shard(spark, folder):
    items = [(f"p{n}", minute * MINUTE, 1.0, 1.0) for n in range(40) for minute in range(30)]
    batch = bars(spark, *items, ("p7", 10, 2.0, 1.0))
    write_full(batch, folder + "/full")
    stored = read_full(spark, folder + "/full")
    assert rows(stored) == rows(build_full(batch)) and stored.count() == 1200
    one = read_full(spark, folder + "/full", "p7")
    assert one.count() == 30 and one.where("close = 2.0").count() == 1
    assert len({file.rsplit("/", 1)[0] for file in one.inputFiles()}) == 1
    assert read_full(spark, folder + "/full", "nobody").count() == 0


def test_store_lookup_equals_the_view(spark, folder):
    frame = daily(spark, [f"p{n}" for n in range(50)], 20)
    write_base(frame, folder)
    found = stored_history(spark, folder, "p7", "2024-01-03", "2024-01-04")
    assert rows(found) == rows(price_history(current_view(spark, folder), "p7", "2024-01-03", "2024-01-04"))
    assert found.count() == 2
