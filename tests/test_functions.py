import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pricelake.functions import (
    day_key,
    display_time,
    minute_key,
    pair_from_path,
    pair_from_product,
    parse_time,
    stem_from_path,
)
from pricelake.operators import expand_time


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "product,pair",
    [
        ("BTC-USD", "btcusd"),
        ("BTC-USD-X", "btcusd-x"),
        ("BTCUSD", "btcusd"),
        ("eth-usd", "ethusd"),
        ("-A-B", "a-b"),
        (None, None),
    ],
)
def test_product_loses_its_first_hyphen_only(spark, product, pair):
    assert one(spark, product, pair_from_product) == pair


@pytest.mark.parametrize(
    "path,pair,stem",
    [
        ("file:///x/btcusd.csv", "btcusd", "btcusd"),
        ("file:///x/a.b.csv", "a", "a.b"),
        ("file:///x.y/a%20b.v1.csv", "a b", "a b.v1"),
        ("file:///x/a+b.csv", "a+b", "a+b"),
        ("file:///x/a%25b.csv", "a%b", "a%b"),
        ("/x/plain", "plain", "plain"),
    ],
)
def test_names_from_paths(spark, path, pair, stem):
    assert one(spark, path, pair_from_path) == pair
    assert one(spark, path, stem_from_path) == stem


@pytest.mark.parametrize("name", [".csv", "..csv", "a..csv", "a.", ".a.csv", "a", "a.b.c"])
def test_stems_are_those_of_splitext(spark, name):
    assert one(spark, f"/x/{name}", stem_from_path) == os.path.splitext(name)[0]


@pytest.mark.parametrize(
    "time,text",
    [
        ("1364774820000", "2013-04-01 00:07:00"),
        ("1364774820999", "2013-04-01 00:07:00"),
        ("1364774820000.0", "2013-04-01 00:07:00"),
        ("-1500", "1969-12-31 23:59:59"),
        ("-999", "1970-01-01 00:00:00"),
        ("", None),
        ("abc", None),
        (None, None),
        ("9223372036854775807", None),
    ],
)
def test_time_expansion(spark, time, text):
    row = expand_time(spark.createDataFrame([("p", time, 1.0)], "pair string, time string, close double"))
    got = row.first()
    assert got["full_timestamp"] == text
    assert got["price_date"] == (dt.date.fromisoformat(text[:10]) if text else None)
    assert got["price_time"] == (text[11:] if text else None)
    other = expand_time(
        spark.createDataFrame([("p", time, 1.0)], "pair string, time string, close double"), "b"
    ).first()
    assert (other["date"], other["time"]) == (got["price_date"], text)


def test_variant_must_be_known(spark):
    with pytest.raises(ValueError):
        expand_time(spark.createDataFrame([("1",)], "time string"), "c")


def test_day_changes_at_midnight_utc(spark):
    frame = spark.createDataFrame([(1704153599999,), (1704153600000,)], "time long")
    days = [row["price_date"] for row in expand_time(frame).collect()]
    assert days == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_keys_need_every_part(spark):
    frame = spark.createDataFrame(
        [("p", dt.date(2024, 1, 2), "00:00:01"), (None, dt.date(2024, 1, 2), "x"), ("p", None, "x")],
        "pair string, price_date date, price_time string",
    )
    columns = F.col("pair"), F.col("price_date"), F.col("price_time")
    got = frame.select(day_key(*columns[:2]), minute_key(*columns)).collect()
    assert tuple(got[0]) == ("p_2024-01-02", "p_2024-01-02_00:00:01")
    assert [tuple(row) for row in got[1:]] == [(None, None), (None, None)]


def test_display_and_parse(spark):
    def shown(value):
        return one(spark, value, lambda c: display_time(parse_time(c)))

    assert shown("2024-01-05T15:04:05.123456Z") == "January 5, 2024 at 03:04:05 PM"
    assert shown("2024-12-31T23:30:00-02:00") == "January 1, 2025 at 01:30:00 AM"
    assert shown("yesterday") is None
