from pathlib import Path

import pytest
from tests.conftest import rows
from pyspark.errors import PySparkException

from pricelake.operators import combine, drop_header_rows, pairs, pairs_from_files
from pricelake.plans import build_batch, build_lake
from pricelake.schemas import COMBINED
from pricelake.sources import (
    audit_counts,
    export_csv,
    header_names,
    read_bar_files,
    read_combined,
    read_lake,
    write_lake,
    write_table,
)

USUAL = "time,open,close,high,low,volume"
BAR = "1364774820000,1,2,3,0.5,7"


def put(folder, name, *lines):
    with open(f"{folder}/{name}", "w") as file:
        file.write("\n".join(lines) + "\n")


def test_file_names_give_pairs(spark, folder):
    for name in ("btcusd.csv", "a.b.csv", "a b.csv", "a+b.csv", "a%b.csv"):
        put(folder, name, USUAL, BAR)
    put(folder, "x.CSV", USUAL, BAR)
    put(folder, "note.txt", "nothing")
    combined = combine(read_bar_files(spark, folder))
    assert combined.columns == ["pair", "time", "open", "close", "high", "low", "volume"]
    assert sorted(row["pair"] for row in combined.collect()) == ["a", "a b", "a%b", "a+b", "btcusd"]
    assert [row[0] for row in pairs_from_files(spark, folder).collect()] == [
        "a b",
        "a%b",
        "a+b",
        "a.b",
        "btcusd",
    ]


def test_columns_are_matched_by_name(spark, folder):
    put(folder, "one.csv", USUAL, BAR)
    put(folder, "two.csv", "time,close,open,low,high,volume", "1364774820000,2,1,0.5,3,7")
    put(folder, "three.csv", 'extra,"time",open,close,high,low,volume', "x,1364774820000,1,2,3,0.5,7")
    got = combine(read_bar_files(spark, folder, by_name=True))
    assert rows(got.drop("pair")) == [(1364774820000, 1.0, 2.0, 3.0, 0.5, 7.0)] * 3
    assert sorted(row["pair"] for row in got.collect()) == ["one", "three", "two"]
    put(folder, "four.csv", USUAL, BAR)
    names = [row["names"] for row in header_names(spark, folder).collect()]
    assert len(names) == 4 and names.count(USUAL.split(",")) == 2


def test_a_file_with_two_headers_is_refused(spark, folder):
    put(folder, "one.csv", USUAL, BAR, "time,close,open,low,high,volume", BAR)
    with pytest.raises(ValueError, match="two different header"):
        read_bar_files(spark, folder, by_name=True)


def test_odd_file_names_can_be_matched_by_name(spark, folder):
    names = ["a b", "a+b", "a%b", "a%20b", "a[1]", "a{x,y}", "a*?"]
    for number, name in enumerate(names):
        header, values = (USUAL, BAR) if number % 2 else ("open,time,close,high,low,volume", "1,1364774820000,2,3,0.5,7")
        put(folder, name + ".csv", header, values)
    got = combine(read_bar_files(spark, folder, by_name=True))
    assert sorted(row["pair"] for row in got.collect()) == sorted(names)
    assert got.drop("pair").distinct().count() == 1
    assert [row[0] for row in pairs_from_files(spark, folder).collect()] == sorted(names)


def test_another_header_order_is_refused_without_by_name(spark, folder):
    put(folder, "two.csv", "time,close,open,low,high,volume", "1364774820000,2,1,0.5,3,7")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_bar_files(spark, folder).collect()


def test_a_file_without_known_header_is_refused(spark, folder):
    put(folder, "one.csv", USUAL, BAR)
    put(folder, "two.csv", "when,open,close,high,low,volume", BAR)
    with pytest.raises(ValueError, match="1 of 2"):
        read_bar_files(spark, folder, by_name=True)


def test_bad_numbers_become_null_and_keep_their_line(spark, folder):
    put(folder, "one.csv", USUAL, "1364774820000,x,2,3,0.5,7", BAR)
    got = {row["open"]: row["_corrupt"] for row in read_bar_files(spark, folder).collect()}
    assert got == {None: "1364774820000,x,2,3,0.5,7", 1.0: None}


def test_headers_read_as_data_are_dropped(spark, folder):
    put(folder, "part-0.csv", "pair," + USUAL, "btcusd," + BAR, "," + BAR)
    put(folder, "part-1.csv", "ethusd," + BAR)
    raw = read_combined(spark, folder, header=False)
    assert raw.count() == 4
    assert sorted(row["pair"] for row in drop_header_rows(raw).collect()) == ["btcusd", "ethusd"]
    assert raw.where("pair = 'pair'").first()["open"] is None


def test_a_combined_header_in_another_order_is_refused(spark, folder):
    put(folder, "part-0.csv", "pair,time,close,open,high,low,volume", "btcusd," + BAR)
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_combined(spark, folder).collect()


def test_quotes_and_escapes(spark, folder):
    put(folder, "c.csv", '"pair",' + USUAL, r'"a,\"b\"",' + BAR, '"plain","1","2","3","4","5","6"')
    got = read_combined(spark, folder, quoted=True).collect()
    assert [row["pair"] for row in got] == ['a,"b"', "plain"]
    assert (got[1]["time"], got[1]["open"], got[1]["volume"]) == ("1", 2.0, 6.0)


def test_lake_keeps_pair_names_as_text(spark, folder):
    for name in ("007.csv", "1e5.csv", "a b=c.csv"):
        put(folder, name, USUAL, BAR)
    lake = build_lake(spark, folder, folder + "/lake")
    assert [row[0] for row in pairs(lake).collect()] == ["007", "1e5", "a b=c"]
    write_lake(lake, folder + "/again", regroup=True)
    assert rows(read_lake(spark, folder + "/again")) == rows(lake)
    with pytest.raises(PySparkException):
        write_lake(lake, folder + "/again")


def test_a_bar_without_pair_name_cannot_be_stored(spark, folder):
    rows = spark.createDataFrame([("", 1.0)], "pair string, close double")
    with pytest.raises(Exception, match="empty pair"):
        write_lake(rows, folder + "/lake")


def test_export_is_a_new_folder_of_parts(spark, folder):
    frame = spark.range(100).repartition(4)
    export_csv(frame, folder + "/many")
    many = spark.read.csv(folder + "/many", header=True)
    assert len(many.inputFiles()) == 4 and many.count() == 100
    with pytest.raises(PySparkException):
        export_csv(frame, folder + "/many")


def test_tables_are_replaced_or_left_alone(spark, folder):
    write_table(spark.range(3), "kept", folder + "/1")
    assert write_table(spark.range(5), "kept", folder + "/2", if_not_exists=True).count() == 3
    assert write_table(spark.range(5), "kept", folder + "/3").count() == 5
    assert write_table(spark.range(2), "fresh", folder + "/4", if_not_exists=True).count() == 2
    assert spark.read.parquet(folder + "/1").count() == 3  # the old rows are still there
    broken = spark.range(4).selectExpr("if(id < 3, id, raise_error('broken')) as id")
    with pytest.raises(PySparkException):
        write_table(broken, "kept", folder + "/5")
    assert spark.table("kept").count() == 5
    for name in ("kept", "fresh"):
        spark.sql(f"DROP TABLE {name}")


def test_half_a_batch_table_is_not_a_table(spark, folder):
    combined = spark.createDataFrame([("p", str(1000 * i), *[1.0] * 5) for i in range(40)], COMBINED)
    build_batch(combined.repartition(4), folder + "/batch")
    Path(folder, "batch", "_SUCCESS").unlink()
    with pytest.raises(PySparkException):
        build_batch(combined, folder + "/batch", if_not_exists=True)
    build_batch(combined, folder + "/b")
    with pytest.raises(ValueError, match="price_time"):
        build_batch(combined, folder + "/b", variant="b", if_not_exists=True)


def test_batch_table_is_built_once(spark, folder):
    put(folder, "c.csv", "pair," + USUAL, "btcusd," + BAR)
    combined = read_combined(spark, folder + "/c.csv")
    first = build_batch(combined, folder + "/batch")
    again = build_batch(combined.where("false"), folder + "/batch", if_not_exists=True)
    assert rows(first) == rows(again) and first.count() == 1
    with pytest.raises(PySparkException):
        build_batch(combined, folder + "/batch")


def test_audit_counts(spark):
    got = audit_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(got) == [("a", 3), ("b", 0)]
