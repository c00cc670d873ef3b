"""What the physical plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from pricelake.plans import registered
from pricelake.plans.store import stored_history, write_base
from pricelake.sources import write_lake
from pricelake.operators import build_daily, price_history
from pricelake.operators.serving import latest_by_either_order, latest_seconds, with_texts
from pricelake.plans.build import batch_rows, by_shard
from pricelake.streaming import merge_board
from tests.conftest import plan

SF_DIR = "/root/testdata/sf0.001"


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange (\w+)", text)


def test_daily_close_limits_each_key_before_the_exchange(spark):
    text = plan(registered.daily(spark, SF_DIR))
    assert shuffles(text) == ["hashpartitioning"]
    above, below = text.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in above and "Final" in above
    assert "WindowGroupLimit" in below and "Partial" in below
    assert "user_id" not in text  # only the columns in use are read


def test_latest_nine_limits_before_the_exchange(spark):
    text = plan(registered.latest_nine(spark, SF_DIR))
    assert "Partial" in text.split("Exchange hashpartitioning")[1]


def test_last_write_wins_aggregates_before_the_exchange(spark):
    text = plan(registered.daily_close_maxby(spark, SF_DIR))
    assert shuffles(text) == ["hashpartitioning"]
    assert "partial_max" in text.split("Exchange hashpartitioning")[1]


def test_stream_batches_are_reduced_before_the_exchange(spark):
    rows = registered.ticks(spark, SF_DIR).drop("time_ms")
    arrived = rows.withColumns({"arrived_at": F.current_timestamp(), "batch": F.lit(1)})
    text = plan(latest_by_either_order(arrived, ["pair", "price_date"]))
    assert shuffles(text) == ["hashpartitioning"]
    assert "partial_max_by" in text.split("Exchange hashpartitioning")[1]


def test_board_is_limited_before_the_exchange(spark):
    rows = registered.ticks(spark, SF_DIR)
    text = plan(merge_board(merge_board(None, rows), rows))
    assert all("Partial" in part for part in text.split("Exchange hashpartitioning")[1:])


def test_minute_rows_are_limited_before_the_exchange(spark):
    text = plan(registered.minute_serving(spark, SF_DIR))
    assert shuffles(text) == ["hashpartitioning"]
    assert "Partial" in text.split("Exchange hashpartitioning")[1]


def test_minute_layout_needs_no_sort_of_its_own_for_the_write(spark):
    batch = batch_rows(registered.bars(spark, SF_DIR))
    text = plan(with_texts(by_shard(latest_seconds(batch), "pair", "_second"), ["shards", "shard"]))
    assert shuffles(text) == ["rangepartitioning", "hashpartitioning"]
    # Texts are derived above both exchanges.
    assert "date_format" not in text.split("Exchange rangepartitioning")[1]


def test_cells_are_regrouped_by_one_exchange(spark):
    assert shuffles(plan(registered.cells_latest_version(spark, SF_DIR))) == ["hashpartitioning"]


@pytest.mark.parametrize("name", ["batch_expand_a", "batch_expand_b", "combine_projection"])
def test_projections_do_not_shuffle(spark, name):
    assert shuffles(plan(registered.QUERIES[name](spark, SF_DIR))) == []


@pytest.mark.parametrize(
    "name", ["json_round_trip", "product_normalize", "backend_projection", "frontend_projection"]
)
def test_messages_are_parsed_once(spark, name):
    assert plan(registered.QUERIES[name](spark, SF_DIR)).count("from_json") == 1


def test_lookup_reaches_the_scan(spark):
    frame = price_history(registered.daily(spark, SF_DIR), "click", "2024-01-01", "2024-01-02")
    assert "EqualTo(event_type,click)" in plan(frame)


def test_store_lookup_prunes_base_by_shard_and_delta_by_date(spark, folder):
    rows = registered.ticks(spark, SF_DIR)
    write_base(build_daily(rows, keep=["event_time", "seq"]), folder)
    delta = rows.select(
        "pair", "price_date", "close", "volume", F.lit("x").alias("volume_kind"), "event_time",
        "seq", F.current_timestamp().alias("arrived_at"),
    )
    delta.write.partitionBy("price_date").parquet(f"{folder}/delta/run=r/batch=0")
    found = stored_history(spark, folder, "click", "2024-01-03", "2024-01-05")
    text = plan(found)
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)(?:\]|\.\.\.)", text)
    assert len(filters) == 2
    assert any(parts == "" and "IsNotNull(pair" in pushed for parts, pushed in filters)
    opened = {file.rsplit("/", 1)[0] for file in found.inputFiles() if "/base/" in file}
    assert len(opened) == 1 and "/shard=" in opened.pop()
    assert any("price_date" in parts and "pair" in pushed for parts, pushed in filters)


def test_lake_write_of_bar_files_does_not_shuffle(spark, folder, monkeypatch):
    seen = []
    rows = registered.bars(spark, SF_DIR).select("pair", "time", "close")
    monkeypatch.setattr(
        type(rows), "write", property(lambda self: seen.append(plan(self)) or _Nowhere()), raising=False
    )
    write_lake(rows, folder)
    write_lake(rows, folder, regroup=True)
    assert shuffles(seen[0]) == [] and shuffles(seen[1]) == ["hashpartitioning"]


class _Nowhere:
    def __getattr__(self, name):
        return lambda *args, **options: self


# The others run streams; what they return is a plain read.
BATCH_QUERIES = [
    name
    for name in sorted(registered.QUERIES)
    if not name.startswith(("stream_", "merge", "fan_out", "latest_n_stream"))
]


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_in_any_plan(spark, name):
    text = plan(registered.QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
