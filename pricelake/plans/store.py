"""The daily serving store: immutable base snapshots plus a delta log.

Layout below ``root``:

    base/<version>-<id>/shards=.../shard=.. one snapshot per version
    manifest/v=<version>/                   one JSON row
    delta/run=<id>/batch=<n>/price_date=... streamed rows
    quarantine/run=<id>/batch=<n>/reason=.. rejected records

Nothing that is read is ever overwritten. A snapshot counts once its manifest
row exists, and that row also names the delta batches the snapshot contains, so
readers skip them by folder. A version belongs to one writer: the second of two
that started from the same head fails and is run again.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, MapType, StringType, StructField, StructType

from pricelake.operators.lookup import key_range_scan, price_history
from pricelake.operators.serving import latest_by_either_order, latest_by_key, with_day_key
from pricelake.plans.build import by_shard, empty, read_or_none, read_sharded, write_shards
from pricelake.schemas import DELTA, LAST_BAR, REJECTED, SERVING, SNAPSHOT

KEYS = ["pair", "price_date"]

MANIFEST = StructType(
    [
        StructField("version", LongType()),
        StructField("path", StringType()),
        # run -> last batch of that run the snapshot contains
        StructField("folded", MapType(StringType(), LongType())),
        # whether the snapshot stores its text key
        StructField("keyed", BooleanType()),
    ]
)


def delta_path(root: str) -> str:
    return f"{root}/delta"


def quarantine_path(root: str) -> str:
    return f"{root}/quarantine"


def newest_heads(spark: SparkSession, root: str) -> list[Row]:
    """The newest manifest row and the one before it, as far as there are any."""
    log = read_or_none(lambda: spark.read.schema(MANIFEST).json(f"{root}/manifest"))
    newest = log.orderBy(F.desc("version")).limit(2).collect() if log is not None else []
    if len(newest) == 2 and newest[0]["version"] == newest[1]["version"]:
        raise RuntimeError(f"two writers made version {newest[0]['version']} of {root} at once")
    return newest


def _manifest_head(spark: SparkSession, root: str) -> Row | None:
    return next(iter(newest_heads(spark, root)), None)


def _as_serving(df: DataFrame) -> DataFrame:
    """Fill the columns a batch-built frame does not have."""
    columns = []
    for field in SERVING.fields:
        if field.name in df.columns:
            column = F.col(field.name)
        elif field.name == "volume_kind":
            column = F.lit(LAST_BAR)
        elif field.name == "event_time" and "time_ms" in df.columns:
            column = F.timestamp_millis("time_ms")
        else:
            column = F.lit(None)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def _write_snapshot(rows: DataFrame, root: str, head: Row | None, folded: dict[str, int]) -> int:
    spark = rows.sparkSession
    version = head["version"] + 1 if head else 1
    path = f"{root}/base/{version}-{uuid.uuid4().hex}"
    keyed = with_day_key(rows).select(*SNAPSHOT.names)
    write_shards(by_shard(keyed, "pair_date"), path)
    entry = json.dumps({"version": version, "path": path, "folded": folded, "keyed": True})
    line = spark.sql("SELECT 1").select(F.lit(entry).alias("value"))
    # Fails where another writer has made this version since the head was read.
    line.write.mode("errorifexists").text(f"{root}/manifest/v={version}")
    return version


def write_base(df: DataFrame, root: str) -> int:
    """Load batch-built daily rows (unique by key) as the next snapshot.

    They replace the batch-built rows of their keys. Other keys and streamed
    rows that earlier compactions put into the snapshot stay; which row of a key
    is current is decided when the view is read. Rows without a full key are not
    stored: no lookup could name them. Returns the new version.
    """
    spark = df.sparkSession
    head = _manifest_head(spark, root)
    rows = _as_serving(df).dropna(subset=KEYS)
    if head is None:
        return _write_snapshot(rows, root, None, {})
    stored = _snapshot(spark, head)
    others = stored.where("arrived_at IS NULL").join(rows.select(*KEYS), KEYS, "left_anti")
    kept = others.select(*SERVING.names).unionByName(stored.where("arrived_at IS NOT NULL"))
    return _write_snapshot(rows.unionByName(kept), root, head, head["folded"])


def _snapshot(spark: SparkSession, head: Row | None, pair: str | None = None) -> DataFrame | None:
    return read_sharded(spark, head["path"], SERVING, pair) if head else None


def read_base(spark: SparkSession, root: str) -> DataFrame | None:
    """The current snapshot. Per key it has at most one batch-built row and the
    streamed rows that can still be current, see ``compact``."""
    return _snapshot(spark, _manifest_head(spark, root))


def read_delta(spark: SparkSession, root: str) -> DataFrame | None:
    """The whole delta log; run, batch and price_date are folder columns."""
    return read_or_none(lambda: spark.read.schema(DELTA).parquet(delta_path(root)))


def read_quarantine(spark: SparkSession, root: str) -> DataFrame | None:
    return read_or_none(lambda: spark.read.schema(REJECTED).parquet(quarantine_path(root)))


def _beyond(delta: DataFrame, folded: dict[str, int]) -> DataFrame:
    """Without the folded batches; the test reads folder columns only, so it prunes folders."""
    if not folded:
        return delta
    return delta.where(F.col("batch") > _last_batch(folded))


def _last_batch(by_run: dict[str, int]) -> Column:
    """The batch number that a map of runs gives for a row's run, else -1."""
    runs = F.map_from_arrays(
        F.array(*map(F.lit, by_run)), F.array(*(F.lit(n).cast("long") for n in by_run.values()))
    )
    return F.coalesce(F.try_element_at(runs, F.col("run")), F.lit(-1).cast("long"))


def _all_rows(spark: SparkSession, base: DataFrame | None, delta: DataFrame | None) -> DataFrame:
    parts = [part.select(*SERVING.names) for part in (base, delta) if part is not None]
    if not parts:
        return empty(spark, SERVING)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def current_view(
    spark: SparkSession, root: str, order: str = "event_time", pair: str | None = None
) -> DataFrame:
    """Base and delta merged, last write wins; all pairs or one.

    A filter on dates goes below the merge: the delta prunes by its folders,
    the base by its statistics. Naming the pair prunes the base by folder too.
    """
    head = _manifest_head(spark, root)
    delta = read_delta(spark, root)
    if delta is not None:
        delta = _beyond(delta, head["folded"] if head else {})
        if pair is not None:
            delta = delta.where(F.col("pair") == pair)
    elif head is None:
        listing = spark.read.option("recursiveFileLookup", True)
        if read_or_none(lambda: listing.text(root)) is None:
            raise ValueError(f"there is no store at {root}")
    rows = _all_rows(spark, _snapshot(spark, head, pair), delta)
    return with_day_key(latest_by_key(rows, KEYS, order))


def stored_history(
    spark: SparkSession,
    root: str,
    pair: str,
    start: str | dt.date,
    end: str | dt.date,
    order: str = "event_time",
) -> DataFrame:
    """``price_history`` of the store, reading only what can hold the answer."""
    return price_history(current_view(spark, root, order, pair), pair, start, end)


def stored_key_range(
    spark: SparkSession, root: str, start: str, stop: str, order: str = "event_time"
) -> DataFrame:
    """Current rows with ``start <= pair_date < stop`` in binary text order, by key.

    The snapshot stores the key and is sorted by it, so the range goes to the Parquet scan,
    where statistics skip files, row groups and pages. The key names pair and day, so the
    range holds for all rows of a key alike and goes below the merge on both sides.
    """
    head = _manifest_head(spark, root)
    base = None
    if head is not None:
        layout = SNAPSHOT if head["keyed"] else SERVING
        base = read_sharded(spark, head["path"], layout)
        if not head["keyed"]:  # written before keys were stored
            base = with_day_key(base)
        base = _between(base, start, stop)
    delta = read_delta(spark, root)
    if delta is not None:
        delta = _between(with_day_key(_beyond(delta, head["folded"] if head else {})), start, stop)
    elif head is None:
        raise ValueError(f"there is no store at {root}")
    rows = _all_rows(spark, base, delta)
    return key_range_scan(with_day_key(latest_by_key(rows, KEYS, order)), "pair_date", start, stop)


def _between(df: DataFrame, start: str, stop: str) -> DataFrame:
    return df.where((F.col("pair_date") >= start) & (F.col("pair_date") < stop))


def compact(spark: SparkSession, root: str) -> int:
    """Fold finished delta batches into the next snapshot; returns its version.

    Of a key's streamed rows the winners of both merge orders are kept; its
    batch-built row is kept beside them, so that a later batch load can replace
    it. The newest batch of each run may still be written, so it is left to the
    next call. One compaction at a time; readers and the stream keep going.
    ``retention.expire`` removes what is folded.
    """
    head = _manifest_head(spark, root)
    folded = dict(head["folded"]) if head else {}
    delta = read_delta(spark, root)
    if delta is not None:
        newest = delta.groupBy("run").agg(F.max("batch").alias("batch")).collect()
        finished = {row["run"]: row["batch"] - 1 for row in newest}
        # A run without folders has nothing left that could be read again.
        folded = {run: last for run, last in folded.items() if run in finished}
        delta = _beyond(delta, folded)
        # A run that appeared after the count is not in ``finished``.
        delta = delta.where(F.col("batch") <= _last_batch(finished)) if finished else None
        folded.update({run: max(last, folded.get(run, -1)) for run, last in finished.items()})
    rows = _all_rows(spark, _snapshot(spark, head), delta)
    sided = rows.withColumn("_streamed", F.col("arrived_at").isNotNull())
    kept = latest_by_either_order(sided, [*KEYS, "_streamed"]).drop("_streamed")
    return _write_snapshot(kept, root, head, folded)
