"""The same results as SQL over the same tables, for the side-by-side check."""

from __future__ import annotations

_TICKS = """
t AS (
  SELECT event_type AS pair, epoch_us(ts) // 1000 AS time_ms, ts AS event_time,
         CAST(ts AS DATE) AS price_date, value AS close,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         event_id AS seq
  FROM events
)"""

_BATCH = """
b AS (
  SELECT pair, price_date, strftime(event_time, '%H:%M:%S') AS price_time,
         strftime(event_time, '%Y-%m-%d %H:%M:%S') AS full_timestamp,
         close + 1 AS open, close, close + 2 AS high, close - 1 AS low, volume,
         time_ms, seq
  FROM t
)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def _last(source: str, order: str, columns: str, keys: str = "pair, price_date") -> str:
    """The first row of each key in ``order``, from a relation or subquery."""
    return f"""
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}
) WHERE rn = 1"""


_KEY = "concat(pair, '_', strftime(price_date, '%Y-%m-%d'))"
_DAILY = f"{_KEY} AS pair_date, pair, price_date, close, volume"
_NEWEST = "event_time DESC, seq DESC"

_daily_cte = f"d AS ({_last('t', _NEWEST, _DAILY)})"

_FULL = (
    "concat(pair, '_', strftime(price_date, '%Y-%m-%d'), '_', price_time) AS pair_date_time, "
    "pair, price_date, price_time, full_timestamp, open, close, high, low, volume"
)
_minute_cte = (
    "m AS ("
    + _last("b", "time_ms DESC, seq DESC", _FULL, "pair, price_date, price_time")
    + ")"
)

# Milliseconds only (text files): ties in time fall to close, then volume.
_TEXT_ORDER = "time_ms DESC, close DESC, volume DESC"

_CELLS = f"""
SELECT key, 'cf:pair' AS "column", pair AS value FROM k
UNION ALL SELECT key, 'cf:price_date', strftime(price_date, '%Y-%m-%d') FROM k
UNION ALL SELECT key, 'cf:close', CAST(close AS VARCHAR) FROM k
UNION ALL SELECT key, 'cf:volume', CAST(volume AS VARCHAR) FROM k"""

_FEED = """
f AS (
  SELECT concat(upper(pair), '-USD-X') AS product_id, seq, event_time, close, volume
  FROM t WHERE pair <> 'error'
)"""

_BACKEND = """
SELECT lower(regexp_replace(product_id, '-', '')) AS pair,
       CAST(event_time AS DATE) AS price_date, seq, close, volume,
       'rolling_24h' AS volume_kind
FROM f"""

_FRONTEND = """
SELECT product_id AS pair,
       strftime(event_time, '%B %-d, %Y at %I:%M:%S %p') AS price_date,
       close, volume + 1 AS volume
FROM f"""

_STREAMED = f"{_DAILY}, 'rolling_24h' AS volume_kind, seq"


def _arrival(order: tuple[int, ...]) -> str:
    """Ticks with the place of their quarter of the day in the delivery order."""
    places = " ".join(f"WHEN {number} THEN {place}" for place, number in enumerate(order))
    return f"""
a AS (
  SELECT *, CASE hour(event_time) // 6 + 1 {places} END AS delivery FROM t
)"""


_MERGE = f"""
sides AS (
  SELECT pair, price_date, close, volume, event_time, seq,
         (hour(event_time) >= 12) = (price_date <= DATE '2024-01-15') AS in_base
  FROM t
),
base AS ({
    _last(
        "(SELECT * FROM sides WHERE in_base)",
        _NEWEST,
        "pair, price_date, close, volume, event_time, seq",
    )
}),
both_sides AS (
  SELECT *, 'last_bar' AS volume_kind, 0 AS streamed FROM base
  UNION ALL
  SELECT pair, price_date, close, volume, event_time, seq, 'rolling_24h', 1
  FROM sides WHERE NOT in_base
)"""

_MERGED = f"{_DAILY}, volume_kind, seq"

_LATEST = """
SELECT pair, CAST(rank AS INTEGER) AS rank, seq, close, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY pair ORDER BY event_time DESC, seq DESC) AS rank
  FROM t
) WHERE rank <= 9"""

_COMBINED = "time_ms AS time, close + 1 AS open, close, close + 2 AS high, close - 1 AS low, volume"

_STORAGE = {
    "batch_rejects": _with(
        _TICKS,
        """
x AS (
  SELECT *, CAST(time_ms AS VARCHAR) AS ms, CAST(CAST(round(close * 100) AS BIGINT) AS VARCHAR) AS cents,
         hour(event_time) < 12 AS early
  FROM t
),
l AS (
  SELECT *, CASE
    WHEN pair = 'error' AND early THEN concat(pair, ',', ms, 'x,', seq, ',', cents, ',1,2,3')
    WHEN pair = 'error' THEN concat(pair, ',99999999999999999,', seq, ',', cents, ',1,2,3')
    WHEN pair = 'signup' AND early THEN concat(',', ms, ',', seq, ',', cents, ',1,2,3')
    WHEN pair = 'signup' THEN concat(pair, ',,', seq, ',', cents, ',1,2,3')
    WHEN pair = 'view' AND early THEN concat(pair, ',', ms, ',', seq, ',n/a,1,2,3')
    WHEN pair = 'view' THEN concat(pair, ',', ms, ',', seq, ',', cents, ',1,2')
    ELSE concat(pair, ',', ms, ',', seq, ',', cents, ',1,2,3') END AS line,
    CASE
    WHEN pair = 'error' THEN 'bad time'
    WHEN pair = 'signup' AND early THEN 'missing pair'
    WHEN pair = 'signup' THEN 'missing time'
    WHEN pair = 'view' THEN 'unreadable line'
    ELSE 'accepted' END AS outcome
  FROM x
)""",
        select="""
SELECT outcome, line AS raw, NULL::VARCHAR AS pair, NULL::VARCHAR AS full_timestamp,
       NULL::BIGINT AS open, NULL::BIGINT AS close
FROM l WHERE outcome <> 'accepted'
UNION ALL
SELECT outcome, NULL, pair, strftime(event_time, '%Y-%m-%d %H:%M:%S'), seq, CAST(cents AS BIGINT)
FROM l WHERE outcome = 'accepted'
UNION ALL
SELECT 'header row', 'pair,time,open,close,high,low,volume', NULL, NULL, NULL, NULL""",
    ),
    "stored_key_range": _with(
        _TICKS,
        _MERGE,
        "v AS (" + _last("both_sides", f"{_NEWEST}, streamed DESC", _DAILY) + ")",
        select="SELECT * FROM v WHERE pair_date >= 'click_2024-01-25' "
        "AND pair_date < 'purchase_2024-01-10'",
    ),
    "daily_close_bucketed": _with(_TICKS, select=_last("t", _TEXT_ORDER, _DAILY)),
    "lake_product_list": _with(
        _TICKS,
        select=f"""
SELECT pair, {_COMBINED} FROM t
WHERE pair IN (SELECT pair FROM t GROUP BY pair HAVING count(*) < (SELECT count(*) / 5 FROM t))""",
    ),
    "stored_counts": _with(
        _TICKS,
        select="""
SELECT pair, count(*) AS rows, count(volume) AS volumes,
       min(time_ms) AS first_ms, max(time_ms) AS last_ms, min(close) AS least, max(close) AS most
FROM t GROUP BY pair""",
    ),
}

_LIVE = {
    "board_arrival": _with(
        _TICKS,
        _arrival((2, 4, 1, 3)),
        select="""
SELECT product_id, CAST(rank AS INTEGER) AS rank, seq AS sequence, shown_at, price, last_size FROM (
  SELECT concat(upper(pair), '-USD-X') AS product_id, seq,
         strftime(event_time, '%B %-d, %Y at %I:%M:%S %p') AS shown_at,
         close AS price, volume + 1 AS last_size,
         row_number() OVER (PARTITION BY pair ORDER BY delivery DESC, seq DESC) AS rank
  FROM a WHERE pair <> 'error'
) WHERE rank <= 9""",
    ),
    "stream_expired": _with(
        _TICKS, _arrival((4, 2, 3, 1)), select=_last("a", "delivery DESC, seq DESC", _STREAMED)
    ),
    "queue_round_trip": _with(
        _TICKS, _arrival((2, 1, 4, 3)), select=_last("a", "delivery DESC, seq DESC", _STREAMED)
    ),
    "stream_paced": _with(_TICKS, select=_last("t", _NEWEST, _STREAMED)),
    "stream_latest_state": _with(_TICKS, select=_last("t", _NEWEST, _STREAMED)),
}

ORACLE: dict[str, str] = {
    "batch_expand_a": _with(
        _TICKS,
        _BATCH,
        select="SELECT pair, price_date, price_time, full_timestamp, "
        "open, close, high, low, volume, seq FROM b",
    ),
    "batch_expand_b": _with(
        _TICKS,
        _BATCH,
        select="SELECT pair, price_date AS date, full_timestamp AS time, close, volume, seq FROM b",
    ),
    "header_sentinel_filter": _with(
        _TICKS,
        select="""
SELECT pair, close, seq FROM (
  SELECT CASE WHEN pair = 'error' THEN 'pair' WHEN pair <> 'view' THEN pair END AS pair, close, seq
  FROM t
) WHERE pair <> 'pair'""",
    ),
    "combine_projection": _with(_TICKS, select=f"SELECT 'events' AS pair, {_COMBINED} FROM t"),
    "file_pair_catalog": """
SELECT 'events' AS pair, 'events' AS stem, count(*) AS rows FROM events
UNION ALL SELECT 'orders', 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'customer', 'customer', count(*) FROM customer""",
    "pair_catalog": "SELECT DISTINCT event_type AS pair FROM events",
    "bar_file_ingest": _with(_TICKS, select=f"SELECT {_COMBINED} FROM t"),
    "csv_daily_close": _with(_TICKS, select=_last("t", _TEXT_ORDER, _DAILY)),
    "csv_quoted": _with(
        _TICKS,
        select=f"""
SELECT concat('"', pair, '", \\n') AS pair, {_COMBINED.replace('time_ms', 'CAST(time_ms AS VARCHAR)')}
FROM t""",
    ),
    "batch_table": _with(
        _TICKS,
        _BATCH,
        select="SELECT pair, price_date, price_time, full_timestamp, "
        "open, close, high, low, volume, time_ms FROM b",
    ),
    "catalog_tables": _with(
        _TICKS,
        select="""
SELECT 'kept' AS label, pair, price_date, close, volume, seq FROM t
WHERE price_date <= DATE '2024-01-15'
UNION ALL SELECT 'replaced', pair, price_date, close, volume, seq FROM t""",
    ),
    "lake_daily_close": _with(_TICKS, select=_last("t", _TEXT_ORDER, _DAILY)),
    "audit_counts": """
SELECT 'batch' AS "table", count(*) AS rows FROM events
UNION ALL
SELECT 'daily', count(*) FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) FROM events)
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    "daily_close": _with(_TICKS, select=_last("t", _NEWEST, _DAILY)),
    "daily_close_maxby": _with(_TICKS, select=_last("t", _NEWEST, _DAILY)),
    "sql_closing_rows": _with(
        _TICKS, select=_last("t", _TEXT_ORDER, "pair, price_date, close, volume")
    ),
    "sql_counts": _with(
        _TICKS,
        _BATCH,
        select="""
SELECT 'batch' AS name, count(*) AS rows, min(price_date) AS first, max(price_date) AS last FROM b
UNION ALL
SELECT 'minute', count(*), min(price_date), max(price_date)
FROM (SELECT DISTINCT pair, price_date, price_time FROM b)
UNION ALL
SELECT 'daily', count(*), min(price_date), max(price_date)
FROM (SELECT DISTINCT pair, price_date FROM b)""",
    ),
    "daily_close_orders": _last(
        """(
    SELECT o_orderpriority AS pair, CAST(o_orderdate AS DATE) AS price_date,
           o_orderdate AS event_time, o_totalprice AS close,
           CAST(o_custkey AS DOUBLE) AS volume, o_orderkey AS seq
    FROM orders
  )""",
        _NEWEST,
        _DAILY,
    ),
    "daily_close_lineitem": _last(
        """(
    SELECT concat(l_returnflag, l_linestatus) AS pair, CAST(l_shipdate AS DATE) AS price_date,
           l_orderkey AS seq, l_extendedprice AS close, l_quantity AS volume
    FROM lineitem
  )""",
        "seq DESC, close DESC, volume DESC",
        _DAILY,
    ),
    "minute_serving": _with(_TICKS, _BATCH, _minute_cte, select="SELECT * FROM m"),
    "minute_snapshot": _with(
        _TICKS,
        _BATCH,
        _minute_cte,
        select="SELECT * FROM m WHERE pair_date_time >= 'purchase_2024-01-09' "
        "AND pair_date_time < 'purchase_2024-01-16'",
    ),
    "daily_snapshot": _with(
        _TICKS,
        select=_last("t", _NEWEST, "pair, price_date, close, volume, 'last_bar' AS volume_kind"),
    ),
    "snapshot_reload": _with(
        _TICKS,
        """
l AS (
  SELECT *, price_date > DATE '2024-01-15' AND hour(event_time) < 12 AS reloaded FROM t
)""",
        select=_last("l", f"reloaded DESC, {_NEWEST}", _DAILY),
    ),
    "price_range": _with(
        _TICKS,
        _daily_cte,
        select="SELECT pair, price_date, close, volume FROM d WHERE pair = 'click' "
        "AND price_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'",
    ),
    "price_range_display": _with(
        _TICKS,
        _daily_cte,
        select="""
SELECT pair, strftime(price_date, '%Y-%m-%d') AS price_date,
       CAST(close AS VARCHAR) AS close, CAST(volume AS VARCHAR) AS volume
FROM d WHERE pair = 'view' AND price_date BETWEEN DATE '2024-01-20' AND DATE '2024-02-20'""",
    ),
    "key_range_scan": _with(
        _TICKS,
        _daily_cte,
        select="SELECT * FROM d WHERE pair_date >= 'click_2024-01-05' "
        "AND pair_date < 'click_2024-01-12'",
    ),
    "key_range_scan_inclusive": _with(
        _TICKS,
        _daily_cte,
        select="SELECT * FROM d WHERE pair_date >= 'click_2024-01-05' "
        "AND pair_date <= 'click_2024-01-12'",
    ),
    "cells_unpivot": _with(
        _TICKS, _daily_cte, "k AS (SELECT *, pair_date AS key FROM d)", select=_CELLS
    ),
    "cells_pivot": _with(_TICKS, _daily_cte, select="SELECT * FROM d"),
    "cells_latest_version": _with(
        _TICKS,
        f"k AS (SELECT *, {_KEY} AS key FROM t)",
        select="""
SELECT key AS pair_date, arg_max(pair, seq) AS pair, arg_max(price_date, seq) AS price_date,
       arg_max(close, seq) AS close, arg_max(volume, seq) AS volume
FROM k GROUP BY key""",
    ),
    "product_normalize": _with(
        _TICKS,
        _FEED,
        select="""
SELECT product_id, lower(regexp_replace(product_id, '-', '')) AS pair, seq AS sequence
FROM f WHERE product_id IN ('CLICK-USD-X', 'VIEW-USD-X')""",
    ),
    "product_list_join": _with(
        _TICKS,
        _FEED,
        select="""
SELECT product_id, seq AS sequence FROM f
WHERE product_id IN (
  SELECT concat(upper(pair), '-USD-X') FROM t GROUP BY pair HAVING max(close) > 100
)""",
    ),
    "backend_projection": _with(_TICKS, _FEED, select=_BACKEND),
    "frontend_projection": _with(_TICKS, _FEED, select=_FRONTEND),
    "tick_messages": _with(
        _TICKS,
        select="""
SELECT pair AS key,
       concat('{"pair":"', pair, '","price_date":"', strftime(price_date, '%Y-%m-%d'),
              '","close":', CAST(close AS VARCHAR), ',"volume":', CAST(volume AS VARCHAR),
              ',"event_time":"', strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ'),
              '","seq":', CAST(seq AS VARCHAR), '}') AS value
FROM t""",
    ),
    "json_round_trip": _with(
        _TICKS,
        select="SELECT pair, price_date, close, volume, seq, epoch_us(event_time) AS event_us FROM t",
    ),
    "stream_upsert": _with(_TICKS, select=_last("t", _NEWEST, _STREAMED)),
    "stream_upsert_arrival": _with(
        _TICKS, _arrival((3, 1, 4, 2)), select=_last("a", "delivery DESC, seq DESC", _STREAMED)
    ),
    "stream_compacted": _with(
        _TICKS, _arrival((4, 2, 3, 1)), select=_last("a", "delivery DESC, seq DESC", _STREAMED)
    ),
    "merge_current_view": _with(
        _TICKS, _MERGE, select=_last("both_sides", f"{_NEWEST}, streamed DESC", _MERGED)
    ),
    "merge_arrival_view": _with(
        _TICKS, _MERGE, select=_last("both_sides", "streamed DESC, seq DESC", _MERGED)
    ),
    "merged_price_range": _with(
        _TICKS,
        _MERGE,
        "v AS ("
        + _last("both_sides", f"{_NEWEST}, streamed DESC", "pair, price_date, close, volume")
        + ")",
        select="SELECT * FROM v WHERE pair = 'purchase' "
        "AND price_date BETWEEN DATE '2024-01-14' AND DATE '2024-01-24'",
    ),
    "stream_quarantine": _with(
        _TICKS,
        """
h AS (
  SELECT pair, seq, concat('{"pair":"', pair, '","seq":', CAST(seq AS VARCHAR),
         ',"price_date":"', strftime(price_date, '%Y-%m-%d'), '"') AS head
  FROM t
)""",
        select="""
SELECT concat('{bad ', CAST(seq AS VARCHAR)) AS raw, 'malformed' AS reason
FROM h WHERE pair = 'error'
UNION ALL
SELECT concat(head, ',"volume":"1"}'), 'missing close' FROM h WHERE pair = 'view'
UNION ALL
SELECT concat(head, ',"close":"n/a","volume":"1"}'), 'bad close' FROM h WHERE pair = 'signup'""",
    ),
    "fan_out_backend": _with(_TICKS, _FEED, select=_BACKEND),
    "fan_out_frontend": _with(_TICKS, _FEED, select=_FRONTEND),
    "latest_n": _with(_TICKS, select=_LATEST),
    "latest_n_stream": _with(_TICKS, select=_LATEST),
    **_STORAGE,
    **_LIVE,
}
