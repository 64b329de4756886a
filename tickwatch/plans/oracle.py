"""SQL twins of the registered queries, over the plain columns of the test tables.

They never see the JSON text that the Spark side decodes, so the two sides share
the definition of the inputs and nothing else.
"""

from __future__ import annotations

from tickwatch.plans.views import (
    FULL_FIELDS,
    MALFORMED_TEXT,
    PRICE_TOKEN,
    REOPENING_TEXT,
    SHORT_FIELDS,
    VOLUME_TOKEN,
)
from tickwatch.schemas import CAUTION_FLAGS, SHORT_TO_LONG

_CLEAN = """timed AS (
  SELECT *, epoch_us(ts) // 1000 AS ms FROM events),
clocked AS (
  SELECT *, CASE WHEN event_id % 5 = 0 THEN ms - ms % 3600000 ELSE ms END AS event_ms FROM timed),
clean AS (
  SELECT event_id AS tick_id, 'MKT-' || upper(event_type) AS code, event_ms,
         event_ms + (event_id * 37) % 2500 - 100 AS ingest_ms,
         1000 + value / 5 AS price, CAST(1 + event_id % 7 AS DOUBLE) AS volume,
         CASE event_id % 3 WHEN 0 THEN 'RISE' WHEN 1 THEN 'EVEN' ELSE 'FALL' END AS change,
         CASE WHEN event_id % 10 = 0 THEN 'SNAPSHOT' ELSE 'REALTIME' END AS stream_type,
         event_id % 40 AS fault
  FROM clocked)"""

_PRICE = "CASE fault WHEN 0 THEN -1.0 WHEN 9 THEN 0.0 ELSE price END"


def _judged(bad: str, market: str) -> str:
    return f"""judged AS (
  SELECT tick_id, ingest_ms, is_error, {market} AS market,
         CASE WHEN is_error THEN 0.0 ELSE greatest(0.0, CAST(ingest_ms - event_ms AS DOUBLE)) END AS latency_ms,
         CASE WHEN is_error THEN 0.0 ELSE price * volume END AS trade_amount_krw
  FROM (SELECT *, fault IN ({bad}) AS is_error FROM clean))"""


_GLOBAL = _judged(
    "0, 1, 2, 3, 5, 9, 11, 12, 15", "CASE WHEN fault IN (2, 5, 15) THEN NULL WHEN fault = 10 THEN 'MKT-NONE' ELSE code END"
)
_MARKET = _judged(
    "0, 1, 2, 3, 9, 11, 12, 15", "CASE WHEN fault IN (2, 5, 15) THEN 'UNKNOWN' WHEN fault = 10 THEN 'MKT-NONE' ELSE code END"
)


def _parse(judged: str) -> str:
    return f"WITH {_CLEAN}, {judged} SELECT tick_id, is_error, market, latency_ms, trade_amount_krw FROM judged"


def _health(step: int, label: str, closed_only: bool = False) -> str:
    closed = f"WHERE (ingest_ms // {step} + 1) * {step} <= (SELECT max(ingest_ms) FROM judged)" if closed_only else ""
    return f"""health AS (
  SELECT make_timestamp((ingest_ms // {step} + 1) * {step} * 1000) AS checked_at, '{label}' AS time_unit,
         count(*) AS total_collected_count,
         CAST(count(*) FILTER (is_error) AS INTEGER) AS total_error_count,
         count(*) FILTER (is_error) / count(*) * 100 AS error_rate_percentage,
         coalesce(avg(latency_ms) FILTER (NOT is_error), 0.0) AS average_latency_ms,
         coalesce(max(latency_ms) FILTER (NOT is_error), 0.0) AS max_latency_ms,
         CAST(count(DISTINCT market) FILTER (NOT is_error) AS INTEGER) AS unique_market_count,
         round(coalesce(sum(trade_amount_krw) FILTER (NOT is_error), 0.0), 3) AS total_trade_volume_krw
  FROM judged {closed} GROUP BY ingest_ms // {step})"""


def _market_health(step: int, label: str, closed_only: bool = False) -> str:
    closed = f"WHERE (ingest_ms // {step} + 1) * {step} <= (SELECT max(ingest_ms) FROM judged)" if closed_only else ""
    return f"""health AS (
  SELECT make_timestamp((ingest_ms // {step} + 1) * {step} * 1000) AS checked_at, market, '{label}' AS time_unit,
         count(*) AS collected_count,
         CAST(count(*) FILTER (is_error) AS INTEGER) AS error_count,
         count(*) FILTER (is_error) / count(*) * 100 AS error_rate_percentage,
         coalesce(avg(latency_ms) FILTER (NOT is_error), 0.0) AS average_latency_ms,
         coalesce(max(latency_ms) FILTER (NOT is_error), 0.0) AS max_latency_ms,
         round(coalesce(sum(trade_amount_krw) FILTER (NOT is_error), 0.0), 3) AS trade_volume_krw
  FROM judged {closed} GROUP BY ingest_ms // {step}, market)"""


_SECOND, _HOUR_MS = 1000, 3600000


def _moves(size: int, slide: int, left_out: str, closed_after: int | None = None, time: str = "event_ms", splits: int = 1) -> str:
    closed = ""
    if closed_after is not None:
        least = f"SELECT min(last) FROM (SELECT max(event_ms) AS last FROM priced GROUP BY tick_id % {splits})"
        closed = f"AND start_ms + {size} <= ({least}) - {closed_after}"
    return f"""priced AS (
  SELECT tick_id, {time} AS event_ms, {_PRICE} AS price,
         CASE fault WHEN 10 THEN 'MKT-NONE' WHEN 16 THEN '0' ELSE code END AS market_code
  FROM clean WHERE fault NOT IN ({left_out})),
spread AS (
  SELECT *, (event_ms // {slide} - step) * {slide} AS start_ms
  FROM priced, (SELECT unnest(range({size // slide})) AS step)),
spans AS (
  SELECT market_code, start_ms,
         first(price ORDER BY event_ms, tick_id) AS start_price,
         first(price ORDER BY event_ms DESC, tick_id) AS end_price
  FROM spread GROUP BY market_code, start_ms),
rated AS (
  SELECT *, (end_price - start_price) / start_price * 100 AS rate FROM spans WHERE start_price <> 0 {closed}),
moves AS (
  SELECT make_timestamp(start_ms * 1000) AS window_start, make_timestamp((start_ms + {size}) * 1000) AS window_end,
         start_price, end_price, CAST(format('{{:.2f}}', rate) AS DOUBLE) + 0.0 AS change_rate,
         CASE WHEN rate >= 3 OR rate <= -3 THEN 'danger' WHEN rate >= 1 OR rate <= -1 THEN 'warning'
              WHEN rate >= 0.5 OR rate <= -0.5 THEN 'caution' ELSE 'normal' END AS status,
         market_code
  FROM rated)"""


_UNPRICED = "1, 2, 5, 6, 11, 15"
_SIX_HOURS = 6 * _HOUR_MS


def _text(full: bool) -> str:
    """The message text, put together by hand."""
    pieces = []
    for name, sql in SHORT_FIELDS + (FULL_FIELDS if full else ()):
        numeric = "price" in sql or name in ("timestamp", "trade_timestamp", "is_trading_suspended")
        quote = "" if numeric else '"'
        pieces.append(f"""coalesce(',"{name}":{quote}' || CAST({sql} AS VARCHAR) || '{quote}', '')""")
    price, volume = PRICE_TOKEN.format(text="VARCHAR"), VOLUME_TOKEN.format(text="VARCHAR")
    zero = """CASE WHEN fault = 16 THEN ',"code":0' ELSE '' END"""
    whole = f"""'{{"trade_price":' || {price} || ',"trade_volume":' || {volume} || {zero} || {' || '.join(pieces)} || '}}'"""
    return f"CASE fault WHEN 2 THEN '{MALFORMED_TEXT}' WHEN 15 THEN '{REOPENING_TEXT}' ELSE {whole} END"


_REASONS = """CASE WHEN fault IN (2, 15) THEN 'Malformed JSON' ELSE nullif(concat_ws(' | ',
    CASE WHEN fault IN (5, 6) THEN 'Missing Field: code' END,
    CASE WHEN fault = 1 THEN 'Missing Field: timestamp' END,
    CASE WHEN fault IN (0, 12) THEN 'Negative Value Error: price or volume is negative' END,
    CASE WHEN fault IN (7, 13) THEN 'Invalid Change Type: UP' END,
    CASE WHEN fault IN (8, 13) THEN 'Invalid Stream Type: X' END), '') END"""

_ROUTED = f"""routed AS (
  SELECT *, {_REASONS} AS error_log,
         CASE WHEN fault IN (0, 1, 2, 5, 6, 7, 8, 12, 13, 15) THEN 'dead_letter'
              WHEN fault IN (10, 16) THEN 'skipped' WHEN fault IN (3, 11, 14) THEN 'unstorable' ELSE 'stored' END AS outcome
  FROM clean)"""

_STORED_TYPES = {
    "opening_price": "20,4", "high_price": "20,4", "low_price": "20,4", "prev_closing_price": "20,4",
    "acc_trade_price": "30,4", "change_price": "20,4", "signed_change_price": "20,4", "change_rate": "10,6",
    "signed_change_rate": "10,6", "acc_trade_volume": "30,8", "acc_ask_volume": "30,8", "acc_bid_volume": "30,8",
    "highest_52_week_price": "20,4", "lowest_52_week_price": "20,4", "acc_trade_price_24h": "30,4",
    "acc_trade_volume_24h": "30,8",
}


def _stored() -> str:
    columns = ["tick_id", "code AS market_code", "change", "event_ms AS timestamp", "stream_type"]
    columns.append(f"CAST(CAST({_PRICE} AS DECIMAL(20,4)) AS VARCHAR) AS trade_price")
    columns.append("CAST(CAST(volume AS DECIMAL(25,8)) AS VARCHAR) AS trade_volume")
    columns.append("CAST(NULL AS VARCHAR) AS delisting_date")
    for name, sql in FULL_FIELDS:
        if name in _STORED_TYPES:
            sql = f"CAST(CAST({sql} AS DECIMAL({_STORED_TYPES[name]})) AS VARCHAR)"
        columns.append(f"{sql} AS {'data_type' if name == 'type' else name}")
    return f"WITH {_CLEAN}, {_ROUTED} SELECT {', '.join(columns)} FROM routed WHERE outcome = 'stored'"


def _renamed() -> str:
    values = dict(FULL_FIELDS) | {
        "trade_price": "price", "trade_volume": "volume", "change": "change", "timestamp": "event_ms",
        "stream_type": "stream_type", "delisting_date": "CAST(NULL AS VARCHAR)",
    }
    columns = [f"{values[name]} AS {name}" for name in SHORT_TO_LONG.values()]
    one = "'1.00000000'"
    return (
        f"WITH {_CLEAN} SELECT tick_id, code, {', '.join(columns)}, "
        f"{one} AS acc_ask_volume, {one} AS acc_bid_volume FROM clean"
    )


_FLAGS = ("warning", *CAUTION_FLAGS)
_PART_FLAGS = ", ".join(f"p_size > 5 AND p_size & {1 << i} <> 0 AS {flag}" for i, flag in enumerate(_FLAGS))
_NO_FLAGS = ", ".join(f"false AS {flag}" for flag in _FLAGS)

_MARKETS = f"""existing AS (
  SELECT 'P-' || p_partkey AS market, p_name AS korean_name, p_brand AS english_name, {_NO_FLAGS},
         p_type <> 'PROMO' AS is_active FROM part
  UNION ALL
  SELECT 'C-' || c_custkey, c_name, c_mktsegment, {', '.join(['false'] * len(_FLAGS))}, c_acctbal >= 0 FROM customer),
feed AS (
  SELECT 'P-' || p_partkey AS market, CASE WHEN p_type = 'ECONOMY' THEN 'new ' || p_name ELSE p_name END AS korean_name,
         p_brand AS english_name, {_PART_FLAGS}, CASE WHEN p_type = 'ECONOMY' THEN 2 ELSE 1 END AS feed_rows FROM part
  UNION ALL
  SELECT 'S-' || s_suppkey, s_name, s_name, {', '.join(['false'] * len(_FLAGS))}, 1 FROM supplier)"""


def _snapshot(missing_active: str, present_active: str) -> str:
    attributes = ("korean_name", "english_name", *_FLAGS)
    new = ", ".join(f"f.{name} AS {name}" for name in attributes)
    old = ", ".join(f"e.{name}" for name in attributes)
    return f"""WITH {_MARKETS}
SELECT f.market AS market, {new}, {present_active} AS is_active FROM feed f LEFT JOIN existing e ON e.market = f.market
UNION ALL
SELECT e.market, {old}, {missing_active} FROM existing e WHERE e.market NOT IN (SELECT market FROM feed)"""


_NEW = "SELECT market FROM feed EXCEPT SELECT market FROM existing WHERE is_active"
_GONE = "SELECT market FROM existing WHERE is_active EXCEPT SELECT market FROM feed"

_SERVED = """strftime(checked_at, '%Y-%m-%dT%H:%M:%S+00:00') AS checked_at, time_unit, total_collected_count,
       total_error_count, error_rate_percentage, average_latency_ms, max_latency_ms, unique_market_count,
       total_trade_volume_krw"""

_HOURLY = f"WITH {_CLEAN}, {_GLOBAL}, {_health(_HOUR_MS, '1h')}"
_HOURLY_MARKET = f"WITH {_CLEAN}, {_MARKET}, {_market_health(_HOUR_MS, '1h')}"
_WIDE_MOVES = f"WITH {_CLEAN}, {_moves(_SIX_HOURS, _HOUR_MS, _UNPRICED)}"
_TOTALS = f"""WITH {_CLEAN}, {_GLOBAL} SELECT count(*) AS collected,
count(*) FILTER (is_error) AS errors, max(latency_ms) AS max_latency_ms,
round(sum(trade_amount_krw), 2) AS trade_volume_krw FROM judged"""
_MARKET_TOTALS = f"""WITH {_CLEAN}, {_MARKET} SELECT market, count(*) AS collected,
count(*) FILTER (is_error) AS errors, max(latency_ms) AS max_latency_ms FROM judged GROUP BY market"""

ORACLES: dict[str, str] = {
    "tick_parse": _parse(_GLOBAL),
    "tick_parse_by_market": _parse(_MARKET),
    "tick_rename_long": _renamed(),
    "publish_envelope": f"WITH {_CLEAN} SELECT 'unknown' AS key, {_text(False)} AS value FROM clean WHERE fault NOT IN (2, 15)",
    "publish_rejects": f"WITH {_CLEAN} SELECT tick_id, {_text(False)} AS value FROM clean WHERE fault IN (2, 15)",
    "publish_encoded": f"""WITH {_CLEAN} SELECT tick_id, code, price AS trade_price, stream_type,
{dict(FULL_FIELDS)['market_state']} AS market_state, 0 AS without_market FROM clean""",
    "publish_envelope_by_code": f"""WITH {_CLEAN} SELECT CASE WHEN fault IN (5, 6) THEN 'unknown' WHEN fault = 10 THEN 'MKT-NONE'
WHEN fault = 16 THEN '0' ELSE code END AS key, {_text(False)} AS value FROM clean WHERE fault NOT IN (2, 15)""",
    "health_metrics": f"WITH {_CLEAN}, {_GLOBAL}, {_health(_SECOND, '1s')} SELECT * FROM health",
    "health_metrics_hourly": f"{_HOURLY} SELECT * FROM health",
    "health_metrics_stream": f"WITH {_CLEAN}, {_GLOBAL}, {_health(_HOUR_MS, '1h', True)} SELECT * FROM health",
    "health_metrics_appended": f"WITH {_CLEAN}, {_GLOBAL}, {_health(_HOUR_MS, '1h', True)} SELECT * FROM health",
    "market_metrics": f"WITH {_CLEAN}, {_MARKET}, {_market_health(_SECOND, '1s')} SELECT * FROM health",
    "market_metrics_hourly": f"{_HOURLY_MARKET} SELECT * FROM health",
    "market_metrics_stream": f"WITH {_CLEAN}, {_MARKET}, {_market_health(_HOUR_MS, '1h', True)} SELECT * FROM health",
    "health_stream_totals": _TOTALS,
    "market_health_stream_totals": _MARKET_TOTALS,
    "health_timer_totals": _TOTALS,
    "market_health_timer_totals": _MARKET_TOTALS,
    "price_moves": f"WITH {_CLEAN}, {_moves(300000, 60000, _UNPRICED)} SELECT * FROM moves",
    "price_moves_wide": f"{_WIDE_MOVES} SELECT * FROM moves",
    "price_moves_valid_only": f"WITH {_CLEAN}, {_moves(_SIX_HOURS, _HOUR_MS, _UNPRICED + ', 0, 3, 9, 12')} SELECT * FROM moves",
    "price_moves_record_time": f"""WITH {_CLEAN},
{_moves(_SIX_HOURS, _HOUR_MS, '2, 5, 6, 11, 15', time='CASE WHEN fault = 1 THEN ingest_ms ELSE event_ms END')} SELECT * FROM moves""",
    "move_rejects": f"""WITH {_CLEAN} SELECT tick_id AS seq, CASE WHEN fault IN (2, 15) THEN 'no tick'
WHEN fault IN (5, 6) THEN 'no code' WHEN fault = 11 THEN 'no price' ELSE 'no time' END AS reason
FROM clean WHERE fault IN ({_UNPRICED})""",
    "price_moves_stream": f"WITH {_CLEAN}, {_moves(_SIX_HOURS, _HOUR_MS, _UNPRICED, 1000)} SELECT * FROM moves",
    "price_moves_panes_stream": f"WITH {_CLEAN}, {_moves(_SIX_HOURS, _HOUR_MS, _UNPRICED, 1000)} SELECT * FROM moves",
    "price_moves_split_stream": f"WITH {_CLEAN}, {_moves(_SIX_HOURS, _HOUR_MS, _UNPRICED, 1000, splits=4)} SELECT * FROM moves",
    "price_moves_restarted": f"""WITH {_CLEAN}, {_moves(_SIX_HOURS, _HOUR_MS, _UNPRICED, 1000)},
told AS (SELECT market_code, 'closed' AS state FROM moves UNION ALL SELECT market_code, 'open' FROM spans
         WHERE start_ms + {_SIX_HOURS} > (SELECT max(event_ms) FROM priced) - 1000)
SELECT market_code, state, count(*) AS windows, 0 AS late_rows FROM told GROUP BY ALL""",
    "move_status_counts": f"{_WIDE_MOVES} SELECT status, count(*) AS windows FROM moves GROUP BY status",
    "market_moves_referential": f"{_WIDE_MOVES} SELECT * FROM moves WHERE market_code IN (SELECT code FROM clean)",
    "stored_ticks": _stored(),
    "dead_letters": f"""WITH {_CLEAN}, {_ROUTED} SELECT tick_id, {_text(True)} AS raw_data, error_log
FROM routed WHERE outcome = 'dead_letter'""",
    "skipped_ticks": f"""WITH {_CLEAN}, {_ROUTED} SELECT tick_id, {_text(True)} AS raw_data,
CASE fault WHEN 16 THEN '0' ELSE 'MKT-NONE' END AS market_code FROM routed WHERE outcome = 'skipped'""",
    "unstorable_ticks": f"""WITH {_CLEAN}, {_ROUTED} SELECT tick_id, {_text(True)} AS raw_data,
CASE fault WHEN 3 THEN 'trade_volume: missing' WHEN 14 THEN 'market_state: longer than 40' ELSE 'trade_price: not decimal(20,4)' END AS save_error
FROM routed WHERE outcome = 'unstorable'""",
    "outcome_counts": f"WITH {_CLEAN}, {_ROUTED} SELECT outcome, count(*) AS ticks FROM routed GROUP BY outcome",
    "routed_table": f"""WITH {_CLEAN}, {_ROUTED} SELECT outcome, count(*) AS ticks, CAST(1 AS BIGINT) AS load_times
FROM routed GROUP BY outcome""",
    "routed_compacted": f"""WITH {_CLEAN}, {_ROUTED} SELECT outcome, count(*) AS ticks, 8 AS batches, 1 AS compacted
FROM routed GROUP BY outcome""",
    "dead_letter_collapse": f"""WITH {_CLEAN} SELECT '{{"market_code":"' || code || '","tick_id":' || tick_id
|| ',"trade_price":' || price || ',"trade_volume":' || CASE WHEN fault = 3 THEN 'null' ELSE CAST(volume AS VARCHAR) END
|| ',"stream_type":"' || stream_type || '"}}' AS raw_data, 'fault ' || fault AS error_log FROM clean""",
    "market_feed_flat": f"WITH {_MARKETS} SELECT * FROM feed",
    "market_sync_snapshot": _snapshot("false", "true"),
    "market_sync_keep_active": _snapshot("e.is_active", "coalesce(e.is_active, true)"),
    "market_sync_report": f"""WITH {_MARKETS}, created AS (
  SELECT count(*) AS n FROM feed WHERE market NOT IN (SELECT market FROM existing))
SELECT (SELECT n FROM created) AS created_count,
       (SELECT CAST(sum(feed_rows) AS BIGINT) FROM feed) - (SELECT n FROM created) AS updated_count,
       (SELECT count(*) FROM ({_GONE})) AS deactivated_count,
       (SELECT count(*) FROM ({_NEW})) AS new_count, (SELECT count(*) FROM ({_GONE})) AS delisted_count""",
    "market_listing_report": f"""WITH {_MARKETS} SELECT 'new' AS listing, market FROM ({_NEW})
UNION ALL SELECT 'delisted', market FROM ({_GONE})""",
    "market_sync_landed": _snapshot("false", "true"),
    "market_sync_buckets": _snapshot("false", "true"),
    "market_sync_one_change": f"""WITH {_MARKETS}, codes AS (SELECT market FROM existing UNION SELECT market FROM feed)
SELECT 1 AS renamed, count(*) AS markets, 0 AS without_change, 1 AS with_one FROM codes""",
    "market_changes_by_digest": f"""WITH {_MARKETS} SELECT 'new' AS listing, market FROM ({_NEW})
UNION ALL SELECT 'delisted', market FROM ({_GONE})""",
    "market_new_listings": f"WITH {_MARKETS} {_NEW}",
    "market_delistings": f"WITH {_MARKETS} {_GONE}",
    "latest_metric": f"{_HOURLY} SELECT {_SERVED} FROM health h ORDER BY h.checked_at DESC LIMIT 1",
    "recent_metrics": f"{_HOURLY} SELECT {_SERVED} FROM health h ORDER BY h.checked_at DESC LIMIT 60",
    "market_metric_history": f"{_HOURLY_MARKET} SELECT * FROM health ORDER BY market, checked_at DESC",
    "latest_metric_stored": f"{_HOURLY} SELECT {_SERVED} FROM health h ORDER BY h.checked_at DESC LIMIT 1",
    "recent_metrics_stored": f"{_HOURLY} SELECT {_SERVED} FROM health h ORDER BY h.checked_at DESC LIMIT 60",
    "market_history_stored": f"""{_HOURLY_MARKET} SELECT * FROM health WHERE market = 'MKT-VIEW'
AND CAST(checked_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    "recent_response_count": f"{_HOURLY} SELECT least(60, count(*)) AS count, least(60, count(*)) AS results FROM health",
    "latest_response_empty": """SELECT '{"message":"No metric data yet"}' AS body""",
    "experiment_summary": f"""WITH {_CLEAN}, {_GLOBAL}, {_health(_SECOND, '1s')}
SELECT count(*) AS samples, round(avg(total_collected_count), 6) AS mean_throughput,
       max(total_collected_count) AS max_throughput, round(avg(average_latency_ms), 6) AS mean_latency_ms,
       round(quantile_cont(average_latency_ms, 0.95), 6) AS p95_latency_ms, max(max_latency_ms) AS max_latency_ms,
       round(sum(total_error_count) / sum(total_collected_count) * 100, 6) AS error_rate_percentage
FROM health""",
    "experiment_summary_merged": f"""WITH {_CLEAN}, {_GLOBAL}, {_health(_SECOND, '1s')}
SELECT count(*) AS samples, round(avg(total_collected_count), 6) AS mean_throughput,
       max(total_collected_count) AS max_throughput, round(avg(average_latency_ms), 6) AS mean_latency_ms,
       max(max_latency_ms) AS max_latency_ms,
       round(sum(total_error_count) / sum(total_collected_count) * 100, 6) AS error_rate_percentage,
       true AS p95_within_bound
FROM health""",
    "distinct_markets_rolled_up": f"""WITH {_CLEAN}, {_GLOBAL}, valid AS (SELECT * FROM judged WHERE NOT is_error)
SELECT make_timestamp((ingest_ms // 3600000 + 1) * 3600000 * 1000) AS checked_at, '1h' AS time_unit,
       count(DISTINCT market) AS unique_market_count FROM valid GROUP BY ingest_ms // 3600000
UNION ALL
SELECT make_timestamp((ingest_ms // 86400000 + 1) * 86400000 * 1000), '1d', count(DISTINCT market)
FROM valid GROUP BY ingest_ms // 86400000""",
    "monotone_watermark_echo": f"""WITH {_CLEAN} SELECT tick_id, make_timestamp(ingest_ms * 1000) AS ingest_time,
{_text(False)} AS value FROM clean""",
}
