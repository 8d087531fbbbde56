"""What each registered query must return, as SQL over the same tables."""

from __future__ import annotations

from streamweir.functions.draws import BASE26_DIGITS, LETTERS
from streamweir.plans.queries import (
    AGG_DELAY, CLICK_DELAY, GROUPS, HORIZON, IMPRESSION_DELAY, LIVE_AGG_DELAY, LIVE_GROUPS,
    LIVE_APPEND_DELAY, LIVE_HORIZON, LIVE_SLIDE, LIVE_WINDOW, REFUSALS, REFUSED_DIGITS, REPLAY_BATCHES, SEED, SLIDE, WINDOW,
)
from streamweir.sources.generate import CLICK_LAG, CLICK_PERCENT, MAX_AMOUNT, MAX_ID, WORD_LENGTHS


def _ms(column: str) -> str:
    return f"date_trunc('milliseconds', {column})"


def _seconds(span) -> str:
    return f"interval '{int(span.total_seconds())} seconds'"


VIEWS = "SELECT user_id AS ad, ts FROM events WHERE event_type = 'view'"
CLICKS = "SELECT user_id AS ad, ts FROM events WHERE event_type = 'click'"

CDC = """
SELECT CAST(round(value * 100) AS BIGINT) AS amount, user_id AS id, 'Test' || event_id AS name,
       CASE WHEN event_type IN ('signup', 'purchase') THEN 'I' ELSE 'U' END AS op,
       'Table1' AS "table", ts, props AS value
FROM events"""

CDC_MS = f"SELECT * REPLACE ({_ms('ts')} AS ts) FROM ({CDC})"


def _windows(width: str, delay: str, groups: int, starts: str, rows: str, closed: bool) -> str:
    """``starts`` is the start of a window that holds the row, in terms of ts and k."""
    sql = f"""
SELECT window_start, window_start + interval '{width}' AS window_end, "group",
       CAST(sum(amount) AS BIGINT) AS sum
FROM (SELECT {starts} AS window_start, id % {groups} AS "group", amount
      FROM ({rows}), (VALUES (0), (1)) AS copies(k) WHERE k < {2 if 'k *' in starts else 1})
GROUP BY window_start, "group" """
    if closed:
        sql += f"""
HAVING window_start + interval '{width}'
       <= (SELECT {_ms('max(ts)')} FROM events) - interval '{delay}'"""
    return sql


def _bucket(width: str) -> str:
    return f"time_bucket(interval '{width}', ts)"


def _interval_inner(horizon) -> str:
    return f"""
SELECT i.ad AS "adId", i.ts AS "impressionTime", c.ts AS "clickTime"
FROM ({VIEWS}) i JOIN ({CLICKS}) c
  ON i.ad = c.ad AND c.ts >= i.ts AND c.ts <= i.ts + {_seconds(horizon)}"""


def _interval_left(horizon, views: str = VIEWS, clicks: str = CLICKS) -> str:
    """Pairs, and impressions whose horizon the final watermark has passed."""
    return f"""
SELECT i.ad AS i_ad, i.ts AS i_ts, c.ad AS c_ad, c.ts AS c_ts
FROM ({views}) i LEFT JOIN ({clicks}) c
  ON i.ad = c.ad AND c.ts >= i.ts AND c.ts <= i.ts + {_seconds(horizon)}
WHERE c.ts IS NOT NULL OR i.ts < (
  SELECT least({_ms('max(i.ts)')} - interval '{IMPRESSION_DELAY}',
               {_ms('max(c.ts)')} - interval '{CLICK_DELAY}')
  FROM (SELECT max(ts) AS ts FROM ({views})) i, (SELECT max(ts) AS ts FROM ({clicks})) c
) - {_seconds(horizon)}"""


def _left_columns(sql: str) -> str:
    return f'SELECT i_ad AS "adId", i_ts AS "impressionTime", c_ts AS "clickTime" FROM ({sql})'


JOINED = f"""
SELECT i.ad AS "adId", i.ts AS "impressionTime", c.ts AS "clickTime"
FROM ({VIEWS}) i JOIN ({CLICKS}) c ON i.ad = c.ad"""

SLICED = """
SELECT *, (epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) * 4
          // ((SELECT epoch_us(max(ts)) - epoch_us(min(ts)) + 1 FROM events)) AS slice
FROM events"""


def _pairs_per(keys: str, rows: str) -> str:
    return f"""
SELECT "adId", "impressionTime", "clickTime" FROM (
  SELECT user_id AS "adId", max(ts) FILTER (event_type = 'view') AS "impressionTime",
         max(ts) FILTER (event_type = 'click') AS "clickTime"
  FROM ({rows}) GROUP BY {keys})
WHERE "impressionTime" IS NOT NULL AND "clickTime" IS NOT NULL"""


# Generated values: the digest of (seed, slot, row), as in the generator


def _digest(row: str, slot: str) -> str:
    return f"md5('{SEED}/{slot}/' || {row})"


def _int(row: str, slot: str, low: int, high: int) -> str:
    bits = f"CAST('0x' || substr({_digest(row, slot)}, 1, 12) AS BIGINT)"
    return f"({bits} % {high - low + 1} + {low})"


def _word(row: str, slot: str, length: int) -> str:
    words = []
    for n in range(-(-length // 20)):
        for start in (1, 17):
            number = f"CAST('0x' || substr({_digest(row, f'{slot}{n}')}, {start}, 15) AS BIGINT)"
            words.append(f"right(to_base({number}, 26, 16), 10)")
    text = f"translate({' || '.join(words)}, '{BASE26_DIGITS}', '{LETTERS}')"
    return f"substr({text}, 1, {length})"


def _made(table: str, extra: list[str]) -> str:
    row = "o_orderkey"
    seconds = _int(row, "ts", 0, 365 * 7 * 86400 - 1)
    columns = [
        f"'{table}' AS \"table\"",
        f"CASE {_int(row, 'op', 1, 2)} WHEN 1 THEN 'I' ELSE 'U' END AS op",
        f"TIMESTAMP '2018-01-01' + to_seconds({seconds}) AS ts",
        f"{_int(row, 'id', 1, MAX_ID)} AS id",
        *extra,
    ]
    return f"SELECT {', '.join(columns)} FROM orders"


GEN_CDC = _made("Table1", [
    "'Test' || o_orderkey AS name",
    "'Value' || o_orderkey AS value",
    f"{_int('o_orderkey', 'amount', 1, MAX_AMOUNT)} AS amount",
])
GEN_CDC_WIDE = _made("Table2", [
    f"{_word('o_orderkey', name, length)} AS {name}" for name, length in WORD_LENGTHS.items()
])
GEN_ADS = f"""
SELECT event_id AS "adId", ts AS at, 'impression' AS kind FROM events
UNION ALL
SELECT event_id - {CLICK_LAG}, ts, 'click' FROM events
WHERE {_int('event_id', 'click', 0, 99)} < {CLICK_PERCENT} AND event_id - {CLICK_LAG} > 0"""

AD_PAIRS = f"""
SELECT i.event_id AS "adId", i.ts AS "impressionTime", c.at AS "clickTime"
FROM events i {{}} JOIN (SELECT * FROM ({GEN_ADS}) WHERE kind = 'click') c ON i.event_id = c."adId" """
AD_INNER, AD_LEFT = AD_PAIRS.format(""), AD_PAIRS.format("LEFT")

# Payload text


def _json_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


CDC_PAYLOAD = f"""
'{{"amount":' || amount || ',"id":' || id || ',"name":"' || name || '","op":"' || op
|| '","table":"' || "table" || '","ts":"' || {_json_time('ts')} || '","value":' || to_json(value) || '}}'"""

INT_VIEWS = f"SELECT ad, {_ms('ts')} AS ts, ts + interval '1 second' AS arrival FROM ({VIEWS})"
INT_CLICKS = f"SELECT ad, {_ms('ts')} AS ts, ts + interval '1 second' AS arrival FROM ({CLICKS})"

DATASET_LEFT = f"""
SELECT i_ad AS "impressionAdId", i_ts AS "impressionTime", i_arrival AS arrival_time,
       c_ad AS "clickAdId", c_ts AS "clickTime", c_arrival AS clicks_arrival_time
FROM ({_interval_left(HORIZON, INT_VIEWS, INT_CLICKS).replace(
    'c.ts AS c_ts', 'c.ts AS c_ts, i.arrival AS i_arrival, c.arrival AS c_arrival')})"""


def _topic(topic: str, rows: str, time: str) -> str:
    return f"""
SELECT '{topic}' AS topic, CAST(ad AS VARCHAR) AS "partitionKey",
       '{{"adId":' || ad || ',"{time}":"' || {_json_time('ts')} || '"}}' AS payload
FROM ({rows})"""


ORACLE: dict[str, str] = {
    "scan_count": """
SELECT 'lineitem' AS table_name, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'orders', count(*) FROM orders""",
    "stream_scan": "SELECT * FROM events",
    "rate_micro_batch": """
SELECT event_id, user_id, event_type,
       TIMESTAMP '1970-01-01 00:00:00.1' + to_seconds((row_number() OVER (ORDER BY event_id) - 1)
         // (((SELECT count(*) FROM events) + {batches} - 1) // {batches})) AS replayed_at FROM events""".format(batches=REPLAY_BATCHES),
    "gen_cdc": GEN_CDC,
    "gen_cdc_wide": GEN_CDC_WIDE,
    "gen_ads": GEN_ADS,
    "msg_roundtrip": f"""
SELECT CAST(id AS VARCHAR) AS "partitionKey", {CDC_PAYLOAD} AS payload, * FROM ({CDC_MS})""",
    "msg_decode": f"""
SELECT m.*, e.ts + interval '1 second' AS arrival_time
FROM ({CDC_MS}) m JOIN events e ON m.name = 'Test' || e.event_id""",
    "msg_fetch": f"""
SELECT m.*, e.ts + interval '1 second' AS arrival_time
FROM ({CDC_MS}) m JOIN events e ON m.name = 'Test' || e.event_id""",
    "msg_undecodable": """
SELECT origin, count(*) AS n_messages,
       count(*) FILTER (CASE WHEN json_valid(text) THEN json_extract_string(text, '$.k') END IS NULL)
         AS n_undecodable
FROM (SELECT 'events' AS origin, props AS text FROM events
      UNION ALL SELECT 'conversations', text FROM conversations)
GROUP BY origin""",
    "msg_faults": """
SELECT origin, reason, CASE WHEN reason = 'bad fields' THEN fields ELSE '' END AS fields, count(*) AS n_messages
FROM (
  SELECT origin, fields,
    CASE WHEN text IS NULL THEN 'no payload' WHEN j IS NULL THEN 'not json'
         WHEN json_type(j) <> 'OBJECT' THEN 'not an object' WHEN fields <> '' THEN 'bad fields'
         WHEN coalesce(json_extract_string(j, '$.k'), json_extract_string(j, '$.day')) IS NULL THEN 'no fields' END AS reason
  FROM (
    SELECT *, concat_ws(',',
      CASE WHEN json_extract_string(j, '$.k') IS NOT NULL AND json_type(j, '$.k') NOT IN ('UBIGINT', 'BIGINT') THEN 'k' END,
      CASE WHEN json_extract_string(j, '$.day') IS NOT NULL AND TRY_CAST(json_extract_string(j, '$.day') AS DATE) IS NULL
           THEN 'day' END) AS fields
    FROM (
      SELECT *, CASE WHEN json_valid(text) THEN text END AS j
      FROM (
        SELECT 'props' AS origin, props AS text FROM events
        UNION ALL SELECT 'some props', CASE WHEN event_type = 'view' THEN NULL ELSE props END FROM events
        UNION ALL SELECT 'type', event_type FROM events
        UNION ALL SELECT 'user', CAST(user_id AS VARCHAR) FROM events
        UNION ALL SELECT 'row', '{"k":"' || event_type || '","day":"' || CAST(CAST(ts AS DATE) AS VARCHAR) || '"}' FROM events
        UNION ALL SELECT 'days', '{"k":' || CAST(user_id AS VARCHAR) || ',"day":"' || event_type || '"}' FROM events
        UNION ALL SELECT 'other', '{"user_id":' || CAST(user_id AS VARCHAR) || '}' FROM events))))
GROUP BY origin, reason, 3""",
    "bronze_land": f"""
SELECT 'impression' AS kind, ad AS "adId", ts AS at, arrival AS arrival_time FROM ({INT_VIEWS})
UNION ALL SELECT 'click', ad, ts, arrival FROM ({INT_CLICKS})""",
    "bronze_latency": "SELECT count(*) AS n_rows, count(*) AS n_in_order FROM events WHERE event_type IN ('view', 'click')",
    "agg_global_complete": f"SELECT CAST(sum(amount) AS BIGINT) AS sum FROM ({CDC})",
    "agg_keyed_complete": f"SELECT id, CAST(sum(amount) AS BIGINT) AS sum FROM ({CDC}) GROUP BY id",
    "state_keyed_sums": f"SELECT id, CAST(sum(amount) AS BIGINT) AS sum FROM ({CDC}) GROUP BY id",
    "agg_tumbling": _windows(WINDOW, AGG_DELAY, GROUPS, _bucket(WINDOW), CDC, True),
    "agg_tumbling_live": _windows(LIVE_WINDOW, LIVE_AGG_DELAY, LIVE_GROUPS, _bucket(LIVE_WINDOW), CDC_MS, True),
    "agg_sliding_update": _windows(
        WINDOW, AGG_DELAY, GROUPS, f"{_bucket(SLIDE)} - k * interval '{SLIDE}'", CDC, False),
    "agg_sliding_append": _windows(
        WINDOW, AGG_DELAY, GROUPS, f"{_bucket(SLIDE)} - k * interval '{SLIDE}'", CDC, True),
    "agg_sliding_update_live": _windows(
        LIVE_WINDOW, LIVE_AGG_DELAY, LIVE_GROUPS, f"{_bucket(LIVE_SLIDE)} - k * interval '{LIVE_SLIDE}'", CDC, False),
    "agg_sliding_append_live": _windows(
        LIVE_WINDOW, LIVE_APPEND_DELAY, LIVE_GROUPS, f"{_bucket(LIVE_SLIDE)} - k * interval '{LIVE_SLIDE}'", CDC, True),
    "late_drop": _windows(
        WINDOW, AGG_DELAY, GROUPS, _bucket(WINDOW),
        f"""SELECT c.* FROM ({CDC}) c JOIN ({SLICED}) e ON c.name = 'Test' || e.event_id
            WHERE e.slice <> 1 OR time_bucket(interval '{WINDOW}', c.ts) + interval '{WINDOW}' >
              (SELECT {_ms('max(ts)')} FROM ({SLICED}) WHERE slice = 2) - interval '{AGG_DELAY}'""",
        True),
    "join_interval_inner": _interval_inner(HORIZON),
    "join_interval_left": _left_columns(_interval_left(HORIZON)),
    "join_interval_inner_live": _interval_inner(LIVE_HORIZON),
    "join_interval_left_live": _left_columns(_interval_left(LIVE_HORIZON)),
    "join_stream_unbounded": AD_INNER,
    "join_stream_static": _interval_inner(HORIZON),
    "join_static_refreshed": _interval_inner(HORIZON),
    "join_batch_inner": AD_INNER,
    "join_batch_count": f"SELECT count(*) AS n_rows FROM ({JOINED})",
    "join_batch_left": AD_LEFT,
    "matched_only": f'SELECT * FROM ({AD_LEFT}) WHERE "clickTime" IS NOT NULL',
    "incremental_left": AD_LEFT,
    "reconcile": f"""
SELECT count(*) AS n_truth, count(*) AS n_result, CAST(0 AS BIGINT) AS n_missing,
       CAST(0 AS BIGINT) AS n_surplus
FROM ({AD_LEFT})""",
    "reconcile_hashed": f"""
SELECT *, CAST("adId" % 1000 = 7 AS BIGINT) AS n_missing, CAST("adId" % 1000 = 13 AS BIGINT) AS n_surplus
FROM ({AD_LEFT}) WHERE "adId" % 1000 IN (7, 13)""",
    "bag_difference": """
WITH views AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view'),
     clicks AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click')
SELECT *, 'view' AS surplus_of FROM (SELECT * FROM views EXCEPT ALL SELECT * FROM clicks)
UNION ALL
SELECT *, 'click' AS surplus_of FROM (SELECT * FROM clicks EXCEPT ALL SELECT * FROM views)""",
    "union_streams": f"""
SELECT ad AS "adId", ts AS "eventTime", 'impression' AS kind FROM ({VIEWS})
UNION ALL SELECT ad, ts, 'click' FROM ({CLICKS})""",
    "stateful_join": _pairs_per("user_id", "SELECT * FROM events"),
    "stateful_timeout": _pairs_per("user_id, slice", SLICED),
    "dataset_left_join": DATASET_LEFT,
    "sink_batches": f"""
SELECT count(*) AS n_records, CAST(sum(strlen({CDC_PAYLOAD})) AS BIGINT) AS n_bytes,
       CAST(0 AS BIGINT) AS n_over_limit, CAST(0 AS BIGINT) AS n_loose
FROM ({CDC})""",
    "export_retries": f"""
SELECT digit, count(*) AS n_delivered, count(DISTINCT payload) AS n_payloads,
       CAST(sum(CASE WHEN contains('{REFUSED_DIGITS}', digit) THEN {REFUSALS} ELSE 0 END) AS BIGINT) AS n_refused
FROM (SELECT payload, right(md5(payload), 1) AS digit FROM (SELECT {CDC_PAYLOAD} AS payload FROM ({CDC})))
GROUP BY digit""",
    "export_messages": f"""
{_topic('impressions', VIEWS, 'impressionTime')}
UNION ALL {_topic('clicks', CLICKS, 'clickTime')}""",
    "export_receipts": f"""
SELECT origin, count(*) AS n_records, CAST(sum(strlen({CDC_PAYLOAD})) AS BIGINT) AS n_bytes
FROM ({CDC}), (VALUES ('receipts'), ('messages')) AS origins(origin)
GROUP BY origin""",
}
