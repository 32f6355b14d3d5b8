"""The same questions as ``log_queries`` in SQL over the tables themselves."""

from __future__ import annotations

from leadline.plans.tables import EVENTS_SQL

_EV = "WITH " + EVENTS_SQL.strip() + "\n"
_SECONDS = "'%Y-%m-%d %H:%M:%S'"

ORACLE_SQL: dict[str, str] = {
    "stream_flushes": f"""
WITH stepped AS (
  SELECT user_id, ts, event_id % 2 AS lease, event_type,
         lag(event_id % 2) OVER w AS lease_before, lag(event_type) OVER w AS type_before, row_number() OVER w AS place
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), last_change AS (
  SELECT user_id, max(place) AS upto FROM stepped
  WHERE lease IS DISTINCT FROM lease_before OR event_type IS DISTINCT FROM type_before GROUP BY user_id
)
SELECT 'states/' || user_id AS source_file, count(*) AS samples, strftime(max(ts), {_SECONDS}) AS latest,
       count(DISTINCT (lease, event_type)) AS states
FROM stepped JOIN last_change USING (user_id) WHERE place <= upto GROUP BY user_id
""",
    "stream_repeats": """
SELECT event_type, count(*) AS events, round(sum(value), 6) AS sum_value FROM events GROUP BY event_type
""",
    "replaced_partitions": """
SELECT event_type,
       CASE event_type WHEN 'error' THEN 'deleted' WHEN 'click' THEN 'written' WHEN 'signup' THEN 'written' ELSE 'kept' END AS action,
       CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS rows,
       CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN round(sum(value + 1), 6) ELSE round(sum(value), 6) END AS sum_value
FROM events GROUP BY event_type
""",
    "ingest_resume": _EV
    + """, placed AS (
  SELECT serial % 8 AS part, (serial // 8) % 12 AS file,
         ['appended', 'rewritten', 'shortened'][(serial // 8) % 12 % 3 + 1] AS action FROM ev
), read AS (
  SELECT action, 'session1' AS session_id, file, FALSE AS resumed, TRUE AS fresh FROM placed WHERE part < 4
  UNION ALL
  SELECT action, 'session2', file, action = 'appended', action <> 'shortened' FROM placed
  WHERE CASE action WHEN 'appended' THEN part >= 4 WHEN 'rewritten' THEN part < 4 ELSE part < 2 END
)
SELECT action, session_id, count(DISTINCT file) AS files,
       count(DISTINCT file) FILTER (resumed) AS resumed_files,
       count(*) AS lines_read, count(*) AS valid_json_rows,
       count(*) FILTER (fresh) AS new_rows, count(*) FILTER (NOT fresh) AS duplicate_rows,
       TRUE AS hashed_growth_only
FROM read GROUP BY action, session_id
""",
    "ingest_roundtrip": _EV
    + f"""
SELECT event_type, CAST(event_date AS VARCHAR) AS event_date,
       'observed_at_ingestion' AS git_sha_provenance,
       CAST(count(*) AS BIGINT) AS stored_rows, CAST(count(*) AS BIGINT) AS distinct_ids,
       CAST(sum(k) AS BIGINT) AS sum_k, round(sum(value), 6) AS sum_value,
       strftime(max(ts), {_SECONDS}) AS latest
FROM ev WHERE event_type <> 'error' GROUP BY event_type, event_date
""",
    "ingest_reconciliation": """
SELECT 'event_log' AS source, session, CAST(count(*) AS BIGINT) AS lines_read,
       CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS valid_json_rows,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS malformed_rows,
       CAST(count(*) FILTER (WHERE event_type <> 'error' AND session = 'first') AS BIGINT)
         AS new_rows,
       CAST(count(*) FILTER (WHERE event_type <> 'error' AND session = 'second') AS BIGINT)
         AS duplicate_rows
FROM events, (VALUES ('first'), ('second')) sessions(session)
GROUP BY session
""",
    "quarantined_lines": """
SELECT 'JSONDecodeError' AS error_type,
       substr('{"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 20) AS line,
       CAST(2 * count(*) AS BIGINT) AS times, CAST(2 AS BIGINT) AS sessions
FROM events WHERE event_type = 'error' GROUP BY ALL
""",
    "stream_ingest": f"""
SELECT 'hour' AS period_grain, strftime(date_trunc('hour', ts), {_SECONDS}) AS period_start,
       CAST(count(*) AS BIGINT) AS stored_rows
FROM events WHERE event_type <> 'error' GROUP BY ALL
""",
    "week_buckets": _EV
    + f"""
SELECT strftime(date_trunc('week', ts), {_SECONDS}) AS period_start,
       strftime(date_trunc('week', ts) + INTERVAL 7 DAY, {_SECONDS}) AS period_end,
       CAST(count(*) AS BIGINT) AS events, CAST(sum(k) AS BIGINT) AS sum_k
FROM ev GROUP BY ALL
""",
    "state_rows": _EV
    + f"""
SELECT strftime(ts, {_SECONDS}) AS observed_at, CAST(user_id AS VARCHAR) AS lease_id,
       event_type AS phase, k AS elapsed_seconds, k AS exp_earned, serial AS gil_earned,
       sha256('{{"maximum_fights":' || CAST(k % 5 AS VARCHAR) || '}}') AS configuration_hash,
       'unavailable' AS git_sha_provenance
FROM ev
""",
    "snapshot_rows": """
SELECT 'table_' || name AS source, 'table/' || name AS source_file,
       'database_snapshot' AS event_type, raw_json
FROM (
  SELECT 'customer' AS name, '{"c_custkey":' || c_custkey || ',"c_mktsegment":"'
    || c_mktsegment || '"}' AS raw_json FROM customer
  UNION ALL SELECT 'supplier', '{"s_name":"' || s_name || '","s_suppkey":' || s_suppkey || '}'
  FROM supplier
  UNION ALL SELECT 'nation', '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey
    || ',"n_regionkey":' || n_regionkey || '}' FROM nation
  UNION ALL SELECT 'orders', '{"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
    || '","o_orderkey":' || o_orderkey || '}' FROM orders
)
""",
    "snapshot_whole_rows": """
SELECT 'table_' || name AS source, 'table/' || name AS source_file,
       'database_snapshot' AS event_type, raw_json
FROM (
  SELECT 'customer' AS name, '{"c_acctbal":' || c_acctbal || ',"c_custkey":' || c_custkey
    || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","c_nationkey":'
    || c_nationkey || '}' AS raw_json FROM customer
  UNION ALL SELECT 'supplier', '{"s_acctbal":' || s_acctbal || ',"s_name":"' || s_name
    || '","s_nationkey":' || s_nationkey || ',"s_suppkey":' || s_suppkey || '}' FROM supplier
  UNION ALL SELECT 'nation', '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey
    || ',"n_regionkey":' || n_regionkey || '}' FROM nation
  UNION ALL SELECT 'orders', '{"o_custkey":' || o_custkey || ',"o_orderdate":"'
    || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","o_orderkey":' || o_orderkey
    || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus
    || '","o_totalprice":' || o_totalprice || '}' FROM orders
)
""",
    "contract_report": _EV
    + """
SELECT 'events_daily' AS dataset, '' AS missing_fields,
       CAST(count(DISTINCT event_date) AS BIGINT) AS row_count, TRUE AS passed FROM ev
UNION ALL SELECT 'sessions', 'agent', count(DISTINCT user_id), FALSE FROM ev
UNION ALL SELECT 'current', '', 1, FALSE
""",
}
