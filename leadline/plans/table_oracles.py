"""The same questions as ``table_queries`` in SQL, for comparison."""

from __future__ import annotations

from leadline.plans.tables import EVENTS_SQL

AS_OF = "TIMESTAMP '2024-01-25 12:34:56'"


def _text(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n"


_SESSIONS = """
sessions AS (
  SELECT user_id,
         min(ts) AS session_started_at, max(ts) AS session_last_event_at,
         CAST(count(*) AS BIGINT) AS event_count,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases,
         max(k) FILTER (WHERE event_type = 'signup') AS configured_k,
         arg_min(owner, (ts, event_id)) FILTER (WHERE owner IS NOT NULL) AS owner,
         arg_min(version, (ts, event_id)) FILTER (WHERE version IS NOT NULL)
           AS starting_version,
         arg_max(version, (ts, event_id)) FILTER (WHERE version IS NOT NULL)
           AS ending_version,
         date_diff('second', min(ts), max(ts)) AS observed_duration_seconds
  FROM ev GROUP BY user_id
)
"""

_VELOCITY = """
steps AS (
  SELECT event_id, ts, user_id, k, value, serial,
         lag(ts) OVER one_user AS previous_ts,
         date_diff('second', lag(ts) OVER one_user, ts) AS gap,
         k - lag(k) OVER one_user AS dk,
         value - lag(value) OVER one_user AS dv,
         serial - lag(serial) OVER one_user AS ds
  FROM ev WINDOW one_user AS (PARTITION BY user_id ORDER BY ts, event_id)
),
velocity AS (
  SELECT *, CASE
      WHEN previous_ts IS NULL THEN 'baseline_only'
      WHEN gap <= 0 THEN 'invalid_interval'
      WHEN gap > 43200 THEN 'observation_gap'
      WHEN least(dk, dv, ds) < 0 THEN 'counter_reset'
      WHEN dk = 0 AND dv = 0 AND ds = 0 THEN 'idle_interval'
      WHEN dk <= 0 THEN 'inconsistent_counter'
      ELSE 'observed_delta' END AS metric_quality
  FROM steps
)
"""

_ROLLUP = f"""
periods AS (
  SELECT g AS period_grain, date_trunc(g, CAST(ts AS TIMESTAMP)) AS period_start,
         dk, dv, ds
  FROM velocity, (VALUES ('hour'), ('day'), ('week')) grains(g)
  WHERE metric_quality = 'observed_delta'
),
rollup_rows AS (
  SELECT period_grain, period_start,
         period_start + CASE period_grain WHEN 'hour' THEN INTERVAL 1 HOUR
           WHEN 'day' THEN INTERVAL 1 DAY ELSE INTERVAL 7 DAY END AS period_end,
         CAST(sum(dk) AS BIGINT) AS active_seconds, sum(dv) AS value,
         CAST(sum(ds) AS BIGINT) AS serial, CAST(count(*) AS BIGINT) AS observed_intervals
  FROM periods GROUP BY period_grain, period_start
)
"""

_DAY = "CAST(event_date AS VARCHAR) AS event_date"

_OPERATIONS = """
operations AS (
  SELECT event_date, operation, version,
         CAST(count(*) AS BIGINT) AS operation_count,
         CAST(count(*) FILTER (WHERE outcome = 'ok') AS BIGINT) AS successful_operations,
         CAST(count(*) FILTER (WHERE outcome = 'error') AS BIGINT) AS failed_operations,
         quantile_cont(value, 0.5) AS duration_p50_ms,
         quantile_cont(value, 0.95) AS duration_p95_ms,
         max(value) AS duration_max_ms
  FROM ev GROUP BY event_date, operation, version
),
operation_sums AS (
  SELECT operation, CAST(sum(operation_count) AS BIGINT) AS operation_count,
         CAST(sum(successful_operations) AS BIGINT) AS successful_operations,
         CAST(sum(failed_operations) AS BIGINT) AS failed_operations,
         max(duration_p95_ms) AS duration_p95_ms, max(duration_max_ms) AS duration_max_ms
  FROM operations GROUP BY operation
)
"""

_COUNTS = ",\n".join(
    f"CAST(count(*) FILTER (WHERE event_type = '{kind}') AS BIGINT) AS {name}"
    for name, kind in {
        "clicks": "click",
        "views": "view",
        "purchases": "purchase",
        "signups": "signup",
        "errors": "error",
    }.items()
)

_EVENT_RELIABILITY = f"""
measured AS (
  SELECT event_date, user_id, version, min(provenance) AS provenance,
         {_COUNTS},
         quantile_cont(value, 0.5) FILTER (WHERE event_type = 'click') AS click_p50_ms,
         quantile_cont(value, 0.95) FILTER (WHERE event_type = 'click') AS click_p95_ms,
         max(value) FILTER (WHERE event_type = 'click') AS click_max_ms,
         quantile_cont(CAST(k AS DOUBLE), 0.5) FILTER (WHERE event_type = 'view')
           AS view_p50_ms,
         quantile_cont(CAST(k AS DOUBLE), 0.95) FILTER (WHERE event_type = 'view')
           AS view_p95_ms,
         CAST(max(k) FILTER (WHERE event_type = 'view') AS DOUBLE) AS view_max_ms
  FROM ev GROUP BY event_date, user_id, version
),
sampled AS (
  SELECT event_date, user_id, max(k) AS deaths, max(value) AS recoveries,
         CAST(count(*) AS BIGINT) AS samples
  FROM ev WHERE event_type = 'signup' GROUP BY event_date, user_id
),
reliability AS (
  SELECT m.*, CAST(errors AS DOUBLE) / nullif(clicks + errors, 0) AS rejection_rate,
         deaths, recoveries, coalesce(samples, 0) AS state_snapshot_count,
         CASE WHEN samples > 0 THEN 'state_observer_counter' ELSE 'unavailable' END
           AS state_metric_quality
  FROM measured m LEFT JOIN sampled USING (event_date, user_id)
)
"""

_PROGRESS = """
active AS (SELECT * FROM ev WHERE event_type IN ('click', 'view', 'purchase')),
active_sessions AS (
  SELECT user_id, CAST(count(*) AS BIGINT) AS place,
         date_diff('second', min(ts), max(ts)) AS duration
  FROM active GROUP BY user_id
),
by_event AS (
  SELECT event_date, user_id, version, min(provenance) AS provenance,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS views,
         max(k) FILTER (WHERE event_type = 'view') AS best_view
  FROM active GROUP BY event_date, user_id, version
),
by_sample AS (
  SELECT event_date, user_id,
         arg_max(k, (ts, event_id)) AS place,
         arg_max(version, (ts, event_id)) FILTER (WHERE version IS NOT NULL) AS version,
         arg_max(provenance, (ts, event_id)) AS provenance,
         max(k) AS k, max(serial) AS observed_serial, CAST(count(*) AS BIGINT) AS samples
  FROM ev WHERE event_type IN ('signup', 'error') GROUP BY event_date, user_id
),
progress AS (
  SELECT coalesce(e.event_date, s.event_date) AS event_date,
         coalesce(e.user_id, s.user_id) AS user_id,
         CASE WHEN e.user_id IS NOT NULL THEN coalesce(x.place, s.place) ELSE s.place END
           AS place,
         coalesce(e.version, s.version) AS version,
         coalesce(e.provenance, s.provenance, 'unavailable') AS provenance,
         coalesce(purchases, 0) AS purchases, coalesce(views, 0) AS views, best_view,
         CASE WHEN s.k > 0 THEN coalesce(s.k, purchases, 0) * 3600.0::DOUBLE / s.k
              WHEN x.duration > 0 THEN coalesce(purchases, 0) * 3600.0::DOUBLE / x.duration
         END AS purchases_per_hour,
         observed_serial, coalesce(samples, 0) AS state_snapshot_count,
         CASE WHEN samples > 0 THEN 'state_observer_counter' ELSE 'unavailable' END
           AS coverage_quality
  FROM by_event e FULL JOIN by_sample s
    ON e.event_date = s.event_date AND e.user_id = s.user_id
  LEFT JOIN active_sessions x ON coalesce(e.user_id, s.user_id) = x.user_id
)
"""

_ATTEMPTS = """
lines AS (
  SELECT CAST(l_shipdate AS DATE) AS event_date,
         CASE WHEN l_linenumber <> 7 THEN l_linestatus END AS version,
         l_linestatus, l_returnflag, l_quantity, l_discount
  FROM lineitem
),
unioned AS (
  SELECT CAST(o_orderdate AS DATE) AS event_date, o_custkey AS customer,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderstatus END AS version,
         min(o_orderpriority) AS provenance,
         max(CASE WHEN o_orderkey = 0 THEN -1 ELSE o_orderkey END) AS place,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
         count(*) FILTER (WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')) AS relaxed,
         0 AS tries, 0 AS arrived, 0 AS none, 0 AS returned,
         NULL::DOUBLE AS average_quantity, NULL::DOUBLE AS average_discount
  FROM orders GROUP BY ALL
  UNION ALL BY NAME
  SELECT event_date, version, min(l_linestatus) AS provenance, 0 AS urgent, 0 AS relaxed,
         count(*) AS tries,
         count(*) FILTER (WHERE l_returnflag = 'A') AS arrived,
         count(*) FILTER (WHERE l_returnflag = 'N') AS none,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
         avg(l_quantity) AS average_quantity, avg(l_discount) AS average_discount
  FROM lines GROUP BY event_date, version
),
large AS (
  SELECT event_date AS large_date, version AS large_version, count(*) AS large_lines
  FROM lines WHERE l_quantity > 45 GROUP BY ALL
),
attempts AS (
  SELECT event_date, customer, place, version, provenance,
         CAST(urgent AS BIGINT) AS urgent, CAST(relaxed AS BIGINT) AS relaxed,
         CAST(tries AS BIGINT) AS tries, CAST(arrived AS BIGINT) AS arrived,
         CAST(none AS BIGINT) AS none, CAST(returned AS BIGINT) AS returned,
         CAST(arrived AS DOUBLE) / nullif(tries, 0) AS arrival_rate,
         average_quantity, average_discount,
         CAST(coalesce(large_lines, 0) AS BIGINT) AS large_lines
  FROM unioned LEFT JOIN large
    ON event_date = large_date AND version IS NOT DISTINCT FROM large_version
)
"""

_VERSIONS = """
version_events AS (
  SELECT version, min(provenance) AS provenance,
         CAST(min(event_date) AS VARCHAR) AS first_event_date,
         CAST(max(event_date) AS VARCHAR) AS last_event_date,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS errors
  FROM ev GROUP BY version
),
version_others AS (
  SELECT version, CAST(count(*) AS BIGINT) AS operations,
         CAST(count(*) FILTER (WHERE outcome = 'error') AS BIGINT) AS operation_failures,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS views,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS signups
  FROM ev WHERE version IS NOT NULL GROUP BY version
),
versions AS (
  SELECT e.version, provenance, first_event_date, last_event_date, purchases, clicks, errors,
         round(CAST(errors AS DOUBLE) / nullif(clicks + errors, 0), 6) AS rejection_rate,
         coalesce(operations, 0) AS operations,
         coalesce(operation_failures, 0) AS operation_failures,
         round(CAST(operation_failures AS DOUBLE) / nullif(operations, 0), 6)
           AS failure_rate,
         coalesce(views, 0) AS views, coalesce(signups, 0) AS signups
  FROM version_events e LEFT JOIN version_others o ON e.version = o.version
)
"""

_STATS = """
stats AS (
  SELECT 'events' AS source, strftime(ts, '%Y%m%d') AS session_id,
         CAST(count(*) AS BIGINT) AS lines_read,
         CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS valid_json_rows,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS malformed_rows,
         CAST(count(*) FILTER (WHERE event_type NOT IN ('error', 'view')) AS BIGINT)
           AS new_rows,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS duplicate_rows
  FROM ev GROUP BY ALL
  UNION ALL
  SELECT 'orders', o_orderpriority, count(*),
         count(*) FILTER (WHERE o_orderstatus = 'F'),
         count(*) FILTER (WHERE o_orderstatus = 'O'),
         count(*) FILTER (WHERE o_orderstatus = 'F'), 0
  FROM orders GROUP BY o_orderpriority
)
"""

_PROFILE = """
everything AS (
  SELECT 'events' AS source, CAST(event_id AS VARCHAR) AS id, ts, ts + INTERVAL 1 HOUR AS seen
  FROM ev
  UNION ALL SELECT 'documents', sha256(text), NULL, NULL FROM documents
  UNION ALL SELECT 'conversations',
    CASE WHEN role <> 'system' THEN conv_id || '-' || turn END, NULL, NULL
  FROM conversations
),
profiled AS (
  SELECT source, count(*) AS bronze_rows, count(DISTINCT id) AS distinct_event_ids,
         count(*) - count(id) AS null_event_ids, count(*) - count(ts) AS null_event_times,
         min(ts) AS earliest, max(ts) AS latest, max(seen) AS seen
  FROM everything GROUP BY source
),
profile AS (
  SELECT coalesce(p.source, n.source) AS source,
         CAST(coalesce(bronze_rows, 0) AS BIGINT) AS bronze_rows,
         CAST(coalesce(distinct_event_ids, 0) AS BIGINT) AS distinct_event_ids,
         CAST(coalesce(null_event_ids, 0) AS BIGINT) AS null_event_ids,
         CAST(coalesce(null_event_times, 0) AS BIGINT) AS null_event_times,
         CAST(coalesce(bronze_rows - distinct_event_ids, 0) AS BIGINT)
           AS duplicate_event_ids,
         strftime(earliest, '%Y-%m-%d %H:%M:%S') AS earliest_event_time,
         strftime(latest, '%Y-%m-%d %H:%M:%S') AS latest_event_time,
         strftime(seen, '%Y-%m-%d %H:%M:%S') AS latest_ingested_at,
         coalesce(lines_read, 0) AS latest_session_lines_read,
         coalesce(valid_json_rows, 0) AS latest_session_valid_rows,
         coalesce(malformed_rows, 0) AS latest_session_malformed_rows,
         coalesce(new_rows, 0) AS latest_session_new_rows,
         coalesce(duplicate_rows, 0) AS latest_session_duplicate_rows,
         coalesce(lines_read, 0) = coalesce(valid_json_rows, 0) + coalesce(malformed_rows, 0)
           AS latest_session_reconciled
  FROM profiled p FULL JOIN (
    SELECT * FROM stats s
    WHERE session_id = (SELECT max(session_id) FROM stats t WHERE t.source = s.source)
  ) n ON p.source = n.source
)
"""

_OBSERVED = """
grouped AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS nm_key, count(*) AS suppliers,
         CAST(round(sum(s_acctbal)) AS BIGINT) AS total
  FROM supplier GROUP BY s_nationkey
),
observed AS (
  SELECT nm_key, CASE WHEN total % 2 = 0 THEN 'spawned' ELSE 'primed' END AS seen_status,
         CAST(suppliers AS BIGINT) AS suppliers,
         CASE WHEN total % 3 <> 0 THEN 'alive' ELSE 'unknown' END AS placeholder_status,
         TIMESTAMP '2024-01-25 08:00:00' + to_hours(CAST(suppliers % 5 AS INTEGER)) AS seen_at,
         total % 3 = 0 AS kill_seen
  FROM grouped WHERE suppliers % 2 = 0
),
completed AS (
  SELECT n_name AS target_name, CAST(count(*) AS BIGINT) AS completions,
         max(o_orderdate) AS last_at
  FROM customer JOIN orders ON c_custkey = o_custkey
  JOIN nation ON c_nationkey = n_nationkey
  WHERE c_nationkey % 4 <> 0 GROUP BY n_name
)
"""

_DAILY = f"""
daily AS (
  SELECT {_DAY},
         {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in
                    ("clicks", "views", "purchases", "signups", "errors"))},
         max(click_p95_ms) AS click_p95_ms, max(click_max_ms) AS click_max_ms,
         max(view_p95_ms) AS view_p95_ms, max(view_max_ms) AS view_max_ms,
         max(deaths) AS deaths,
         CASE WHEN bool_or(state_metric_quality = 'state_observer_counter')
              THEN 'state_observer_counter' ELSE 'unavailable' END AS deaths_quality,
         CAST(sum(errors) AS DOUBLE) / nullif(sum(clicks) + sum(errors), 0) AS rejection_rate
  FROM reliability GROUP BY event_date
)
"""

_EV_DAILY = _with(EVENTS_SQL, _EVENT_RELIABILITY, _DAILY)
_LAST_SEVEN = """
recent AS (SELECT * FROM daily ORDER BY event_date DESC LIMIT 7)
"""

ORACLE_SQL: dict[str, str] = {
    "json_typed_projection": """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
       json_extract_string(props, '$.k') AS k_text,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_long,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double,
       json_extract_string(props, '$.no.such') AS absent,
       coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BOOLEAN), FALSE) AS k_flag
FROM events
""",
    "event_identity": """
SELECT event_id,
       sha256('events/log'::BLOB || '\\x00'::BLOB || CAST(event_id AS VARCHAR)::BLOB
              || '\\x00'::BLOB || props::BLOB) AS digest
FROM events
""",
    "dedup_by_content": """
SELECT sha256(text) AS content_id, min(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS copies
FROM documents GROUP BY text
""",
    "new_by_content": """
SELECT doc_id, source FROM documents
WHERE right(source, 1) NOT IN ('0', '2', '4', '6', '8')
  AND text NOT IN (SELECT text FROM documents
                   WHERE right(source, 1) IN ('0', '2', '4', '6', '8'))
""",
    "distinct_new_content": """
SELECT DISTINCT sha256(text) AS content_id FROM documents
WHERE right(source, 1) NOT IN ('0', '2', '4', '6', '8')
  AND text NOT IN (SELECT text FROM documents
                   WHERE right(source, 1) IN ('0', '2', '4', '6', '8'))
""",
    "sessions_by_user": _with(EVENTS_SQL, _SESSIONS)
    + f"""
SELECT * REPLACE ({_text('session_started_at')} AS session_started_at,
                  {_text('session_last_event_at')} AS session_last_event_at)
FROM sessions
""",
    "counter_velocity": _with(EVENTS_SQL, _VELOCITY)
    + f"""
SELECT event_id, {_text('ts')} AS ts, user_id, k, {_text('previous_ts')} AS previous_ts,
       gap AS observation_gap_seconds,
       CASE WHEN metric_quality = 'observed_delta' THEN dk END AS active_seconds,
       round(value, 6) AS session_value,
       CASE WHEN k > 0 THEN round(value * 3600 / k, 6) END AS session_amount_per_active_hour,
       CASE WHEN metric_quality = 'observed_delta' THEN round(dv, 6) END AS value_delta,
       CASE WHEN metric_quality = 'observed_delta' THEN round(dv * 3600 / dk, 6) END
         AS amount_per_active_hour,
       serial AS session_serial,
       CASE WHEN k > 0 THEN round(serial * 3600::DOUBLE / k, 6) END
         AS session_serial_per_active_hour,
       CASE WHEN metric_quality = 'observed_delta' THEN ds END AS serial_delta,
       CASE WHEN metric_quality = 'observed_delta' THEN round(ds * 3600::DOUBLE / dk, 6) END
         AS serial_per_active_hour,
       metric_quality
FROM velocity
""",
    "velocity_rollup": _with(EVENTS_SQL, _VELOCITY, _ROLLUP)
    + f"""
SELECT period_grain, {_text('period_start')} AS period_start,
       {_text('period_end')} AS period_end, period_end <= {AS_OF} AS is_complete,
       active_seconds, round(value, 6) AS value, serial,
       round(value * 3600 / active_seconds, 6) AS amount_per_active_hour,
       round(serial * 3600::DOUBLE / active_seconds, 6) AS serial_per_active_hour,
       observed_intervals
FROM rollup_rows
WHERE period_grain <> 'hour' OR period_start >= {AS_OF} - INTERVAL 10 DAY
""",
    "velocity_current": _with(EVENTS_SQL, _VELOCITY)
    + f"""
SELECT {_text('ts')} AS ts, event_id, k, round(value, 6) AS session_value,
       CASE WHEN k > 0 THEN round(value * 3600 / k, 6) END AS session_amount_per_active_hour,
       metric_quality
FROM velocity ORDER BY velocity.ts DESC, event_id DESC LIMIT 1
""",
    "velocity_periods": _with(EVENTS_SQL, _VELOCITY, _ROLLUP)
    + f"""
SELECT {_text('period_start')} AS period_start, period_end <= {AS_OF} AS is_complete,
       active_seconds, round(value * 3600 / active_seconds, 6) AS amount_per_active_hour
FROM rollup_rows
WHERE period_grain = 'day' AND CAST(period_start AS DATE) BETWEEN '2024-01-05' AND '2024-01-25'
""",
    "operation_reliability_daily": _with(EVENTS_SQL, _OPERATIONS)
    + f"""
SELECT {_DAY}, operation, version, operation_count, successful_operations,
       failed_operations, duration_max_ms,
       round(CAST(successful_operations AS DOUBLE) / operation_count, 6) AS success_rate,
       round(duration_p50_ms, 6) AS duration_p50_ms,
       round(duration_p95_ms, 6) AS duration_p95_ms
FROM operations
""",
    "operation_reliability_total": _with(EVENTS_SQL, _OPERATIONS)
    + """
SELECT operation, operation_count, successful_operations, failed_operations,
       round(CAST(successful_operations AS DOUBLE) / operation_count, 6) AS success_rate,
       round(duration_p95_ms, 6) AS duration_p95_ms, duration_max_ms
FROM operation_sums
""",
    "event_reliability_daily": _with(EVENTS_SQL, _EVENT_RELIABILITY)
    + f"""
SELECT {_DAY}, user_id, version, provenance, clicks, views, purchases, signups, errors,
       round(click_p50_ms, 6) AS click_p50_ms, round(click_p95_ms, 6) AS click_p95_ms,
       round(click_max_ms, 6) AS click_max_ms, round(view_p50_ms, 6) AS view_p50_ms,
       round(view_p95_ms, 6) AS view_p95_ms, CAST(view_max_ms AS BIGINT) AS view_max_ms,
       round(rejection_rate, 6) AS rejection_rate, deaths, recoveries, state_metric_quality,
       state_snapshot_count
FROM reliability
""",
    "event_reliability_once": _with(EVENTS_SQL)
    + f"""
SELECT {_DAY}, CAST(sum(top_k) AS BIGINT) AS deaths,
       CAST(sum(n) AS BIGINT) AS state_snapshot_count
FROM (
  SELECT event_date, user_id,
         max(k) FILTER (WHERE event_type = 'signup') AS top_k,
         count(*) FILTER (WHERE event_type = 'signup') AS n
  FROM ev GROUP BY event_date, user_id
)
GROUP BY event_date
""",
    "progress_by_session": _with(EVENTS_SQL, _PROGRESS)
    + f"""
SELECT {_DAY}, user_id, place, version, provenance, purchases, views,
       round(purchases_per_hour, 6) AS purchases_per_hour, observed_serial,
       coverage_quality, best_view, state_snapshot_count
FROM progress
""",
    "attempts_by_day": _with(_ATTEMPTS)
    + f"""
SELECT {_DAY}, customer, place, version, provenance, urgent, relaxed, tries, arrived, none,
       returned, round(arrival_rate, 6) AS arrival_rate,
       round(average_quantity, 6) AS average_quantity,
       round(average_discount, 6) AS average_discount, large_lines
FROM attempts
""",
    "version_comparison": _with(EVENTS_SQL, _VERSIONS) + "SELECT * FROM versions",
    "version_table": _with(EVENTS_SQL, _VERSIONS)
    + """
SELECT substr('release-' || version, 1, 8) AS version, first_event_date, last_event_date,
       provenance, purchases, rejection_rate, operations
FROM versions WHERE version IS NOT NULL
""",
    "quality_by_source": _with(EVENTS_SQL, _STATS, _PROFILE) + "SELECT * FROM profile",
    "quality_gate": _with(EVENTS_SQL, _STATS, _PROFILE)
    + """
SELECT bool_and(duplicate_event_ids = 0) AS no_duplicates,
       bool_and(null_event_times = 0) AS all_times_known,
       bool_and(latest_session_reconciled) AS reconciled
FROM profile
""",
    "coverage_window": _with(EVENTS_SQL, _STATS, _PROFILE)
    + """
SELECT min(earliest_event_time) AS earliest_event_time,
       max(latest_event_time) AS latest_event_time
FROM profile
""",
    "source_status": _with(EVENTS_SQL, _STATS, _PROFILE)
    + """
SELECT CASE source WHEN 'events' THEN 'Event log' WHEN 'orders' THEN 'Order book'
            ELSE source END AS source,
       bronze_rows AS rows, latest_session_malformed_rows AS malformed,
       CASE WHEN NOT latest_session_reconciled THEN 'Review'
            WHEN source = 'documents' THEN 'Observed' ELSE 'Reconciled' END AS status
FROM profile
""",
    "relationship_check": """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
""",
    "uniqueness_check": """
SELECT sha256(text) AS content_id, CAST(count(*) AS BIGINT) AS row_count
FROM documents GROUP BY text HAVING count(*) > 1
""",
    "column_checks": _with(EVENTS_SQL)
    + """
SELECT 'not_null' AS check_name, 'event_id' AS column_name,
       CAST(count(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS failing_rows FROM ev
UNION ALL SELECT 'not_null', 'version', count(*) FILTER (WHERE version IS NULL) FROM ev
UNION ALL SELECT 'unique', 'event_id', count(event_id) - count(DISTINCT event_id) FROM ev
UNION ALL SELECT 'unique', 'user_id', count(user_id) - count(DISTINCT user_id) FROM ev
""",
    "accepted_values_check": """
SELECT l_returnflag AS value, CAST(count(*) AS BIGINT) AS row_count
FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY l_returnflag
""",
    "reconciliation_check": _with(EVENTS_SQL, _STATS)
    + """
SELECT * FROM stats WHERE lines_read <> valid_json_rows + malformed_rows
   OR valid_json_rows <> new_rows + duplicate_rows
""",
    "quarantine_check": _with(EVENTS_SQL)
    + """
SELECT strftime(ts, '%Y%m%d') AS session_id,
       CAST(count(*) FILTER (WHERE event_type = 'error' AND k <> 13) AS BIGINT)
         AS quarantined_rows,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS malformed_rows
FROM ev GROUP BY 1
HAVING count(*) FILTER (WHERE event_type = 'error' AND k = 13) > 0
""",
    "latest_per_key": f"""
SELECT user_id, event_id, {_text('ts')} AS ts, event_type, value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id
                                       ORDER BY events.ts DESC, event_id DESC) = 1
""",
    "asof_attribution": f"""
SELECT e.event_id, e.user_id, {_text('e.ts')} AS ts, s.event_id AS signup_id
FROM (SELECT * FROM events WHERE event_type = 'error') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s
  ON e.user_id = s.user_id AND e.ts >= s.ts
""",
    "asof_version": """
SELECT e.event_id, p.event_id AS release_id,
       CASE WHEN p.event_id IS NOT NULL THEN 'inferred_from_commit_time'
            ELSE 'unavailable' END AS provenance
FROM events e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.ts >= p.ts
""",
    "change_points": _with(EVENTS_SQL)
    + f"""
SELECT event_id, user_id, {_text('ts')} AS ts, event_type, version,
       previous_event_type, previous_version
FROM (
  SELECT *, lag(event_type) OVER one_user AS previous_event_type,
         lag(version) OVER one_user AS previous_version,
         row_number() OVER one_user AS position
  FROM ev WINDOW one_user AS (PARTITION BY user_id ORDER BY ts, event_id)
) seen
WHERE position = 1 OR event_type <> previous_event_type
   OR version IS DISTINCT FROM previous_version
""",
    "null_safe_join": """
WITH c AS (
  SELECT nullif(c_nationkey, 3) AS nation, c_mktsegment,
         CAST(count(*) AS BIGINT) AS customers
  FROM customer GROUP BY ALL
), s AS (
  SELECT nullif(s_nationkey, 3) AS s_nation, CAST(count(*) AS BIGINT) AS suppliers
  FROM supplier GROUP BY ALL
)
SELECT nation, c_mktsegment, customers, suppliers
FROM c LEFT JOIN s ON nation IS NOT DISTINCT FROM s_nation
""",
    "completions_by_target": _with(_OBSERVED)
    + f"""
SELECT target_name, completions AS recorded_defeat_count,
       {_text('last_at')} AS last_recorded_defeat_at
FROM completed
""",
    "entity_status": _with(_OBSERVED)
    + f"""
SELECT CAST(n_nationkey AS VARCHAR) AS nm_key, n_name AS display_name,
       CASE WHEN seen_at >= {AS_OF} - INTERVAL 2 HOUR THEN seen_status ELSE 'unknown' END
         AS status,
       CASE WHEN seen_at < {AS_OF} - INTERVAL 2 HOUR THEN seen_status END
         AS last_observed_status,
       strftime(seen_at, '%Y-%m-%dT%H:%M:%SZ') AS observed_at,
       coalesce(placeholder_status, 'unknown') AS placeholder_status,
       CASE WHEN last_at IS NOT NULL
                 AND (coalesce(kill_seen, FALSE) = FALSE OR last_at > TIMESTAMP '2024-01-20')
            THEN strftime(last_at, '%Y-%m-%dT%H:%M:%S+00:00')
            WHEN kill_seen THEN '2024-01-20T00:00:00+00:00' END AS last_observed_kill_at,
       suppliers AS effective_chance_percent,
       coalesce(completions, 0) AS recorded_defeat_count,
       CASE WHEN seen_at < {AS_OF} - INTERVAL 2 HOUR THEN 'stale_direct_observation'
            WHEN seen_at IS NOT NULL THEN 'direct_map_observation'
            WHEN completions > 0 THEN 'recorded_defeat_only'
            ELSE 'not_observed' END AS data_quality
FROM nation LEFT JOIN observed ON CAST(n_nationkey AS VARCHAR) = nm_key
LEFT JOIN completed ON n_name = target_name
""",
    "unknown_observed_keys": _with(_OBSERVED)
    + """
SELECT nm_key FROM observed WHERE nm_key NOT IN (
  SELECT CAST(c_nationkey AS VARCHAR) FROM customer
  WHERE c_nationkey IN (SELECT n_nationkey FROM nation)
  GROUP BY c_nationkey HAVING count(*) % 2 = 0)
""",
    "events_daily": _EV_DAILY
    + """
SELECT * REPLACE (round(rejection_rate, 6) AS rejection_rate,
                  round(click_p95_ms, 6) AS click_p95_ms,
                  round(view_p95_ms, 6) AS view_p95_ms,
                  CAST(view_max_ms AS BIGINT) AS view_max_ms)
FROM daily
""",
    "progress_daily": _with(EVENTS_SQL, _PROGRESS)
    + f"""
SELECT {_DAY}, CAST(sum(purchases) AS BIGINT) AS purchases,
       CAST(sum(views) AS BIGINT) AS views,
       CAST(sum(observed_serial) AS BIGINT) AS observed_serial,
       CAST(sum(state_snapshot_count) AS BIGINT) AS state_snapshot_count,
       max(best_view) AS best_view,
       CASE WHEN bool_or(coverage_quality = 'state_observer_counter')
            THEN 'state_observer_counter' ELSE 'unavailable' END AS coverage_quality
FROM progress GROUP BY event_date
""",
    "attempts_daily": _with(_ATTEMPTS)
    + f"""
SELECT {_DAY}, CAST(sum(urgent) AS BIGINT) AS urgent, CAST(sum(relaxed) AS BIGINT) AS relaxed,
       CAST(sum(tries) AS BIGINT) AS tries, CAST(sum(arrived) AS BIGINT) AS arrived,
       CAST(sum(none) AS BIGINT) AS none, CAST(sum(returned) AS BIGINT) AS returned,
       max(large_lines) AS large_lines,
       round(CAST(sum(arrived) AS DOUBLE) / nullif(sum(tries), 0), 6) AS arrival_rate
FROM attempts GROUP BY event_date
""",
    "unpivot_mix": _with(EVENTS_SQL)
    + f"""
SELECT {_DAY}, event_type || 's' AS kind, CAST(count(*) AS BIGINT) AS "count"
FROM ev WHERE event_type IN ('click', 'view') GROUP BY event_date, event_type
""",
    "outcome_totals": """
SELECT CASE l_returnflag WHEN 'A' THEN 'arrived' WHEN 'N' THEN 'none' ELSE 'returned' END
         AS outcome, CAST(count(*) AS BIGINT) AS attempts
FROM lineitem GROUP BY l_returnflag
""",
    "headline_totals": _with(EVENTS_SQL)
    + """
SELECT CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchases,
       CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS errors
FROM ev WHERE event_date BETWEEN '2024-01-05' AND '2024-01-20'
""",
    "success_share": """
SELECT round(avg(CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END), 6) AS success_share
FROM events
""",
    "milestones_by_day": _with(EVENTS_SQL)
    + f"""
SELECT {_DAY}, CAST(count(*) FILTER (WHERE event_type IN ('signup', 'purchase')) AS BIGINT)
         AS milestones
FROM ev GROUP BY event_date
""",
    "top_operations": _with(EVENTS_SQL, _OPERATIONS)
    + """
SELECT operation, operation_count,
       round(CAST(successful_operations AS DOUBLE) / operation_count, 6) AS success_rate,
       round(CAST(operation_count AS DOUBLE) / max(operation_count) OVER (), 6)
         AS relative_volume
FROM (SELECT * FROM operation_sums ORDER BY operation_count DESC, operation LIMIT 5)
""",
    "recent_days_peak": _with(EVENTS_SQL, _EVENT_RELIABILITY, _DAILY, _LAST_SEVEN)
    + """
SELECT event_date, purchases,
       round(CAST(purchases AS DOUBLE) / greatest(max(purchases) OVER (), 1), 6)
         AS relative_height,
       row_number() OVER (ORDER BY purchases DESC, event_date) = 1 AS is_peak,
       round(CAST(purchases - lag(purchases) OVER (ORDER BY event_date) AS DOUBLE)
             / nullif(lag(purchases) OVER (ORDER BY event_date), 0), 6)
         AS change_from_day_before
FROM recent
""",
    "rate_change": _with(EVENTS_SQL, _EVENT_RELIABILITY, _DAILY, _LAST_SEVEN)
    + """
SELECT round(arg_min(coalesce(rejection_rate, 0), event_date), 6) AS first_rate,
       round(arg_max(coalesce(rejection_rate, 0), event_date), 6) AS last_rate,
       round(arg_max(coalesce(rejection_rate, 0), event_date)
             - arg_min(coalesce(rejection_rate, 0), event_date), 6) AS rate_change
FROM recent
""",
    "action_share": """
SELECT event_type || 's' AS action, CAST(count(*) AS BIGINT) AS total,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share
FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY event_type
""",
    "latest_arrivals": _with(_ATTEMPTS)
    + """
SELECT round(CAST(sum(arrived) AS DOUBLE) / sum(tries), 6) AS arrival_rate,
       max(large_lines) AS large_lines
FROM attempts
""",
    "stale_sessions": f"""
SELECT user_id, max(ts) < {AS_OF} - INTERVAL 90 MINUTE AS is_stale
FROM events GROUP BY user_id
""",
    "current_period": _with(EVENTS_SQL, _VELOCITY, _ROLLUP)
    + f"""
SELECT {_text('period_start')} AS period_start, active_seconds, serial
FROM rollup_rows WHERE period_grain = 'week' AND period_end > {AS_OF}
ORDER BY rollup_rows.period_start DESC LIMIT 1
""",
    "completed_periods": _with(EVENTS_SQL, _VELOCITY, _ROLLUP)
    + f"""
SELECT {_text('period_start')} AS period_start, serial
FROM rollup_rows WHERE period_grain = 'week' AND period_end <= {AS_OF}
""",
    "observer_summary": _with(_OBSERVED)
    + f"""
SELECT CASE WHEN max(seen_at) < {AS_OF} - INTERVAL 2 HOUR THEN 'stale' ELSE 'fresh' END
         AS observer_status,
       strftime(max(seen_at), '%Y-%m-%dT%H:%M:%SZ') AS observed_at,
       '2024-01-01T00:00:00Z' AS map_started_at, '01234567' AS ruleset_git_sha,
       (SELECT CAST(count(*) AS BIGINT) FROM nation) AS tracked_nm_count,
       CAST(count(*) AS BIGINT) AS observed_nm_count, 'hourly' AS refresh_cadence
FROM observed
""",
    "findings": """
WITH e AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
         count(*) FILTER (WHERE event_type = 'click') AS clicks,
         count(*) FILTER (WHERE event_type = 'error') AS errors
  FROM events
), l AS (
  SELECT count(*) FILTER (WHERE l_returnflag = 'A') AS a,
         count(*) FILTER (WHERE l_returnflag = 'N') AS n,
         count(*) FILTER (WHERE l_returnflag = 'R') AS r
  FROM lineitem
)
SELECT CAST(purchases AS BIGINT) AS completed_fights,
       round(CAST(errors AS DOUBLE) / (clicks + errors), 6) AS attack_rejection_rate,
       CAST(e.n AS BIGINT) AS operations,
       round(1 - CAST(errors AS DOUBLE) / e.n, 6) AS success_rate,
       CAST(a AS BIGINT) AS successful_collision_probes,
       CAST(l.n AS BIGINT) AS partial_progress_probes, CAST(r AS BIGINT) AS stalled_probes,
       round(CAST(a AS DOUBLE) / (a + l.n + r), 6) AS probe_arrival_rate
FROM e, l
""",
}

# The large branches of operators answer the same questions.
ORACLE_SQL["counter_velocity_sliced"] = ORACLE_SQL["counter_velocity"]
ORACLE_SQL["asof_attribution_sliced"] = ORACLE_SQL["asof_attribution"]
ORACLE_SQL["asof_version_sliced"] = ORACLE_SQL["asof_version"]
ORACLE_SQL["asof_version_by_day"] = ORACLE_SQL["asof_version"]
ORACLE_SQL["change_points_sliced"] = ORACLE_SQL["change_points"]
ORACLE_SQL["change_points_with_holes"] = _with(EVENTS_SQL) + f"""
SELECT event_id, user_id, {_text('ts')} AS ts, event_type, version,
       previous_event_type, previous_version
FROM (
  SELECT *, lag(event_type) OVER one_user AS previous_event_type,
         lag(version) OVER one_user AS previous_version,
         row_number() OVER one_user AS position
  FROM (
    SELECT event_id, event_type, version,
           CASE WHEN user_id % 13 <> 0 THEN user_id END AS user_id,
           CASE WHEN serial % 101 = 0 THEN TIMESTAMP '1970-01-01 00:00:01'
                WHEN serial % 11 <> 0 THEN ts END AS ts
    FROM ev
  ) WINDOW one_user AS (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id)
) seen
WHERE position = 1 OR event_type <> previous_event_type
   OR version IS DISTINCT FROM previous_version
"""
ORACLE_SQL["last_known_with_ties"] = _with(EVENTS_SQL) + """
SELECT e.event_id, CASE WHEN e.serial % 11 <> 0 THEN d.view_id END AS view_id
FROM ev AS e ASOF LEFT JOIN (
  SELECT user_id, date_trunc('day', ts) AS seen_at, event_id AS view_id
  FROM ev WHERE event_type = 'view'
  QUALIFY row_number() OVER (
    PARTITION BY user_id, date_trunc('day', ts)
    ORDER BY CASE WHEN serial % 3 <> 0 THEN k END DESC NULLS LAST, event_id DESC
  ) = 1
) AS d ON e.user_id = d.user_id AND e.ts >= d.seen_at
"""
ORACLE_SQL["operation_reliability_bracketed"] = _with(EVENTS_SQL) + """
SELECT user_id % 5 AS "group", event_type,
       round(quantile_cont(value, 0.5), 6) AS value_p50, round(quantile_cont(value, 0.95), 6) AS value_p95,
       round(quantile_cont(k, 0.5), 6) AS k_p50, round(quantile_cont(k, 0.95), 6) AS k_p95
FROM ev GROUP BY ALL
"""
