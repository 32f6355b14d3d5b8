"""The questions of ``view_queries`` in SQL over the tables themselves."""

from __future__ import annotations

from leadline.plans.tables import EVENTS_SQL

_EV = "WITH " + EVENTS_SQL.strip() + "\n"
_TIMES = "strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, strftime(event_date, '%Y-%m-%d 00:00:00') AS event_date"
_COMMON = f"""CAST(event_id AS VARCHAR) AS event_id, {_TIMES}, owner AS agent_id,
       version AS source_git_sha, provenance AS git_sha_provenance"""
_PLACE = "'logs/' || event_type AS source_file, serial AS source_line_number"
_SUPERVISED = """CASE WHEN k % 3 = 0 THEN k ELSE k + 1 END AS fight_number, CAST(k % 101 AS DOUBLE) AS player_hp_percent,
       CAST(user_id AS VARCHAR) AS lease_id"""

ORACLE_SQL: dict[str, str] = {
    "typed_actions": _EV
    + f"""
SELECT {_COMMON}, {_PLACE}, 1 AS schema_version, operation, outcome,
       CASE WHEN k % 9 <> 0 THEN CAST(k AS DOUBLE) END AS duration_ms,
       CASE WHEN event_type = 'error' THEN 'E' || k END AS error_code
FROM ev
""",
    "typed_supervisor_events": _EV
    + f"""
SELECT {_COMMON}, {_PLACE}, 1 AS schema_version, {_SUPERVISED},
       CASE WHEN event_type = 'purchase' THEN 'fight_complete' ELSE event_type END AS event_type,
       'mode' || (k % 3) AS engagement_mode, event_type AS target_or_action_name,
       CAST(k AS INTEGER) AS zone_id, CAST(NULL AS INTEGER) AS to_zone_id,
       CAST(k % 75 AS INTEGER) AS reached_level,
       CASE k % 3 WHEN 1 THEN TRUE WHEN 2 THEN FALSE ELSE FALSE END AS was_handoff
FROM ev
""",
    "typed_fights": _EV
    + f"""
SELECT {_COMMON.replace("owner AS agent_id,", "")}, {_SUPERVISED}, event_type AS target_name
FROM ev WHERE event_type = 'purchase'
""",
    "typed_navigation": _EV
    + f"""
SELECT {_COMMON}, {_PLACE}, outcome, CAST(k + 1 AS DOUBLE) AS requested_distance,
       CASE WHEN k % 9 <> 0 THEN CAST(k AS DOUBLE) END AS displacement,
       CAST(NULL AS DOUBLE) AS remaining_distance, CAST(k % 101 AS DOUBLE) AS hp_percent, 'mesh' || (k % 3) AS mesh
FROM ev
""",
    "attributed_events": _EV
    + """, commits AS (
  SELECT ts, max(sha1(CAST(event_id AS VARCHAR))) AS sha FROM ev
  WHERE event_type = 'purchase' AND serial % 5 <> 0 AND serial % 7 <> 0 GROUP BY ts
)
SELECT CAST(event_id AS VARCHAR) AS event_id, sha AS source_git_sha,
       CASE WHEN sha IS NULL THEN 'unavailable' ELSE 'inferred_from_commit_time' END AS git_sha_provenance
FROM ev ASOF LEFT JOIN commits ON ev.ts >= commits.ts
""",
    "payload_contract": """
SELECT key, count(*) AS failing_rows
FROM events JOIN (VALUES (0, 'agent_id'), (3, 'lease_id'), (4, 'raw_payload'), (5, 'stream_key'), (5, 'bridge_token')) AS planted(digit, key)
  ON event_id % 10 = digit
GROUP BY key
""",
    "refused_observations": """
SELECT c_custkey AS document_id, fault, detail
FROM customer JOIN (VALUES
  (1, 'invalid_status', 'asleep'), (2, 'unexpected_row_field', 'secret'), (3, 'key_repeated', 'nm1'),
  (4, 'key_missing', NULL), (5, 'row_not_object', NULL), (6, 'unreadable_time', NULL),
  (7, 'unexpected_root_field', 'extra'), (8, 'rows_missing', NULL), (9, 'root_not_object', NULL)
) AS planted(digit, fault, detail) ON c_custkey % 10 = digit
""",
    "observation_rows": """
SELECT c_custkey AS document_id, 'nm' || number AS nm_key, 'primed' AS status, c_custkey AS cooldown_remaining_seconds
FROM customer, (VALUES (1), (2)) AS numbers(number) WHERE c_custkey % 10 = 0
""",
    "new_content_once": """
SELECT DISTINCT sha256(text) AS event_id FROM documents
WHERE right(source, 1) <> '0' AND text NOT IN (SELECT text FROM documents WHERE right(source, 1) = '0')
""",
}
