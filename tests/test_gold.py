"""Typed and measured tables on literal events: NULL keys, fan-out, fallbacks, versions."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leadline.plans import gold, silver
from leadline.plans.contracts import table_report
from leadline.schemas import BRONZE, SOURCE_STATS

DAY = dt.datetime(2026, 7, 30, 10)
INGESTED = dt.datetime(2026, 7, 31)


def _row(number, source, kind, seconds, sha="v1", lease=None, **payload):
    return (
        f"e{number}", None if seconds is None else DAY + dt.timedelta(seconds=seconds), INGESTED,
        source, "f", number, kind, 1, "agent", lease, sha, "observed" if sha else "unavailable",
        "fp", "s1", json.dumps(payload),
    )


SUPERVISOR = [
    ("farm_supervisor_armed", 0, "v1", "L1", {"zone_id": 100}),
    ("attack_issued", 1, "v1", "L1", {"mode": "proactive", "aggro_response_ms": 10}),
    ("attack_issued", 2, "v2", "L1", {"mode": "reactive", "aggro_response_ms": "30"}),
    ("attack_rejected", 3, "v2", "L1", {}),
    ("fight_complete", 4, "v1", "L1", {"name": "Rat", "fight": 1, "player_hp_percent": 50}),
    ("fight_complete", 1800, "v2", "L1", {"name": "Rat", "fight": "2"}),
    ("target_level_reached", 5, "v1", "L1", {"level": 9}),
    ("quest_item_obtained", 6, "v1", "L1", {}),
    ("zone_transition_complete", 7, "v1", "L1", {"from_zone_id": 1, "to_zone_id": 2}),
    ("fight_complete", 8, None, None, {"name": None, "handoff": "yes"}),
    ("fight_complete", 0, "v1", "L2", {"name": "Bat"}),
    ("fight_complete", 3600, "v1", "L2", {"name": "Bat"}),
    ("line_of_sight_nudge_race", 9, "v1", "L2", {}),
    ("farm_supervisor_error", 10, "v1", "L2", {}),
]


@pytest.fixture(scope="module")
def tables(spark):
    rows = [
        _row(i, "farm_supervisor", kind, seconds, sha, lease, **payload)
        for i, (kind, seconds, sha, lease, payload) in enumerate(SUPERVISOR)
    ]
    for i, (outcome, ms, sha) in enumerate(
        [("ok", 1, "v1"), ("ok", 2, "v1"), ("error", 10, "v1"), ("ok", None, "v3"), (None, "x", None)]
    ):
        rows.append(_row(100 + i, "agent_actions", "move", i, sha, outcome=outcome, duration_ms=ms))
    rows.append(_row(110, "agent_actions", "service_teleport", 1, None, outcome="ok"))
    for i, outcome in enumerate(["Arrived", "partial_progress", "stalled", None, "arrived"]):
        rows.append(_row(200 + i, "navigation", "navigation_probe", i, None, outcome=outcome,
                         displacement=i, remaining=1))
    for i, (seconds, lease, exp, elapsed, fights) in enumerate(
        [(0, "L1", 0, 600, 1), (600, "L1", 90, 1200, 3), (0, "L3", 5, None, None), (0, None, 1, 1, 1)]
    ):
        rows.append(_row(300 + i, "state_snapshot", "state_snapshot", seconds, "v1", lease,
                         active_zone_id=7 + i, elapsed_seconds=elapsed, current_target={"name": "T"},
                         counters={"exp_earned": exp, "gil_earned": 1, "deaths": 2,
                                   "fights_completed": fights}))
    rows.append(_row(400, "agent_actions", "move", None, "v1", outcome="ok"))
    bronze = spark.createDataFrame(rows, BRONZE)
    stats = spark.createDataFrame(
        [("s1", "navigation", 1, 1, 9, 9, 0, 9, 0), ("s2", "navigation", 1, 1, 6, 5, 0, 5, 0),
         ("s1", "gone", 1, 1, 1, 1, 0, 1, 0)],
        SOURCE_STATS,
    )
    found = silver.build_silver(bronze)
    return {**found, **gold.build_gold(found, bronze, stats), "bronze": bronze}


def _by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_typed_families(tables):
    events = _by(tables["silver_supervisor_events"], "event_id")
    assert events[("e0",)]["zone_id"] == 100 and events[("e0",)]["was_handoff"] is False
    assert events[("e2",)]["aggro_response_ms"] == 30.0
    assert events[("e5",)]["fight_number"] == 2
    assert events[("e9",)]["was_handoff"] is True
    actions = _by(tables["silver_agent_actions"], "event_id")
    assert actions[("e104",)]["duration_ms"] is None and actions[("e100",)]["operation"] == "move"
    states = _by(tables["silver_state_snapshots"], "event_id")
    assert states[("e300",)]["current_target_name"] == "T"
    assert str(states[("e300",)]["observation_date"]) == "2026-07-30"
    fights = tables["silver_fights"].collect()
    assert len(fights) == 5 and {r["target_name"] for r in fights} == {"Rat", "Bat", None}


def test_sessions(tables):
    leases = _by(tables["silver_leases"], "lease_id")
    assert set(leases) == {("L1",), ("L2",)}
    first = leases[("L1",)]
    assert (first["configured_zone_id"], first["completed_fights"], first["event_count"]) == (100, 2, 9)
    assert first["observed_duration_seconds"] == 1800
    assert (first["starting_source_git_sha"], first["ending_source_git_sha"]) == ("v1", "v2")


def test_progression_fan_out_and_fallbacks(tables):
    rows = _by(tables["gold_autonomous_progression"], "lease_id", "source_git_sha")
    # A session with two versions shows its sampled counters on both rows.
    assert rows[("L1", "v1")]["exp_earned"] == rows[("L1", "v2")]["exp_earned"] == 90
    assert rows[("L1", "v1")]["fights_per_hour"] == 3 * 3600.0 / 1200
    assert rows[("L1", "v1")]["zone_id"] == 100
    assert rows[("L1", "v1")]["maximum_level_reached"] == 9
    assert rows[("L1", "v1")]["objective_milestones"] == 1
    # Without samples the session's duration counts.
    assert rows[("L2", "v1")]["fights_per_hour"] == 2.0
    assert rows[("L2", "v1")]["exp_metric_quality"] == "unavailable"
    # Only samples: no elapsed time, no session, no rate.
    assert rows[("L3", "v1")]["fights_per_hour"] is None
    assert (rows[("L3", "v1")]["zone_id"], rows[("L3", "v1")]["completed_fights"]) == (9, 0)
    # A NULL key never matches, so events and samples stay apart.
    assert rows[(None, None)]["completed_fights"] == 1
    assert rows[(None, None)]["state_snapshot_count"] == 0
    assert rows[(None, "v1")]["state_snapshot_count"] == 1


def test_attribute_once(tables):
    once = gold.autonomous_progression(
        tables["silver_supervisor_events"], tables["silver_state_snapshots"],
        tables["silver_leases"], attribute_once=True,
    )
    rows = _by(once, "lease_id", "source_git_sha")
    assert rows[("L1", "v1")]["exp_earned"] == 90 and rows[("L1", "v2")]["exp_earned"] is None
    assert rows[("L3", "v1")]["state_snapshot_count"] == 1
    combat = gold.combat_reliability(
        tables["silver_supervisor_events"], tables["silver_state_snapshots"], attribute_once=True
    )
    assert {r["deaths"] for r in combat.filter("lease_id = 'L1'").collect()} == {2, None}


def test_combat(tables):
    rows = _by(tables["gold_combat_reliability"], "lease_id", "source_git_sha")
    first, second = rows[("L1", "v1")], rows[("L1", "v2")]
    assert (first["proactive_engagements"], first["attack_issued"]) == (1, 1)
    assert (second["reactive_engagements"], second["attack_rejection_rate"]) == (1, 0.5)
    assert first["aggro_response_p95_ms"] == 10.0 and first["handoff_queue_p50_ms"] is None
    assert first["deaths"] == second["deaths"] == 2
    assert first["death_recovery_metric_quality"] == "state_observer_counter"
    assert rows[(None, None)]["death_recovery_metric_quality"] == "unavailable"
    assert rows[("L2", "v1")]["attack_rejection_rate"] is None


def test_operations(tables):
    rows = _by(tables["gold_mcp_operation_reliability"], "operation", "source_git_sha", "event_date")
    day = DAY.date()
    row = rows[("move", "v1", day)]
    assert (row["operation_count"], row["successful_operations"], row["failed_operations"]) == (3, 2, 1)
    assert row["success_rate"] == 2 / 3 and row["duration_p50_ms"] == 2.0
    assert row["duration_p95_ms"] == pytest.approx(9.2) and row["duration_max_ms"] == 10.0
    assert rows[("move", "v3", day)]["duration_p95_ms"] is None
    assert rows[("move", None, day)]["operation_count"] == 1
    assert rows[("move", "v1", None)]["operation_count"] == 1


def test_navigation(tables):
    rows = _by(tables["gold_navigation_performance"], "lease_id", "source_git_sha", "collision_probes")
    probes = rows[(None, None, 5)]
    assert (probes["successful_collision_probes"], probes["collision_probe_success_rate"]) == (2, 0.4)
    assert (probes["partial_progress_probes"], probes["stalled_probes"]) == (1, 1)
    assert probes["average_probe_displacement"] == 2.0
    # The proxy of the NULL version stands on both rows of that day and version.
    assert probes["service_teleport_operations"] == 1
    assert rows[(None, None, 0)]["service_teleport_operations"] == 1
    second = rows[("L2", "v1", 0)]
    assert (second["navigation_failures"], second["navigation_retries"]) == (1, 1)
    assert second["collision_probe_success_rate"] is None
    assert rows[("L1", "v1", 0)]["zone_id"] == 100


def test_versions(tables):
    rows = _by(tables["gold_performance_by_git_commit"], "source_git_sha")
    assert set(rows) == {("v1",), ("v2",), (None,)}
    assert rows[("v1",)]["mcp_operations"] == 4 and rows[("v2",)]["mcp_operations"] == 0
    assert rows[("v2",)]["mcp_failure_rate"] is None
    assert rows[(None,)]["mcp_operations"] == 0
    assert rows[("v2",)]["attack_rejection_rate"] == 0.5


def test_quality_profile(tables):
    rows = _by(tables["gold_data_quality"], "source")
    navigation = rows[("navigation",)]
    assert (navigation["bronze_rows"], navigation["latest_session_lines_read"]) == (5, 6)
    assert navigation["latest_session_reconciled"] is False
    assert rows[("gone",)]["bronze_rows"] == 0 and rows[("gone",)]["earliest_event_time"] is None
    assert rows[("agent_actions",)]["null_event_times"] == 1
    assert rows[("state_snapshot",)]["latest_session_reconciled"] is True


def test_declared_rules(tables):
    found = table_report({k: v for k, v in tables.items() if k != "bronze"})
    broken = {
        (r["table_name"], r["column_name"], r["check_name"])
        for r in found.filter("failing_rows > 0").collect()
    }
    assert broken == {
        ("silver_agent_actions", "event_time", "not_null"),
        ("gold_mcp_operation_reliability", "event_date", "not_null"),
    }
    names = found.filter(F.col("check_name") == "relationship")
    assert names.first()["failing_rows"] == 0
