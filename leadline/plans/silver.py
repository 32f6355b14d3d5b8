"""Typed event families over the stored events."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.functions import type_json
from leadline.operators.sessions import session_summary

# Payload fields of each family, {column: (path, type)}.
ACTION_FIELDS = {
    "outcome": ("$.outcome", "string"),
    "duration_ms": ("$.duration_ms", "double"),
    "error_code": ("$.error_code", "string"),
}
SUPERVISOR_FIELDS = {
    "engagement_mode": ("$.mode", "string"),
    "phase": ("$.phase", "string"),
    "target_or_action_name": ("$.name", "string"),
    "reason": ("$.reason", "string"),
    "status": ("$.status", "string"),
    "fight_number": ("$.fight", "bigint"),
    "zone_id": ("$.zone_id", "int"),
    "from_zone_id": ("$.from_zone_id", "int"),
    "to_zone_id": ("$.to_zone_id", "int"),
    "target_level": ("$.target_level", "int"),
    "reached_level": ("$.level", "int"),
    "player_hp_percent": ("$.player_hp_percent", "double"),
    "aggro_response_ms": ("$.aggro_response_ms", "double"),
    "handoff_queue_ms": ("$.handoff_queue_ms", "double"),
    "was_handoff": ("$.handoff", "boolean"),
}
NAVIGATION_FIELDS = {
    "outcome": ("$.outcome", "string"),
    "requested_distance": ("$.requested_distance", "double"),
    "displacement": ("$.displacement", "double"),
    "remaining_distance": ("$.remaining", "double"),
    "hp_percent": ("$.hp_percent", "double"),
    "mesh": ("$.mesh", "string"),
}
STATE_FIELDS = {
    "phase": ("$.phase", "string"),
    "status": ("$.status", "string"),
    "active_zone_id": ("$.active_zone_id", "int"),
    "current_target_name": ("$.current_target.name", "string"),
    "configuration_hash": ("$.configuration_hash", "string"),
    "elapsed_seconds": ("$.elapsed_seconds", "bigint"),
    **{
        name: (f"$.counters.{name}", "bigint")
        for name in (
            "exp_earned",
            "gil_earned",
            "fights_completed",
            "deaths",
            "recoveries",
            "proactive_engagements",
            "reactive_engagements",
            "attack_rejections",
            "target_cycle_errors",
            "teleport_while_engaged",
            "zone_transitions",
        )
    },
    "maximum_aggro_response_ms": ("$.metrics.maximum_aggro_response_ms", "double"),
    "maximum_handoff_queue_ms": ("$.metrics.maximum_handoff_queue_ms", "double"),
}


def _family(
    bronze: DataFrame,
    source: str,
    keep: list[str | Column],
    fields: Mapping[str, tuple[str, str]],
    tail: list[str],
) -> DataFrame:
    return type_json(
        bronze.filter(F.col("source") == source), "raw_json", fields, keep, tail
    )


def _day(name: str) -> Column:
    """Days follow the session time zone; the stored partition date does not matter."""
    return F.to_date("event_time").alias(name)


def agent_actions(bronze: DataFrame) -> DataFrame:
    return _family(
        bronze,
        "agent_actions",
        [
            "event_id",
            "event_time",
            _day("event_date"),
            "ingested_at",
            "agent_id",
            F.col("event_type").alias("operation"),
        ],
        ACTION_FIELDS,
        [
            "source_file",
            "source_line_number",
            "source_git_sha",
            "git_sha_provenance",
            "schema_version",
            "raw_json",
        ],
    )


def supervisor_events(bronze: DataFrame) -> DataFrame:
    return _family(
        bronze,
        "farm_supervisor",
        [
            "event_id",
            "event_time",
            _day("event_date"),
            "ingested_at",
            "agent_id",
            "lease_id",
            "event_type",
        ],
        SUPERVISOR_FIELDS,
        [
            "source_file",
            "source_line_number",
            "source_git_sha",
            "git_sha_provenance",
            "schema_version",
            "raw_json",
        ],
    ).withColumn("was_handoff", F.coalesce("was_handoff", F.lit(False)))


def navigation_attempts(bronze: DataFrame) -> DataFrame:
    return _family(
        bronze,
        "navigation",
        ["event_id", "event_time", _day("event_date"), "agent_id"],
        NAVIGATION_FIELDS,
        [
            "source_file",
            "source_line_number",
            "source_git_sha",
            "git_sha_provenance",
            "raw_json",
        ],
    )


def state_snapshots(bronze: DataFrame) -> DataFrame:
    return _family(
        bronze,
        "state_snapshot",
        [
            "event_id",
            F.col("event_time").alias("observed_at"),
            _day("observation_date"),
            "agent_id",
            "lease_id",
        ],
        STATE_FIELDS,
        ["source_git_sha", "git_sha_provenance", "raw_json"],
    )


def fights(supervisor: DataFrame) -> DataFrame:
    return supervisor.filter(F.col("event_type") == "fight_complete").select(
        "event_id",
        "event_time",
        "event_date",
        "lease_id",
        "fight_number",
        F.col("target_or_action_name").alias("target_name"),
        "player_hp_percent",
        "source_git_sha",
        "git_sha_provenance",
    )


def leases(supervisor: DataFrame) -> DataFrame:
    return session_summary(
        supervisor,
        key="lease_id",
        ts="event_time",
        tie="event_id",
        completed=F.col("event_type") == "fight_complete",
        configured=F.when(F.col("event_type") == "farm_supervisor_armed", F.col("zone_id")),
        owner="agent_id",
        version="source_git_sha",
        entity="lease",
        completed_name="completed_fights",
        configured_name="configured_zone_id",
    )


def build_silver(
    bronze: DataFrame,
    store: Callable[[str, DataFrame], DataFrame] = lambda _name, df: df,
) -> dict[str, DataFrame]:
    """The six typed tables; ``store`` may write each one and return it read back."""
    silver: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        silver[name] = store(name, df)
        return silver[name]

    keep("silver_agent_actions", agent_actions(bronze))
    supervisor = keep("silver_supervisor_events", supervisor_events(bronze))
    keep("silver_leases", leases(supervisor))
    keep("silver_fights", fights(supervisor))
    keep("silver_navigation_attempts", navigation_attempts(bronze))
    keep("silver_state_snapshots", state_snapshots(bronze))
    return silver
