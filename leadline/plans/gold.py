"""The seven measured tables, as settings of the general operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.operators.attempts import attempt_performance
from leadline.operators.ordered import ROWS_PER_SLICE
from leadline.operators.profile import quality_profile
from leadline.operators.progress import daily_progress
from leadline.operators.quantiles import ACCURACY
from leadline.operators.reliability import event_reliability, operation_reliability
from leadline.operators.velocity import MAX_GAP_SECONDS, counter_velocity
from leadline.operators.versions import by_version

# Which event types count as what.
COUNTERS = {"exp": "exp_earned", "gil": "gil_earned"}
PROGRESS_TYPES = {
    "completed_fights": ("fight_complete",),
    "target_levels_reached": ("target_level_reached",),
    "objective_milestones": ("quest_item_obtained",),
    "zone_transitions": ("zone_transition_complete",),
}
COMBAT_TYPES = {
    "completed_fights": ("fight_complete",),
    "attack_issued": ("attack_issued",),
    "attack_rejections": ("attack_rejected",),
    "target_cycle_errors": ("target_cycle_error",),
    "weapon_skills": ("weapon_skill",),
    "job_abilities": ("job_ability",),
    "combat_spells": ("combat_spell",),
    "supervisor_errors": ("farm_supervisor_error",),
}
ENGAGEMENT_MODES = {
    "proactive_engagements": "proactive",
    "reactive_engagements": "reactive",
}
NAVIGATION_TYPES = {
    "camp_relocations": ("camp_relocated",),
    "zone_transitions": ("zone_transition_complete",),
    "line_of_sight_nudges": ("line_of_sight_nudge",),
    "navigation_failures": (
        "farm_supervisor_error",
        "nm_route_safe_exit_blocked",
        "nm_route_sweep_blocked",
        "nm_route_transition_support_unavailable",
    ),
    "navigation_retries": (
        "line_of_sight_nudge_race",
        "engagement_reissued",
        "reactive_attack_reissued",
        "recovery_command_reissued",
    ),
}
PROBE_OUTCOMES = {
    "successful_collision_probes": "arrived",
    "partial_progress_probes": "partial_progress",
    "stalled_probes": "stalled",
}
PROXY_OPERATION = "service_teleport"
TELEPORT_NOTE = "operation count is a dependency proxy; causality is unavailable"
JOB_NOTE = "job dimension unavailable in current event/state contracts"
VERSION, PROVENANCE = "source_git_sha", "git_sha_provenance"


def _types(table: Mapping[str, tuple[str, ...]]) -> dict[str, Column]:
    return {name: F.col("event_type").isin(*kinds) for name, kinds in table.items()}


def progression_velocity(
    samples: DataFrame,
    max_gap: int = MAX_GAP_SECONDS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    return counter_velocity(
        samples,
        key="lease_id",
        ts="observed_at",
        tie="event_id",
        elapsed="elapsed_seconds",
        counters=COUNTERS,
        entity="lease",
        max_gap=max_gap,
        keep=[
            "observation_date",
            "agent_id",
            "active_zone_id",
            "phase",
            "status",
            VERSION,
            PROVENANCE,
        ],
        rows_per_slice=rows_per_slice,
    )


def operation_performance(actions: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    return operation_reliability(
        actions,
        ["event_date", "operation", VERSION, PROVENANCE],
        F.col("outcome") == "ok",
        F.col("outcome") == "error",
        "duration_ms",
        accuracy=accuracy,
    )


def combat_reliability(
    supervisor: DataFrame,
    samples: DataFrame,
    attribute_once: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    issued = F.col("event_type") == "attack_issued"
    modes = {
        name: issued & (F.col("engagement_mode") == mode)
        for name, mode in ENGAGEMENT_MODES.items()
    }
    return event_reliability(
        supervisor,
        samples,
        day="event_date",
        key="lease_id",
        version=VERSION,
        provenance=PROVENANCE,
        counts={**_types(COMBAT_TYPES), **modes},
        latencies={
            "aggro_response": "aggro_response_ms",
            "handoff_queue": "handoff_queue_ms",
        },
        issued="attack_issued",
        rejected="attack_rejections",
        rejection_rate="attack_rejection_rate",
        state_maxima=["deaths", "recoveries"],
        sample_day="observation_date",
        attribute_once=attribute_once,
        accuracy=accuracy,
    ).withColumnRenamed("state_metric_quality", "death_recovery_metric_quality")


def autonomous_progression(
    supervisor: DataFrame,
    samples: DataFrame,
    leases: DataFrame,
    attribute_once: bool = False,
) -> DataFrame:
    reached = F.when(F.col("event_type") == "target_level_reached", F.col("reached_level"))
    return (
        daily_progress(
            supervisor,
            samples,
            leases,
            key="lease_id",
            day="event_date",
            version=VERSION,
            provenance=PROVENANCE,
            counts=_types(PROGRESS_TYPES),
            maxima={"maximum_level_reached": reached},
            configured="configured_zone_id",
            place="zone_id",
            sample_place="active_zone_id",
            sample_ts="observed_at",
            sample_tie="event_id",
            elapsed="elapsed_seconds",
            sample_counters={"exp_earned": "exp_earned"},
            completed="completed_fights",
            sampled_completed="fights_completed",
            rate="fights_per_hour",
            sample_day="observation_date",
            attribute_once=attribute_once,
        )
        .withColumnRenamed("coverage_quality", "exp_metric_quality")
        .withColumns(
            {"job_name": F.lit(None).cast("string"), "job_metric_note": F.lit(JOB_NOTE)}
        )
    )


def navigation_performance(
    supervisor: DataFrame, probes: DataFrame, actions: DataFrame
) -> DataFrame:
    return attempt_performance(
        supervisor,
        probes,
        actions.filter(F.col("operation") == PROXY_OPERATION),
        day="event_date",
        key="lease_id",
        version=VERSION,
        provenance=PROVENANCE,
        place="zone_id",
        place_value=F.coalesce("zone_id", "from_zone_id", "to_zone_id"),
        event_counts=_types(NAVIGATION_TYPES),
        attempt_count="collision_probes",
        outcome="outcome",
        outcomes=PROBE_OUTCOMES,
        success="successful_collision_probes",
        success_rate="collision_probe_success_rate",
        averages={
            "average_probe_displacement": "displacement",
            "average_remaining_distance": "remaining_distance",
        },
        proxy_count="service_teleport_operations",
    ).withColumn("teleport_metric_note", F.lit(TELEPORT_NOTE))


def performance_by_version(
    combat: DataFrame, operations: DataFrame, navigation: DataFrame
) -> DataFrame:
    return by_version(
        combat,
        operations,
        navigation,
        version=VERSION,
        provenance=PROVENANCE,
        day="event_date",
        event_sums=[
            "completed_fights",
            "attack_rejections",
            "attack_issued",
            "supervisor_errors",
        ],
        issued="attack_issued",
        rejected="attack_rejections",
        rejection_rate="attack_rejection_rate",
        operation_count="mcp_operations",
        operation_failures="mcp_failures",
        failure_rate="mcp_failure_rate",
        attempt_sums=[
            "camp_relocations",
            "zone_transitions",
            "line_of_sight_nudges",
            "navigation_failures",
        ],
    )


Store = Callable[[str, DataFrame], DataFrame]


def unstored(_name: str, df: DataFrame) -> DataFrame:
    return df


def build_gold(
    silver: Mapping[str, DataFrame],
    bronze: DataFrame,
    source_stats: DataFrame,
    store: Store = unstored,
) -> dict[str, DataFrame]:
    """All measured tables; ``store`` may write each one and return it read back."""
    supervisor = silver["silver_supervisor_events"]
    samples = silver["silver_state_snapshots"]
    actions = silver["silver_agent_actions"]
    gold: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        gold[name] = store(name, df)
        return gold[name]

    keep(
        "gold_autonomous_progression",
        autonomous_progression(supervisor, samples, silver["silver_leases"]),
    )
    keep("gold_progression_velocity", progression_velocity(samples))
    combat = keep("gold_combat_reliability", combat_reliability(supervisor, samples))
    operations = keep("gold_mcp_operation_reliability", operation_performance(actions))
    navigation = keep(
        "gold_navigation_performance",
        navigation_performance(supervisor, silver["silver_navigation_attempts"], actions),
    )
    keep(
        "gold_performance_by_git_commit",
        performance_by_version(combat, operations, navigation),
    )
    keep("gold_data_quality", quality_profile(bronze, source_stats))
    return gold
