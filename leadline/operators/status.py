"""Status of a reference list: catalogue, direct observations, recorded completions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadline.functions import (
    age_seconds,
    count_or_zero,
    iso_text,
    parse_with_short_offset,
    short_id,
)
from leadline.operators.keys import side_by_side
from leadline.schemas import OBSERVATION_ROOT, OBSERVATION_ROW

# Staleness and quality labels.
STALE_AFTER_SECONDS = 7200
UNKNOWN = "unknown"
NOT_OBSERVED = "not_observed"
DIRECT = "direct_map_observation"
STALE_DIRECT = "stale_direct_observation"
RECORDED_ONLY = "recorded_defeat_only"
OBSERVER_STATES = ("not_configured", "stale", "fresh")
CADENCE = "hourly"


def unknown_keys(observations: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Observed keys that the catalogue does not have."""
    return observations.select(key).join(catalog.select(key), key, "left_anti")


def entity_status(
    catalog: DataFrame,
    observations: DataFrame | None,
    completions: DataFrame,
    as_of: Column,
    observed_at: Column | None = None,
    key: str = "nm_key",
    display: str = "display_name",
    completion_name: str = "target_name",
    observed_fields: Sequence[str] | None = None,
    field_types: Mapping[str, T.DataType] | None = None,
    stale_after: int = STALE_AFTER_SECONDS,
) -> DataFrame:
    """One row for each catalogue row: observed state, staleness, recorded completions.

    ``observations`` has ``key``, ``status`` and the observed fields, plus
    ``observed_at`` as text unless one instant text is given for all. Beyond
    ``stale_after`` seconds the status is unknown and the last one is kept beside it.
    Completions add a count and may move ``last_observed_kill_at`` forward, but never
    change a status. Of several completions of one name the last one counts, by time and
    then by count, so a catalogue row never multiplies.
    """
    types = {f.name: f.dataType for f in OBSERVATION_ROW.fields if f.name not in (key, "status")}
    types.update(field_types or {})
    fields = list(observed_fields if observed_fields is not None else types)
    if observations is None:
        seen = catalog.select(
            F.col(key).alias("_key"),
            F.lit(None).cast("string").alias("_status"),
            F.lit(None).cast("string").alias("_observed_at"),
            *[F.lit(None).cast(types[name]).alias(f"_o_{name}") for name in fields],
        ).limit(0)
    else:
        when_seen = F.col("observed_at") if observed_at is None else observed_at
        present = set(observations.columns)
        seen = observations.select(
            F.col(key).alias("_key"),
            F.col("status").alias("_status"),
            when_seen.alias("_observed_at"),
            *[
                (F.col(name) if name in present else F.lit(None).cast(types[name])).alias(
                    f"_o_{name}"
                )
                for name in fields
            ],
        )
    recorded = completions.select(
        F.col(completion_name).alias("_name"),
        count_or_zero(F.col("recorded_defeat_count")).alias("_count"),
        parse_with_short_offset(F.col("last_recorded_defeat_at").cast("string")).alias("_when"),
    ).filter(F.col("_name").isNotNull())
    recorded = recorded.groupBy("_name").agg(
        F.max(F.struct("_when", "_count")).alias("_last")
    ).select("_name", "_last.*")
    merged = catalog.join(seen, F.col(key) == F.col("_key"), "left").join(
        recorded, F.col(display) == F.col("_name"), "left"
    )
    was_seen = F.col("_status").isNotNull()
    age = age_seconds(as_of, parse_with_short_offset(F.col("_observed_at")))
    stale = was_seen & (F.coalesce(age, F.lit(float("inf"))) > stale_after)
    observed_kill = F.col("_o_last_observed_kill_at")
    observed_kill_time = parse_with_short_offset(observed_kill)
    later = F.col("_when").isNotNull() & (
        observed_kill_time.isNull() | (F.col("_when") > observed_kill_time)
    )
    count = F.coalesce("_count", F.lit(0).cast("bigint"))
    quality = (
        F.when(stale, F.lit(STALE_DIRECT))
        .when(was_seen, F.lit(DIRECT))
        .when(count > 0, F.lit(RECORDED_ONLY))
        .otherwise(F.lit(NOT_OBSERVED))
    )
    shown = {name: F.col(f"_o_{name}") for name in fields}
    if "placeholder_status" in shown:
        shown["placeholder_status"] = F.coalesce(shown["placeholder_status"], F.lit(UNKNOWN))
    shown["last_observed_kill_at"] = F.when(later, iso_text(F.col("_when"))).otherwise(
        observed_kill
    )
    return merged.select(
        *catalog.columns,
        F.when(was_seen & ~stale, F.col("_status")).otherwise(F.lit(UNKNOWN)).alias("status"),
        F.when(stale, F.col("_status")).alias("last_observed_status"),
        F.col("_observed_at").alias("observed_at"),
        *[column.alias(name) for name, column in shown.items()],
        count.alias("recorded_defeat_count"),
        quality.alias("data_quality"),
    )


def observer_summary(
    catalog: DataFrame,
    root: DataFrame | None,
    observations: DataFrame | None,
    as_of: Column,
    stale_after: int = STALE_AFTER_SECONDS,
) -> DataFrame:
    """One row: state of the observer, its times, counts and short version."""
    tracked = catalog.agg(F.count("*").alias("tracked_nm_count"))
    not_configured, stale, fresh = OBSERVER_STATES
    if root is None or observations is None:
        return tracked.select(
            F.lit(not_configured).alias("observer_status"),
            *[
                F.lit(None).cast("string").alias(name)
                for name in ("observed_at", "map_started_at", "ruleset_git_sha")
            ],
            "tracked_nm_count",
            F.lit(0).cast("bigint").alias("observed_nm_count"),
            F.lit(CADENCE).alias("refresh_cadence"),
        )
    seen = observations.agg(F.count("*").alias("observed_nm_count"))
    age = age_seconds(as_of, parse_with_short_offset(F.col("observed_at")))
    return side_by_side(root.select(*OBSERVATION_ROOT.names), tracked, seen).select(
        F.when(F.coalesce(age, F.lit(float("inf"))) > stale_after, F.lit(stale))
        .otherwise(F.lit(fresh))
        .alias("observer_status"),
        "observed_at",
        "map_started_at",
        short_id(F.col("ruleset_git_sha")).alias("ruleset_git_sha"),
        "tracked_nm_count",
        "observed_nm_count",
        F.lit(CADENCE).alias("refresh_cadence"),
    )
