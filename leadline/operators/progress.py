"""Daily progress: event counts and sampled counters of a session, merged."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.functions import count_where, last_by, observed_or_unavailable, per_hour
from leadline.operators.keys import reduce_with_label


def daily_progress(
    events: DataFrame,
    samples: DataFrame,
    sessions: DataFrame,
    key: str,
    day: str,
    version: str,
    provenance: str,
    counts: Mapping[str, Column],
    maxima: Mapping[str, Column],
    configured: str,
    place: str,
    sample_place: str,
    sample_ts: str,
    sample_tie: str,
    elapsed: str,
    sample_counters: Mapping[str, str],
    completed: str,
    sampled_completed: str,
    rate: str,
    sample_day: str | None = None,
    attribute_once: bool = False,
) -> DataFrame:
    """One row by (day, key, version), with rate fallbacks and a coverage label.

    ``counts`` and ``maxima`` come from events, ``sample_counters``
    (``{new name: column}``) are daily maxima from samples. The rate uses sampled
    elapsed time, else the session's observed duration, else it is NULL. Events are
    reduced before the session table is joined: the session holds one value for each
    key, so the join does not need the rows.
    """
    by_event = reduce_with_label(
        events,
        [day, key, version],
        provenance,
        {name: count_where(condition) for name, condition in counts.items()},
        maxima,
    ).withColumn("_has_events", F.lit(True))
    at, tie = F.col(sample_ts), F.col(sample_tie)
    by_sample = (
        samples.withColumnRenamed(sample_day or day, day)
        .groupBy(day, key)
        .agg(
            last_by(F.col(sample_place), at, tie).alias("_s_place"),
            last_by(F.col(version), at, tie).alias("_s_version"),
            last_by(F.col(provenance), at, tie).alias("_s_provenance"),
            F.max(sampled_completed).alias("_s_completed"),
            F.max(elapsed).alias("_s_elapsed"),
            *[F.max(column).alias(name) for name, column in sample_counters.items()],
            F.count("*").alias("state_snapshot_count"),
        )
    )
    known = sessions.select(
        F.col(key).alias("_session"),
        F.col(configured).alias("_configured"),
        F.col("observed_duration_seconds").alias("_duration"),
    )
    if attribute_once:
        first = by_event.groupBy(day, key).agg(
            F.min(F.coalesce(version, F.lit(""))).alias("_first")
        )
        by_event = by_event.withColumn("_v", F.coalesce(version, F.lit("")))
        by_sample = by_sample.join(first, [day, key], "left")
        extra = F.col("_first").isNull() | (F.col("_v") == F.col("_first"))
        e, s = by_event.alias("e"), by_sample.alias("s")
        on = (F.col(f"e.{day}") == F.col(f"s.{day}")) & (
            F.col(f"e.{key}") == F.col(f"s.{key}")
        ) & extra
    else:
        e, s = by_event.alias("e"), by_sample.alias("s")
        on = (F.col(f"e.{day}") == F.col(f"s.{day}")) & (F.col(f"e.{key}") == F.col(f"s.{key}"))
    merged = e.join(s, on, "full_outer").select(
        F.coalesce(f"e.{day}", f"s.{day}").alias(day),
        F.coalesce(f"e.{key}", f"s.{key}").alias(key),
        "_has_events",
        F.coalesce(f"e.{version}", "_s_version").alias(version),
        F.coalesce(f"e.{provenance}", "_s_provenance", F.lit("unavailable")).alias(provenance),
        *[F.coalesce(f"e.{name}", F.lit(0)).alias(name) for name in counts],
        F.col(f"e.{completed}").alias("_completed"),
        *[F.col(f"e.{name}").alias(name) for name in maxima],
        "_s_place",
        "_s_completed",
        "_s_elapsed",
        *sample_counters,
        F.coalesce("state_snapshot_count", F.lit(0)).alias("state_snapshot_count"),
    )
    joined = merged.join(known, F.col(key) == F.col("_session"), "left")
    from_samples = per_hour(
        F.coalesce("_s_completed", "_completed", F.lit(0)), F.col("_s_elapsed")
    )
    from_session = per_hour(F.coalesce("_completed", F.lit(0)), F.col("_duration"))
    return joined.select(
        day,
        key,
        F.coalesce(F.when(F.col("_has_events"), F.col("_configured")), "_s_place").alias(place),
        version,
        provenance,
        *counts,
        F.when(F.col("_s_elapsed") > 0, from_samples)
        .when(F.col("_duration") > 0, from_session)
        .alias(rate),
        *sample_counters,
        observed_or_unavailable(F.col("state_snapshot_count")).alias("coverage_quality"),
        *maxima,
        "state_snapshot_count",
    )
