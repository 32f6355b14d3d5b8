"""Session summary: an entity derived by grouping events on its identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.functions import count_where, first_by, last_by, seconds_between


def session_summary(
    events: DataFrame,
    key: str,
    ts: str,
    tie: str,
    completed: Column,
    configured: Column,
    owner: str,
    version: str,
    entity: str = "session",
    completed_name: str = "completed_count",
    configured_name: str = "configured_value",
) -> DataFrame:
    """First and last time, duration, counts, and first/last attributes of each key.

    ``configured`` is NULL on rows that do not set the value. Rows without a key are
    left out. All aggregates combine before the shuffle, so a huge session is no
    huge group.
    """
    at, last_tie = F.col(ts), F.col(tie)
    return (
        events.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.min(at).alias(f"{entity}_started_at"),
            F.max(at).alias(f"{entity}_last_event_at"),
            F.count("*").alias("event_count"),
            count_where(completed).alias(completed_name),
            F.max(configured).alias(configured_name),
            first_by(F.col(owner), at, last_tie).alias(owner),
            first_by(F.col(version), at, last_tie).alias(f"starting_{version}"),
            last_by(F.col(version), at, last_tie).alias(f"ending_{version}"),
        )
        .withColumn(
            "observed_duration_seconds",
            seconds_between(F.col(f"{entity}_started_at"), F.col(f"{entity}_last_event_at")),
        )
    )
