"""Data-quality profile by source, with the latest session's reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadline.functions import count_where
from leadline.operators.ordered import latest_per_key

_STATS = {
    "latest_session_lines_read": "lines_read",
    "latest_session_valid_rows": "valid_json_rows",
    "latest_session_malformed_rows": "malformed_rows",
    "latest_session_new_rows": "new_rows",
    "latest_session_duplicate_rows": "duplicate_rows",
}


def quality_profile(
    events: DataFrame,
    source_stats: DataFrame,
    source: str = "source",
    id: str = "event_id",
    ts: str = "event_time",
    ingested: str = "ingested_at",
    session: str = "session_id",
) -> DataFrame:
    """Counts, distinct ids, NULLs, duplicates and freshness of each source.

    Sources known only to one side still appear. The distinct count shuffles on
    (source, id), so one huge source does not become one huge task.
    """
    profile = events.groupBy(source).agg(
        F.count("*").alias("bronze_rows"),
        F.countDistinct(id).alias("distinct_event_ids"),
        count_where(F.col(id).isNull()).alias("null_event_ids"),
        count_where(F.col(ts).isNull()).alias("null_event_times"),
        F.min(ts).alias("earliest_event_time"),
        F.max(ts).alias("latest_event_time"),
        F.max(ingested).alias("latest_ingested_at"),
    )
    latest = latest_per_key(
        source_stats, [source], session, columns=[session, *_STATS.values()]
    )
    joined = profile.join(latest, source, "full_outer")
    known = {name: F.coalesce(column, F.lit(0)) for name, column in _STATS.items()}
    zero = {
        name: F.coalesce(name, F.lit(0))
        for name in ("bronze_rows", "distinct_event_ids", "null_event_ids", "null_event_times")
    }
    duplicates = F.col("bronze_rows") - F.col("distinct_event_ids")
    return joined.select(
        source,
        *[column.alias(name) for name, column in zero.items()],
        F.coalesce(duplicates, F.lit(0)).alias("duplicate_event_ids"),
        "earliest_event_time",
        "latest_event_time",
        "latest_ingested_at",
        *[column.alias(name) for name, column in known.items()],
        (
            known["latest_session_lines_read"]
            == known["latest_session_valid_rows"] + known["latest_session_malformed_rows"]
        ).alias("latest_session_reconciled"),
    )
