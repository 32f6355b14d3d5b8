"""Data tests: each returns the failing rows, or one row of counts for each rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadline.functions import count_where


def duplicate_ids(df: DataFrame, id: str = "event_id") -> DataFrame:
    """Identifiers stored more than once, and the NULL identifier."""
    return (
        df.groupBy(id)
        .agg(F.count("*").alias("row_count"))
        .filter((F.col("row_count") > 1) | F.col(id).isNull())
    )


def column_checks(
    df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()
) -> DataFrame:
    """One row (check, column_name, failing_rows) for each declared column rule.

    NULLs do not fail ``unique``. A failing row of ``unique`` is one too many.
    """
    rules = [("not_null", name) for name in not_null] + [("unique", name) for name in unique]
    found = df.agg(
        *[count_where(F.col(name).isNull()).alias(f"not_null:{name}") for name in not_null],
        *[(F.count(name) - F.countDistinct(name)).alias(f"unique:{name}") for name in unique],
    )
    rows = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(name).alias("column_name"),
            F.col(f"`{check}:{name}`").alias("failing_rows"),
        )
        for check, name in rules
    ]
    return found.select(F.inline(F.array(*rows)))


def outside_accepted(
    df: DataFrame, column: str, accepted: Sequence[str]
) -> DataFrame:
    """Values outside the accepted list with their row counts; NULL passes."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("row_count"))
    )


def orphans(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Child rows whose key exists in no parent row; NULL keys pass."""
    known = parent.select(F.col(parent_key).alias("_parent"))
    present = child.filter(F.col(child_key).isNotNull())
    return present.join(known, F.col(child_key) == F.col("_parent"), "left_anti")


def quarantine_mismatches(sessions: DataFrame, source_stats: DataFrame) -> DataFrame:
    """Sessions whose quarantined rows differ from their malformed lines."""
    malformed = source_stats.groupBy("session_id").agg(
        F.sum("malformed_rows").alias("malformed_rows")
    )
    return (
        sessions.select("session_id", "quarantined_rows")
        .join(malformed, "session_id")
        .filter(F.col("quarantined_rows") != F.col("malformed_rows"))
    )


def count_mismatches(
    source_stats: DataFrame,
    read: str = "lines_read",
    valid: str = "valid_json_rows",
    malformed: str = "malformed_rows",
    new: str = "new_rows",
    duplicate: str = "duplicate_rows",
) -> DataFrame:
    """Rows in which read is not valid + malformed, or valid not new + duplicate."""
    return source_stats.filter(
        (F.col(read) != F.col(valid) + F.col(malformed))
        | (F.col(valid) != F.col(new) + F.col(duplicate))
    )


def quality_gate(profile: DataFrame) -> DataFrame:
    """One row: no duplicates, no missing times, every source reconciled."""
    return profile.agg(
        F.coalesce(F.bool_and(F.col("duplicate_event_ids") == 0), F.lit(True)).alias(
            "no_duplicates"
        ),
        F.coalesce(F.bool_and(F.col("null_event_times") == 0), F.lit(True)).alias(
            "all_times_known"
        ),
        F.coalesce(F.bool_and("latest_session_reconciled"), F.lit(True)).alias("reconciled"),
    )


def failing(checks: Mapping[str, DataFrame]) -> list[str]:
    """Names of the checks that have at least one failing row."""
    return [name for name, rows in checks.items() if not rows.isEmpty()]
