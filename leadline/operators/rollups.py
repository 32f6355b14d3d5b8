"""Published daily tables: no rows of single events or sessions, only aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.functions import any_label, ratio, short_id


def daily_totals(
    df: DataFrame,
    day: str,
    sums: Sequence[str],
    maxima: Sequence[str] = (),
    labels: Mapping[str, str] | None = None,
    rates: Mapping[str, tuple[str, Sequence[str]]] | None = None,
) -> DataFrame:
    """One row by day: sums, maxima, "observed at all" labels, rates of sums.

    Daily p95 columns belong to ``maxima``: the greatest of the parts, not a new
    quantile. ``rates`` is ``{name: (part, [columns whose sum is the whole])}``.
    """

    def whole(columns: Sequence[str]) -> Column:
        total = F.sum(columns[0])
        for name in columns[1:]:
            total = total + F.sum(name)
        return total

    return (
        df.groupBy(day)
        .agg(
            *[F.sum(name).alias(name) for name in sums],
            *[F.max(name).alias(name) for name in maxima],
            *[any_label(F.col(column)).alias(name) for name, column in (labels or {}).items()],
            *[
                ratio(F.sum(part), whole(columns)).alias(name)
                for name, (part, columns) in (rates or {}).items()
            ],
        )
        .withColumn(day, F.col(day).cast("string"))
        .orderBy(day)
    )


def version_table(
    versions: DataFrame, version: str, columns: Sequence[str], days: Sequence[str]
) -> DataFrame:
    """Known versions with shortened ids and days as text, oldest first."""
    return (
        versions.filter(F.col(version).isNotNull())
        .select(
            short_id(F.col(version)).alias(version),
            *[F.col(d).cast("string").alias(d) for d in days],
            *columns,
        )
        .orderBy(*days[:1], version)
    )


def completions_by_target(completions: DataFrame, target: str, ts: str) -> DataFrame:
    """Recorded completions of each named target: how many, and the latest."""
    return (
        completions.filter(F.col(target).isNotNull())
        .groupBy(F.col(target).alias("target_name"))
        .agg(
            F.count("*").alias("recorded_defeat_count"),
            F.max(ts).alias("last_recorded_defeat_at"),
        )
    )


def coverage_window(profile: DataFrame) -> DataFrame:
    """One row: earliest and latest event time over all sources, compared as instants."""
    return profile.agg(
        F.min("earliest_event_time").alias("earliest_event_time"),
        F.max("latest_event_time").alias("latest_event_time"),
    )
