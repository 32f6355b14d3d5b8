"""Version comparison over three measured tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadline.functions import ratio


def by_version(
    events: DataFrame,
    operations: DataFrame,
    attempts: DataFrame,
    version: str,
    provenance: str,
    day: str,
    event_sums: Sequence[str],
    issued: str,
    rejected: str,
    rejection_rate: str,
    operation_count: str,
    operation_failures: str,
    failure_rate: str,
    attempt_sums: Sequence[str],
) -> DataFrame:
    """Sums by version and rates recomputed from the sums.

    Versions come from ``events``; a version seen only elsewhere is left out and the
    NULL version matches nothing. Each table is reduced to versions before joining.
    """
    measured = events.groupBy(version).agg(
        F.min(provenance).alias(provenance),
        F.min(day).alias("first_event_date"),
        F.max(day).alias("last_event_date"),
        *[F.sum(name).alias(name) for name in event_sums],
    )
    run = operations.groupBy(version).agg(
        F.sum("operation_count").alias("_operations"),
        F.sum("failed_operations").alias("_failures"),
    )
    tried = attempts.groupBy(version).agg(*[F.sum(n).alias(n) for n in attempt_sums])
    joined = measured.join(run, version, "left").join(tried, version, "left")
    return joined.select(
        version,
        provenance,
        "first_event_date",
        "last_event_date",
        *event_sums,
        ratio(F.col(rejected), F.col(issued) + F.col(rejected)).alias(rejection_rate),
        F.coalesce("_operations", F.lit(0)).alias(operation_count),
        F.coalesce("_failures", F.lit(0)).alias(operation_failures),
        ratio(F.col("_failures"), F.col("_operations")).alias(failure_rate),
        *[F.coalesce(name, F.lit(0)).alias(name) for name in attempt_sums],
    )
