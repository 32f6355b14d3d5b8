"""Operation and event reliability with latency quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.functions import count_where, observed_or_unavailable, ratio
from leadline.operators.keys import join_null_safe, reduce_with_label
from leadline.operators.quantiles import ACCURACY, exact_quantiles

LATENCY_QUANTILES = {"p50": 0.50, "p95": 0.95}


def _with_unit(frame: DataFrame, prefixes: Sequence[str], unit: str) -> DataFrame:
    names = {f"{p}_{q}": f"{p}_{q}{unit}" for p in prefixes for q in LATENCY_QUANTILES}
    return frame.withColumnsRenamed(names)


def operation_reliability(
    actions: DataFrame,
    keys: Sequence[str],
    succeeded: Column,
    failed: Column,
    duration: str,
    unit: str = "_ms",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Volume, outcome counts, success rate and duration quantiles by ``keys``."""
    totals = (
        actions.groupBy(*keys)
        .agg(
            F.count("*").alias("operation_count"),
            count_where(succeeded).alias("successful_operations"),
            count_where(failed).alias("failed_operations"),
            F.max(duration).alias(f"duration_max{unit}"),
        )
        .withColumn(
            "success_rate", ratio(F.col("successful_operations"), F.col("operation_count"))
        )
    )
    quantiles = exact_quantiles(
        actions, keys, {"duration": duration}, LATENCY_QUANTILES, accuracy
    )
    return join_null_safe(totals, _with_unit(quantiles, ["duration"], unit), keys, "left")


def operation_totals(
    reliability: DataFrame, operation: str = "operation", unit: str = "_ms"
) -> DataFrame:
    """Operations over all days and versions, by volume.

    The p95 shown is the greatest of the daily ones, not a new quantile.
    """
    count = F.sum("operation_count")
    succeeded = F.sum("successful_operations")
    return (
        reliability.groupBy(operation)
        .agg(
            count.alias("operation_count"),
            succeeded.alias("successful_operations"),
            F.sum("failed_operations").alias("failed_operations"),
            ratio(succeeded, count).alias("success_rate"),
            F.max(f"duration_p95{unit}").alias(f"duration_p95{unit}"),
            F.max(f"duration_max{unit}").alias(f"duration_max{unit}"),
        )
        .orderBy(F.desc("operation_count"), operation)
    )


def event_reliability(
    events: DataFrame,
    samples: DataFrame,
    day: str,
    key: str,
    version: str,
    provenance: str,
    counts: Mapping[str, Column],
    latencies: Mapping[str, str],
    issued: str,
    rejected: str,
    rejection_rate: str,
    state_maxima: Sequence[str],
    sample_day: str | None = None,
    unit: str = "_ms",
    attribute_once: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Event counts and latencies by (day, key, version), with sampled counters joined.

    Sampled counters belong to (day, key). A key with two versions on one day shows
    them on both rows, and later sums count them twice; ``attribute_once`` keeps them
    on the row of the first version only.
    """
    keys = [day, key, version]
    totals = reduce_with_label(
        events,
        keys,
        provenance,
        {name: count_where(condition) for name, condition in counts.items()},
        {f"{prefix}_max{unit}": F.col(column) for prefix, column in latencies.items()},
    )
    quantiles = exact_quantiles(events, keys, latencies, LATENCY_QUANTILES, accuracy)
    measured = join_null_safe(
        totals, _with_unit(quantiles, list(latencies), unit), keys, "left"
    )
    attempts = F.col(issued) + F.col(rejected)
    measured = measured.withColumn(rejection_rate, ratio(F.col(rejected), attempts))
    sampled = (
        samples.withColumnRenamed(sample_day or day, day)
        .groupBy(day, key)
        .agg(
            *[F.max(name).alias(name) for name in state_maxima],
            F.count("*").alias("state_snapshot_count"),
        )
    )
    if attribute_once:
        # Both sides may stem from one table, so the right side's columns are renamed.
        first = totals.groupBy(day, key).agg(
            F.min(F.coalesce(version, F.lit(""))).alias("_first")
        )
        once = sampled.join(first, [day, key]).withColumnsRenamed({day: "_day", key: "_key"})
        match = (
            (F.col(day) == F.col("_day"))
            & (F.col(key) == F.col("_key"))
            & (F.coalesce(version, F.lit("")) == F.col("_first"))
        )
        joined = measured.join(once, match, "left").drop("_day", "_key", "_first")
    else:
        joined = measured.join(sampled, [day, key], "left")
    snapshots = F.coalesce("state_snapshot_count", F.lit(0))
    return joined.withColumns(
        {
            "state_metric_quality": observed_or_unavailable(snapshots),
            "state_snapshot_count": snapshots,
        }
    )
