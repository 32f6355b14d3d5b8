"""Counter velocity: deltas between samples of cumulative counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.functions import per_hour, seconds_between
from leadline.operators.ordered import ROWS_PER_SLICE, latest_row, previous_rows

# The longest gap, and the labels in order of precedence.
MAX_GAP_SECONDS = 4500
QUALITY_LABELS = (
    "unavailable",
    "baseline_only",
    "invalid_interval",
    "observation_gap",
    "counter_reset",
    "idle_interval",
    "inconsistent_counter",
    "observed_delta",
)
GOOD = "observed_delta"


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions)


def interval_quality(
    required: Sequence[Column],
    previous_time: Column,
    gap: Column,
    active: Column,
    deltas: Sequence[Column],
    max_gap: int,
) -> Column:
    """The first label of ``QUALITY_LABELS`` whose condition holds."""
    conditions = (
        _any([column.isNull() for column in required]),
        previous_time.isNull(),
        gap <= 0,
        gap > max_gap,
        _any([change < 0 for change in (active, *deltas)]),
        _all([change == 0 for change in (active, *deltas)]),
        active <= 0,
        F.lit(True),
    )
    label = F.lit(None).cast("string")
    for name, condition in reversed(list(zip(QUALITY_LABELS, conditions))):
        label = F.when(condition, F.lit(name)).otherwise(label)
    return label


def counter_velocity(
    samples: DataFrame,
    key: str,
    ts: str,
    tie: str,
    elapsed: str,
    counters: Mapping[str, str],
    entity: str = "session",
    max_gap: int = MAX_GAP_SECONDS,
    keep: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Deltas and rates between consecutive samples of one ``key``.

    ``counters`` is ``{short name: column}``. Deltas and interval rates exist only
    on intervals labelled ``observed_delta``; the running totals and averages of
    the ``entity`` exist on every sample.
    """
    tracked = {"elapsed": elapsed, **counters}
    base = list(dict.fromkeys([tie, ts, key, elapsed, *counters.values(), *keep]))
    seen = previous_rows(
        samples.select(*base),
        [key],
        ts,
        tie,
        {
            f"previous_{ts}": ts,
            **{f"_previous_{name}": column for name, column in tracked.items()},
        },
        rows_per_slice,
    ).withColumns(
        {
            "observation_gap_seconds": seconds_between(F.col(f"previous_{ts}"), F.col(ts)),
            **{
                f"_change_{name}": F.col(column) - F.col(f"_previous_{name}")
                for name, column in tracked.items()
            },
        }
    )
    changes = [F.col(f"_change_{name}") for name in counters]
    labelled = seen.withColumn(
        "metric_quality",
        interval_quality(
            [F.col(key), F.col(elapsed), *[F.col(column) for column in counters.values()]],
            F.col(f"previous_{ts}"),
            F.col("observation_gap_seconds"),
            F.col("_change_elapsed"),
            changes,
            max_gap,
        ),
    )
    good = F.col("metric_quality") == GOOD
    seconds = F.when(F.col(elapsed) > 0, F.col(elapsed))
    active = F.when(good, F.col("_change_elapsed"))
    per_counter: list[Column] = []
    for name, column in counters.items():
        delta = F.when(good, F.col(f"_change_{name}"))
        per_counter += [
            F.col(column).alias(f"{entity}_{column}"),
            per_hour(F.col(column), seconds).alias(f"{entity}_{name}_per_active_hour"),
            delta.alias(f"{column}_delta"),
            per_hour(delta, active).alias(f"{name}_per_active_hour"),
        ]
    shown = [name for name in base if name not in counters.values()]
    return labelled.select(
        *shown,
        f"previous_{ts}",
        "observation_gap_seconds",
        active.alias("active_seconds"),
        *per_counter,
        "metric_quality",
    )


# Grains with their length in days (hours count as 1/24) and order.
GRAINS = ("hour", "day", "week")
HOUR_RETENTION_DAYS = 90


def _period_end(grain: Column, start: Column) -> Column:
    return (
        F.when(grain == "hour", start + F.expr("interval 1 hour"))
        .when(grain == "day", start + F.expr("interval 1 day"))
        .otherwise(start + F.expr("interval 7 day"))
    )


def velocity_rollup(
    velocity: DataFrame,
    ts: str,
    counters: Mapping[str, str],
    as_of: Column,
    hour_retention_days: int = HOUR_RETENTION_DAYS,
) -> DataFrame:
    """Hour, day and week totals of good intervals, with weighted rates.

    Rates divide summed deltas by summed active seconds. Rows are reduced to hours
    in one pass; days and weeks come from the hours, not from the rows again.
    """
    good = velocity.filter(F.col("metric_quality") == GOOD)
    hours = good.groupBy(F.date_trunc("hour", F.col(ts)).alias("_hour")).agg(
        F.sum("active_seconds").alias("_seconds"),
        F.count("*").alias("_intervals"),
        *[F.sum(f"{column}_delta").alias(f"_sum_{name}") for name, column in counters.items()],
    )
    starts = F.array(
        *[
            F.struct(F.lit(grain).alias("g"), F.date_trunc(grain, F.col("_hour")).alias("s"))
            for grain in GRAINS
        ]
    )
    totals = (
        hours.withColumn("_period", F.explode(starts))
        .groupBy(
            F.col("_period.g").alias("period_grain"), F.col("_period.s").alias("period_start")
        )
        .agg(
            F.sum("_seconds").alias("active_seconds"),
            *[F.sum(f"_sum_{name}").alias(column) for name, column in counters.items()],
            F.sum("_intervals").alias("observed_intervals"),
        )
    )
    end = _period_end(F.col("period_grain"), F.col("period_start"))
    oldest_hour = as_of - F.make_dt_interval(F.lit(hour_retention_days))
    return (
        totals.filter(
            (F.col("period_grain") != "hour") | (F.col("period_start") >= oldest_hour)
        )
        .select(
            "period_grain",
            "period_start",
            end.alias("period_end"),
            (end <= as_of).alias("is_complete"),
            "active_seconds",
            *counters.values(),
            *[
                per_hour(F.col(column), F.col("active_seconds")).alias(
                    f"{name}_per_active_hour"
                )
                for name, column in counters.items()
            ],
            "observed_intervals",
        )
        .orderBy(
            F.when(F.col("period_grain") == "hour", 1)
            .when(F.col("period_grain") == "day", 2)
            .otherwise(3),
            "period_start",
        )
    )


def velocity_current(
    velocity: DataFrame, ts: str, tie: str, columns: Sequence[str]
) -> DataFrame:
    """The latest sample over all keys."""
    return latest_row(velocity.select(*dict.fromkeys([ts, tie, *columns])), ts, tie).select(
        *columns
    )
