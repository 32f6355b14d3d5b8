"""Questions asked of the small published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadline.functions import age_seconds, count_where, ratio
from leadline.operators.keys import side_by_side

# Fixed value: minutes after which a shown snapshot counts as stale.
STALE_AFTER_MINUTES = 90


def between_days(df: DataFrame, first: str, last: str, day: str = "event_date") -> DataFrame:
    """Rows of an inclusive range of days."""
    return df.filter(F.col(day).between(F.lit(first), F.lit(last)))


def totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of sums; 0 where nothing was summed."""
    return df.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in columns])


def success_share(df: DataFrame, succeeded: str, count: str, name: str) -> DataFrame:
    """One row: the summed share, 0 without any volume."""
    share = ratio(F.sum(succeeded), F.sum(count))
    return df.agg(F.coalesce(share, F.lit(0.0)).alias(name))


def milestones(df: DataFrame, parts: Sequence[str], name: str = "milestones") -> DataFrame:
    total = F.lit(0)
    for part in parts:
        total = total + F.coalesce(part, F.lit(0))
    return df.withColumn(name, total)


def velocity_periods(
    rollup: DataFrame, grain: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Rows of one grain, optionally within a range of start days."""
    chosen = rollup.filter(F.col("period_grain") == grain)
    if first is not None and last is not None:
        start = F.to_date("period_start")
        chosen = chosen.filter(
            start.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        )
    return chosen


def completed_periods(rollup: DataFrame, grain: str) -> DataFrame:
    return velocity_periods(rollup, grain).filter("is_complete")


def current_period(rollup: DataFrame, grain: str) -> DataFrame:
    """The latest period still running, if there is one."""
    running = velocity_periods(rollup, grain).filter(~F.col("is_complete"))
    return running.orderBy(F.desc("period_start")).limit(1)


def mix(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """Wide counts to long form: one row by id and column."""
    return df.unpivot(list(ids), list(columns), name, value)


def outcome_totals(
    df: DataFrame, columns: Mapping[str, str], name: str = "outcome", value: str = "attempts"
) -> DataFrame:
    """Sums of ``{label: column}`` in long form."""
    summed = df.agg(*[F.sum(column).alias(label) for label, column in columns.items()])
    rows = [
        F.struct(F.lit(label).alias(name), F.col(label).alias(value)) for label in columns
    ]
    return summed.select(F.inline(F.array(*rows)))


def top_by_volume(
    df: DataFrame, volume: str, ties: Sequence[str], k: int, share: str = "relative_volume"
) -> DataFrame:
    """The k largest rows, each with its volume as a share of the largest (at least 1)."""
    top = df.orderBy(F.desc(volume), *ties).limit(k)
    # The window runs over these k rows only.
    largest = F.greatest(F.max(volume).over(Window.partitionBy(F.lit(0))), F.lit(1))
    return top.withColumn(share, F.col(volume) / largest)


def recent_days(df: DataFrame, day: str, value: str, days: int = 7) -> DataFrame:
    """The last days with height against their maximum and change against the day before."""
    recent = df.select(day, value).orderBy(F.desc(day)).limit(days)
    # Windows over these few rows only.
    every = Window.partitionBy(F.lit(0))
    in_order = every.orderBy(day)
    highest = F.greatest(F.max(value).over(every), F.lit(1))
    before = F.lag(value).over(in_order)
    # Of several equal days the first is the peak.
    peak = F.min_by(F.col(day), F.struct(-F.col(value), F.col(day))).over(every)
    return recent.select(
        day,
        value,
        (F.col(value) / highest).alias("relative_height"),
        (F.col(day) == peak).alias("is_peak"),
        F.when(before > 0, (F.col(value) - before) / before).alias("change_from_day_before"),
    )


def rate_change(df: DataFrame, day: str, rate: str, days: int = 7) -> DataFrame:
    """One row: first and last rate of the last days, and the difference; NULL reads as 0."""
    recent = df.orderBy(F.desc(day)).limit(days).select(
        day, F.coalesce(rate, F.lit(0.0)).alias("_rate")
    )
    return recent.agg(
        F.min_by("_rate", day).alias("first_rate"), F.max_by("_rate", day).alias("last_rate")
    ).withColumn("rate_change", F.col("last_rate") - F.col("first_rate"))


def shares(df: DataFrame, columns: Sequence[str], name: str = "action") -> DataFrame:
    """Total and share of each column in the total of all of them."""
    long = outcome_totals(df, {c: c for c in columns}, name, "total").withColumn(
        "total", F.coalesce("total", F.lit(0))
    )
    # One row for each named column.
    whole = F.sum("total").over(Window.partitionBy(F.lit(0)))
    return long.withColumn("share", F.coalesce(ratio(F.col("total"), whole), F.lit(0.0)))


def latest_arrivals(
    df: DataFrame, success: str, attempts: str, proxy: str
) -> DataFrame:
    """One row: arrival rate over all days, and the greatest proxy count."""
    return df.agg(
        F.coalesce(ratio(F.sum(success), F.sum(attempts)), F.lit(0.0)).alias("arrival_rate"),
        F.coalesce(F.max(proxy), F.lit(0)).alias(proxy),
    )


def is_stale(as_of: Column, moment: Column, minutes: int = STALE_AFTER_MINUTES) -> Column:
    return age_seconds(as_of, moment) > minutes * 60


def source_status(
    quality: DataFrame, labels: Mapping[str, str], observed_source: str
) -> DataFrame:
    """Display label and status of each source."""
    label = F.col("source")
    for source, shown in labels.items():
        label = F.when(F.col("source") == source, F.lit(shown)).otherwise(label)
    status = (
        F.when(~F.col("latest_session_reconciled"), F.lit("Review"))
        .when(F.col("source") == observed_source, F.lit("Observed"))
        .otherwise(F.lit("Reconciled"))
    )
    return quality.select(
        label.alias("source"),
        F.col("bronze_rows").alias("rows"),
        F.col("latest_session_malformed_rows").alias("malformed"),
        status.alias("status"),
    )


def findings(events: DataFrame, operations: DataFrame, attempts: DataFrame) -> DataFrame:
    """One row of headline findings over three measured tables."""
    fought = events.agg(
        F.sum("completed_fights").alias("completed_fights"),
        ratio(
            F.sum("attack_rejections"), F.sum("attack_issued") + F.sum("attack_rejections")
        ).alias("attack_rejection_rate"),
    )
    run = operations.agg(
        F.sum("operation_count").alias("operations"),
        (F.lit(1.0) - ratio(F.sum("failed_operations"), F.sum("operation_count"))).alias(
            "success_rate"
        ),
    )
    parts = ("successful_collision_probes", "partial_progress_probes", "stalled_probes")
    summed = {name: F.coalesce(F.sum(name), F.lit(0)) for name in parts}
    arrived = summed["successful_collision_probes"]
    tried = attempts.agg(
        *[column.alias(name) for name, column in summed.items()],
        ratio(
            arrived, arrived + summed["partial_progress_probes"] + summed["stalled_probes"]
        ).alias("probe_arrival_rate"),
    )
    return side_by_side(fought, run, tried)
