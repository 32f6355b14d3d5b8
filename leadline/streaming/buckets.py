"""Tumbling hour, day and week buckets over event time, for streams and tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Window length and offset; weeks start on Monday.
WINDOWS = {"hour": ("1 hour", None), "day": ("1 day", None), "week": ("7 days", "4 days")}


def bucket_totals(
    df: DataFrame,
    ts: str,
    grain: str,
    totals: Mapping[str, Column],
    late: Optional[str] = None,
) -> DataFrame:
    """Totals by tumbling UTC window. ``late`` sets a watermark, for streams that must
    forget; without one any late event is still counted."""
    length, offset = WINDOWS[grain]
    timed = df.withWatermark(ts, late) if late else df
    window = F.window(ts, length, startTime=offset) if offset else F.window(ts, length)
    return (
        timed.groupBy(window.alias("_window"))
        .agg(*[column.alias(name) for name, column in totals.items()])
        .select(
            F.lit(grain).alias("period_grain"),
            F.col("_window.start").alias("period_start"),
            F.col("_window.end").alias("period_end"),
            *totals,
        )
    )
