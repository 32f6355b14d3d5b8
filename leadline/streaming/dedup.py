"""Repeated events inside a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame


def once_within(events: DataFrame, ident: str, ts: str, delay: str) -> DataFrame:
    """The first of the events with one id that come within ``delay`` of each other.

    State holds ids only as long as the watermark needs them, and spares the join with stored
    ids those repeats. That join stays the rule for ids that come again later.
    """
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([ident])
