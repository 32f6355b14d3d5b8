"""Stored events and quarantined lines."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadline.schemas import BRONZE, empty
from leadline.sources.stored import bronze, path_exists

# Fixed value: partition of events without a time.
UNKNOWN_DATE = "unknown"


def partition_date(event_time: Column) -> Column:
    """The UTC date of an event as text; layout only, not a reporting day."""
    days = F.floor(F.unix_micros(event_time) / F.lit(86_400_000_000))
    date = F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))
    return F.coalesce(date.cast("string"), F.lit(UNKNOWN_DATE))


def write_bronze(events: DataFrame, folder: str) -> int:
    """Append events, partitioned by source and UTC date; returns the rows written.

    Rebalancing makes files of even size: small partitions share no task with a huge
    one, and a huge one is split over several.
    """
    counted = Observation()
    rows = (
        events.select(*BRONZE.names)
        .withColumn("event_date", partition_date(F.col("event_time")))
        .hint("rebalance", F.col("source"), F.col("event_date"))
        .observe(counted, F.count(F.lit(1)).alias("rows"))
    )
    rows.write.partitionBy("source", "event_date").mode("append").option(
        "compression", "zstd"
    ).parquet(f"{folder}/bronze")
    return counted.get.get("rows", 0)


def stored_ids(
    spark: SparkSession, folder: str, sources: list[str], days: Optional[list[str]] = None
) -> DataFrame:
    """Ids already stored for some sources and days: one column, pruned to partitions.

    An id covers the content and so the time of an event: an event that is stored lies
    in the partition of its own day.
    """
    if not path_exists(spark, f"{folder}/bronze"):
        return empty(spark, T.StructType([BRONZE["event_id"]]))
    return (
        in_partitions(bronze(spark, folder), sources, days)
        .filter(F.col("event_id").isNotNull())
        .select("event_id")
    )


def in_partitions(stored: DataFrame, sources: list[str], days: Optional[list[str]]) -> DataFrame:
    chosen = stored.filter(F.col("source").isin(sources))
    return chosen if days is None else chosen.filter(F.col("event_date").isin(days))


def check_written(
    spark: SparkSession,
    folder: str,
    session_id: str,
    produced: int,
    sources: list[str],
    days: Optional[list[str]] = None,
) -> None:
    """Fail unless the rows found in the session's partitions are those produced."""
    stored = in_partitions(bronze(spark, folder), sources, days)
    found = stored.filter(F.col("collector_session_id") == session_id).count()
    if found != produced:
        raise RuntimeError(f"stored {found} rows, but {produced} were produced")


def write_quarantine(bad: DataFrame, folder: str, session_id: str) -> int:
    """Malformed lines of a session as JSON, bytes kept as base64; returns the rows."""
    target = f"{folder}/quarantine/session_id={session_id}"
    counted = Observation()
    bad.select(
        "event_id",
        "source",
        "source_file",
        "source_line_number",
        "error_type",
        F.base64("raw").alias("raw_line_base64"),
    ).observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(target)
    return counted.get.get("rows", 0)
