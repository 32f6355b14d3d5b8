"""Snapshots of allow-listed relational tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reviewed tables and their keys.
TABLE_KEYS: Mapping[str, tuple[str, ...]] = {
    "chars": ("charid",),
    "char_jobs": ("charid",),
    "char_inventory": ("charid", "location", "slot"),
    "char_missions": ("charid",),
    "item_basic": ("itemid",),
    "zone_settings": ("zoneid",),
}
READ_ONLY_STATEMENT = "SET SESSION TRANSACTION READ ONLY"


def check_allowed(names: Sequence[str], keys: Mapping[str, Sequence[str]]) -> None:
    unknown = sorted(set(names) - set(keys))
    if unknown:
        raise ValueError(f"tables are not on the reviewed list: {', '.join(unknown)}")


def read_table(
    spark: SparkSession,
    url: str,
    name: str,
    options: Mapping[str, str],
    keys: Mapping[str, Sequence[str]] = TABLE_KEYS,
    partitions: Optional[int] = None,
) -> DataFrame:
    """One allow-listed table over JDBC in a read-only session.

    With ``partitions`` the table is read in that many ranges of its first key, so
    no single connection carries all of it.
    """
    check_allowed([name], keys)

    def reader():
        return (
            spark.read.format("jdbc")
            .option("url", url)
            .option("sessionInitStatement", READ_ONLY_STATEMENT)
            .options(**options)
        )

    if not partitions:
        return reader().option("dbtable", name).load()
    key = keys[name][0]
    bounds = (
        reader()
        .option("query", f"SELECT min({key}) AS low, max({key}) AS high FROM {name}")
        .load()
        .select(F.col("low").cast("bigint"), F.col("high").cast("bigint"))
        .first()
    )
    if bounds["low"] is None:
        return reader().option("dbtable", name).load()
    return (
        reader()
        .option("dbtable", name)
        .option("partitionColumn", key)
        .option("lowerBound", bounds["low"])
        .option("upperBound", bounds["high"] + 1)
        .option("numPartitions", partitions)
        .load()
    )
