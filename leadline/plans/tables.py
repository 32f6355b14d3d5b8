"""The given tables, read once with the casts the queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadline.config import prepare_session
from leadline.functions import json_text, to_long

TEXT_SECONDS = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with an instant, a day, the typed counter and derived attributes.

    ``owner`` and ``version`` are NULL on some rows, as they are in real telemetry.
    """
    k = F.col("k")
    return (
        table(spark, folder, "events")
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withColumn("k", to_long(json_text(F.col("props"), "$.k")))
        .withColumns(
            {
                "event_date": F.to_date("ts"),
                "serial": F.col("event_id"),
                "operation": F.concat(F.lit("op"), (k % 10).cast("string")),
                "outcome": F.when(F.col("event_type") == "error", "error").otherwise("ok"),
                "owner": F.when(k % 5 != 0, F.concat(F.lit("owner"), (k % 3).cast("string"))),
                "version": F.when(
                    k % 7 != 0, F.concat(F.lit("version"), F.floor(k / 10).cast("string"))
                ),
                "provenance": F.when(k % 7 != 0, F.lit("observed")).otherwise("unavailable"),
            }
        )
    )


def day_of(column: str) -> Column:
    return F.to_date(F.col(column).cast("timestamp"))


def seconds_text(moment: Column | str) -> Column:
    return F.date_format(moment, TEXT_SECONDS)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six places, so that summing in another order compares equal."""
    return df.withColumns({name: F.round(F.col(name), 6) for name in columns})


# The same shared columns for the oracle.
EVENTS_SQL = """
ev AS (
  SELECT event_id, event_id AS serial, ts, CAST(ts AS DATE) AS event_date, user_id,
         event_type, value, k,
         'op' || CAST(k % 10 AS VARCHAR) AS operation,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS outcome,
         CASE WHEN k % 5 <> 0 THEN 'owner' || CAST(k % 3 AS VARCHAR) END AS owner,
         CASE WHEN k % 7 <> 0 THEN 'version' || CAST(k // 10 AS VARCHAR) END AS version,
         CASE WHEN k % 7 <> 0 THEN 'observed' ELSE 'unavailable' END AS provenance
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)
"""
