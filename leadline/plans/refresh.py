"""From stored events to tables, checks and the published snapshot."""

from __future__ import annotations

import datetime as dt
import json
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadline.config import prepare_session
from leadline.operators import checks
from leadline.plans.contracts import ContractError, table_report
from leadline.plans.gold import build_gold
from leadline.plans.public import public_tables, snapshot_document, watch_tables
from leadline.plans.silver import build_silver
from leadline.sinks.snapshot import export_snapshot, verify_export
from leadline.sinks.tables import materialize
from leadline.sources.documents import read_catalog, read_observation
from leadline.sources.stored import bronze, read_manifests

GOLD_TABLES = (
    "gold_autonomous_progression",
    "gold_progression_velocity",
    "gold_combat_reliability",
    "gold_navigation_performance",
    "gold_mcp_operation_reliability",
    "gold_performance_by_git_commit",
    "gold_data_quality",
)
LOCAL_MODE = "local_gold_models"
PUBLISHED_MODE = "published_aggregate_snapshot"


def build_tables(
    spark: SparkSession,
    data: str,
    silver_database: str = "silver",
    gold_database: str = "gold",
    time_zone: str = "UTC",
) -> dict[str, DataFrame]:
    """Store all typed and measured tables, then fail if a declared rule is broken."""
    prepare_session(spark, time_zone)
    events = bronze(spark, data).drop("event_date")
    sessions, source_stats = read_manifests(spark, data)
    silver = build_silver(events, lambda n, df: materialize(df, n, silver_database))
    gold = build_gold(
        silver, events, source_stats, lambda n, df: materialize(df, n, gold_database)
    )
    tables = {**silver, **gold}
    broken = table_report(tables).filter("failing_rows > 0").collect()
    messages = [f"{r['table_name']}.{r['column_name']} {r['check_name']}" for r in broken]
    messages += checks.failing(
        {
            "event ids are stored once": checks.duplicate_ids(events),
            "quarantined rows are the malformed lines": checks.quarantine_mismatches(
                sessions, source_stats
            ),
            "line counts add up": checks.count_mismatches(source_stats),
        }
    )
    if messages:
        raise ContractError("broken rules: " + "; ".join(messages))
    return tables


def publish(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    catalog: str,
    out: str,
    mirror: Optional[str] = None,
    observation: Optional[str] = None,
    now: Optional[dt.datetime] = None,
) -> dict[str, object]:
    """Write the snapshot document and verify it by reading it back."""
    now = now or dt.datetime.now(dt.timezone.utc)
    as_of = F.lit(now).cast("timestamp")
    seen = read_observation(spark, observation) if observation else None
    datasets = {
        **public_tables(tables, as_of),
        **watch_tables(read_catalog(spark, catalog), tables["silver_fights"], seen, as_of),
    }
    document = snapshot_document(datasets, tables["gold_data_quality"], now)
    written = export_snapshot(document, out, mirror, now)
    verify_export(spark, out, written["sha256"], now)
    return written


def load_snapshot(
    spark: SparkSession,
    fallback: str,
    catalog: Optional[str] = None,
    gold_database: str = "gold",
    silver_database: str = "silver",
    now: Optional[dt.datetime] = None,
) -> dict[str, object]:
    """The snapshot from stored tables if they exist, else the published document."""
    names = [f"{gold_database}.{name}" for name in GOLD_TABLES]
    if catalog and all(spark.catalog.tableExists(name) for name in names):
        now = now or dt.datetime.now(dt.timezone.utc)
        as_of = F.lit(now).cast("timestamp")
        gold = {name: spark.table(f"{gold_database}.{name}") for name in GOLD_TABLES}
        fights = spark.table(f"{silver_database}.silver_fights")
        datasets = {
            **public_tables(gold, as_of),
            **watch_tables(read_catalog(spark, catalog), fights, None, as_of),
        }
        document = snapshot_document(datasets, gold["gold_data_quality"], now)
        return {**document, "mode": LOCAL_MODE}
    text = spark.read.text(fallback, wholetext=True).first()
    return {**json.loads(text["value"]), "mode": PUBLISHED_MODE}
