"""One ingest session: freeze, resume, classify, store, quarantine, reconcile."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadline.config import delete_folder, prepare_session, shared_folder
from leadline.operators import ingest
from leadline.schemas import SOURCE_STATS
from leadline.sinks.bronze import (
    check_written,
    in_partitions,
    partition_date,
    stored_ids,
    write_bronze,
    write_quarantine,
)
from leadline.sinks.records import write_file_results, write_leaves, write_manifest, write_offsets
from leadline.sources.files import freeze, refuse_bad_paths
from leadline.sources.lines import FULL, GROWTH, RANGE_BYTES, count_ranges, read_lines, resume_plan
from leadline.sources.specs import EVENT_SOURCES, SourceSpec
from leadline.sources.stored import bronze, saved_offsets, stored_leaves

# Session modes.
BACKFILL = "historical_backfill"
INCREMENTAL = "incremental_collection"


def new_session_id(now: dt.datetime) -> str:
    return f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:10]}"


def ingest_session(
    spark: SparkSession,
    root: str,
    data: str,
    historical: bool = False,
    full_scan: bool = False,
    commits: Optional[DataFrame] = None,
    version: Optional[str] = None,
    specs: Sequence[SourceSpec] = EVENT_SOURCES,
    tail: Optional[str] = None,
    session_id: Optional[str] = None,
    now: Optional[dt.datetime] = None,
    frozen: Optional[DataFrame] = None,
    range_bytes: int = RANGE_BYTES,
    verify: str = FULL,
) -> dict[str, object]:
    """Store the new events below ``root`` in ``data`` and return the session's facts.

    ``historical`` attributes events to ``commits`` by time, else to ``version``.
    ``full_scan`` reads every file from its start; stored events are recognised by
    id, so repeating a session stores nothing twice. An unfinished last line waits
    for the next session unless the scan is full (``tail`` overrides). ``verify`` says how
    much of what earlier sessions read is hashed again: all of it, or with ``growth`` only
    the range of bytes in which each file's growth starts.
    """
    if verify not in (FULL, GROWTH):
        raise ValueError(f"verify must be {FULL} or {GROWTH}")
    prepare_session(spark)
    started = now or dt.datetime.now(dt.timezone.utc)
    session_id = session_id or new_session_id(started)
    folder = shared_folder(spark, f"session-{session_id}")
    try:
        if frozen is None:
            frozen = freeze(spark, root, specs, folder)
        else:
            refuse_bad_paths(frozen, root)
        return _store_session(
            spark, data, folder, frozen, historical, full_scan, commits, version, specs,
            tail, session_id, started, range_bytes, verify,
        )
    finally:
        # The scratch tables hold a copy of what was read.
        delete_folder(spark, folder)


def _store_session(
    spark: SparkSession,
    data: str,
    folder: str,
    frozen: DataFrame,
    historical: bool,
    full_scan: bool,
    commits: Optional[DataFrame],
    version: Optional[str],
    specs: Sequence[SourceSpec],
    tail: Optional[str],
    session_id: str,
    started: dt.datetime,
    range_bytes: int,
    verify: str,
) -> dict[str, object]:
    saved = None if full_scan else saved_offsets(spark, data)
    leaves = stored_leaves(spark, data) if verify == GROWTH and saved is not None else None
    files, ranges, hashed = resume_plan(
        spark, frozen, saved, folder, tail or ("read" if full_scan else "hold"), range_bytes, leaves
    )
    # The classified scan feeds three outputs, so it is stored once.
    scanned = ingest.with_identity(read_lines(ranges, count_ranges(files, range_bytes)))
    scanned.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/lines")
    lines = spark.read.schema(scanned.schema).parquet(f"{folder}/lines")
    valid, bad = ingest.split_valid(lines)

    fingerprints = files.select(
        "source", "source_file", F.col("fingerprint").alias("source_fingerprint_sha256")
    )
    listed = files.agg(
        F.count("*").alias("rows"),
        F.countDistinct("source_file").alias("distinct"),
        F.collect_set("source").alias("sources"),
    ).first()

    def to_envelope(rows: DataFrame) -> DataFrame:
        located = rows.join(fingerprints, ["source", "source_file"])
        return ingest.to_envelope(located, specs, session_id, F.lit(started).cast("timestamp"))

    # The days of the batch: the only partitions of stored events that matter to it.
    day = partition_date(F.col("event_time")).alias("day")
    days = sorted(row["day"] for row in to_envelope(valid).select(day).distinct().collect())
    fresh = ingest.dedup_new(
        valid,
        stored_ids(spark, data, listed["sources"], days),
        repeats_within=listed["rows"] != listed["distinct"],
    )
    envelope = to_envelope(fresh)
    if historical:
        history = ingest.clean_commits(commits) if commits is not None else None
        attributed = (
            ingest.attribute_asof(envelope, history)
            if history is not None
            else ingest.attribute_constant(envelope, None)
        )
    else:
        attributed = ingest.attribute_constant(envelope, version)
    written = write_bronze(attributed, data)
    check_written(spark, data, session_id, written, listed["sources"], days)
    quarantined = write_quarantine(bad, data, session_id)

    new_by_file = (
        in_partitions(bronze(spark, data), listed["sources"], days)
        .filter(F.col("collector_session_id") == session_id)
        .groupBy("source", "source_file")
        .agg(F.count("*").alias("new_rows"))
    )
    counted = ingest.file_stats(lines, new_by_file)
    counted.write.mode("overwrite").parquet(f"{folder}/counts")
    by_file = spark.read.schema(counted.schema).parquet(f"{folder}/counts")
    malformed = by_file.agg(F.coalesce(F.sum("malformed_rows"), F.lit(0))).first()[0]
    if quarantined != malformed:
        raise RuntimeError(f"quarantined {quarantined} rows of {malformed} malformed lines")
    stats = ingest.source_stats(files, by_file, session_id).select(*SOURCE_STATS.names)
    write_file_results(files, by_file, data, session_id)
    write_leaves(hashed, data, session_id)
    write_offsets(files, by_file, data, session_id)
    facts = {
        "started_at": started.isoformat(),
        "completed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
        "mode": BACKFILL if historical else INCREMENTAL,
        "full_scan": full_scan,
        "source_git_sha_observed_at_start": version,
        "git_sha_provenance": ingest.INFERRED if historical else ingest.OBSERVED,
        "written_rows": written,
        "quarantined_rows": quarantined,
    }
    write_manifest(stats, data, session_id, facts)
    return {"session_id": session_id, **facts}
