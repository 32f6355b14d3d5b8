"""Session records: offsets, per-file results and the session document."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadline.schemas import LEAVES, OFFSETS, SOURCE_STATS

_STAT_NAMES = [n for n in SOURCE_STATS.names if n not in ("session_id", "source")]


def write_offsets(files: DataFrame, by_file: DataFrame, folder: str, session_id: str) -> None:
    """Where each file's next session starts. One folder for a session: repeatable."""
    lines = F.coalesce("lines_read", F.lit(0))
    (
        files.join(by_file.select("source", "source_file", "lines_read"),
                   ["source", "source_file"], "left")
        .select(
            "source_file",
            "source",
            F.col("stop").alias("byte_offset"),
            (F.col("start_line") + lines).alias("line_number"),
            F.col("prefix_digest").alias("prefix_sha256"),
            F.lit(session_id).alias("session_id"),
        )
        .select(*OFFSETS.names)
        .write.mode("overwrite")
        .parquet(f"{folder}/state/offsets/part={session_id}")
    )


def write_file_results(
    files: DataFrame, by_file: DataFrame, folder: str, session_id: str
) -> None:
    """One row for each file read, with the bytes left for a later session."""
    counts = ("lines_read", "valid_json_rows", "malformed_rows", "new_rows", "duplicate_rows")
    files.join(by_file, ["source", "source_file"], "left").select(
        F.lit(session_id).alias("session_id"),
        "source",
        "source_file",
        F.col("byte_limit").alias("snapshot_bytes"),
        F.col("fingerprint").alias("fingerprint_sha256"),
        "start_byte",
        F.col("start_line").alias("start_line_number"),
        (F.col("byte_limit") - F.col("stop")).alias("tail_bytes"),
        "hashed_bytes",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in counts],
    ).write.mode("overwrite").parquet(f"{folder}/state/files/part={session_id}")


def write_leaves(leaves: DataFrame, folder: str, session_id: str) -> None:
    """Digests of the whole byte ranges that this session hashed."""
    leaves.withColumn("session_id", F.lit(session_id)).select(*LEAVES.names).write.mode("overwrite").parquet(
        f"{folder}/state/ranges/part={session_id}"
    )


def write_manifest(
    stats: DataFrame,
    folder: str,
    session_id: str,
    facts: dict[str, Optional[object]],
) -> None:
    """One JSON document: facts of the session and a map of its sources."""
    by_source = F.map_from_entries(
        F.collect_list(F.struct(F.col("source"), F.struct(*_STAT_NAMES)))
    )
    balanced = F.col("lines_read") == F.col("valid_json_rows") + F.col("malformed_rows")
    constants = []
    for name, value in facts.items():
        column = F.lit(value)
        constants.append((column if value is not None else column.cast(T.StringType())).alias(name))
    document = stats.agg(
        by_source.alias("sources"),
        F.coalesce(F.bool_and(balanced), F.lit(True)).alias("reconciled"),
    ).select(F.lit(session_id).alias("session_id"), *constants, "sources", "reconciled")
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(
        f"{folder}/state/manifests/part={session_id}"
    )
