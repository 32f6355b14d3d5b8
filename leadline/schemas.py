"""Fixed table layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "BOOLEAN": T.BooleanType(),
}


def _struct(columns: str) -> T.StructType:
    fields = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Column names and types of the stored event table and of the
# session bookkeeping.
BRONZE = _struct(
    """
    event_id STRING, event_time TIMESTAMP, ingested_at TIMESTAMP, source STRING,
    source_file STRING, source_line_number BIGINT, event_type STRING,
    schema_version INT, agent_id STRING, lease_id STRING, source_git_sha STRING,
    git_sha_provenance STRING, source_fingerprint_sha256 STRING,
    collector_session_id STRING, raw_json STRING
    """
)
SESSIONS = _struct(
    """
    session_id STRING, started_at STRING, completed_at STRING, mode STRING,
    full_scan BOOLEAN, written_rows BIGINT, quarantined_rows BIGINT,
    reconciled BOOLEAN
    """
)
SOURCE_STATS = _struct(
    """
    session_id STRING, source STRING, files BIGINT, snapshot_bytes BIGINT,
    lines_read BIGINT, valid_json_rows BIGINT, malformed_rows BIGINT,
    new_rows BIGINT, duplicate_rows BIGINT
    """
)
OFFSETS = _struct(
    """
    source_file STRING, source STRING, byte_offset BIGINT, line_number BIGINT,
    prefix_sha256 STRING, session_id STRING
    """
)
FILE_RESULTS = _struct(
    """
    session_id STRING, source STRING, source_file STRING, snapshot_bytes BIGINT,
    fingerprint_sha256 STRING, start_byte BIGINT, start_line_number BIGINT, tail_bytes BIGINT,
    hashed_bytes BIGINT, lines_read BIGINT, valid_json_rows BIGINT, malformed_rows BIGINT,
    new_rows BIGINT, duplicate_rows BIGINT
    """
)
LEAVES = _struct(
    """
    source_file STRING, start BIGINT, end BIGINT, newlines BIGINT, line_end BIGINT,
    digest STRING, digest_to_line_end STRING, session_id STRING
    """
)
OBSERVATION_ROW = _struct(
    """
    nm_key STRING, status STRING, cooldown_opens_at STRING,
    cooldown_remaining_seconds BIGINT, is_spawned BOOLEAN, is_primed BOOLEAN,
    placeholder_status STRING, last_observed_kill_at STRING,
    next_lottery_opportunity_at STRING, effective_chance_percent BIGINT,
    effective_cooldown_seconds BIGINT
    """
)
OBSERVATION_ROOT = _struct(
    """
    schema_version INT, observed_at STRING, map_started_at STRING,
    ruleset_git_sha STRING
    """
)
COMPLETIONS = _struct(
    "target_name STRING, recorded_defeat_count STRING, last_recorded_defeat_at STRING"
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed relation without rows, for inputs that do not exist yet."""
    return spark.createDataFrame([], schema)
