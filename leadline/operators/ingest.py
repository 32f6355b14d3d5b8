"""From raw lines to stored events: identity, envelope, attribution, deduplication."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.functions import event_digest, json_text, parse_iso
from leadline.operators.ordered import ROWS_PER_SLICE, last_known, last_known_small
from leadline.schemas import BRONZE
from leadline.sources.specs import SourceSpec

# Labels and version of the stored layout.
SCHEMA_VERSION = 1
UNKNOWN_TYPE = "unknown"
INFERRED = "inferred_from_commit_time"
OBSERVED = "observed_at_ingestion"
UNAVAILABLE = "unavailable"
SHA_LENGTH = 40


def with_identity(lines: DataFrame) -> DataFrame:
    digest = event_digest(F.col("source_file"), F.col("source_line_number"), F.col("raw"))
    return lines.withColumn("event_id", digest)


def split_valid(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines that are JSON objects, and all others."""
    return lines.filter("error_type IS NULL"), lines.filter("error_type IS NOT NULL")


def _by_source(specs: Sequence[SourceSpec], value) -> Column:
    chosen = F.lit(None).cast("string")
    for spec in specs:
        chosen = F.when(F.col("source") == spec.name, value(spec)).otherwise(chosen)
    return chosen


def _event_type(spec: SourceSpec) -> Column:
    if spec.type_field is None:
        return F.lit(spec.constant_type)
    text = F.col("_type_text")
    # An empty value counts as none. The texts "0" and "false" are values, the
    # number 0 and the literal false are not; only then is the JSON type looked up.
    kind = F.schema_of_variant(
        F.try_variant_get(
            F.try_parse_json("raw_json"), f"$.{spec.type_field}", "variant"
        )
    )
    doubtful = text.isin("0", "0.0", "-0", "-0.0", "false", "[]", "{}")
    nothing = text.isNull() | (text == "") | F.when(
        doubtful, F.coalesce(kind != "STRING", F.lit(True))
    ).otherwise(F.lit(False))
    return F.when(nothing, F.lit(UNKNOWN_TYPE)).otherwise(text)


def to_envelope(
    valid: DataFrame,
    specs: Sequence[SourceSpec],
    session_id: str,
    ingested_at: Column,
) -> DataFrame:
    """The stored columns from identified lines, without attribution.

    Needs ``source_fingerprint_sha256`` beside the lines.
    """
    text = F.rtrim(F.decode("raw", "utf-8"), F.lit("\r\n"))
    document = F.col("raw_json")

    def field(name: Callable[[SourceSpec], Optional[str]]) -> Column:
        return _by_source(
            specs, lambda s: json_text(document, f"$.{name(s)}") if name(s) else F.lit(None).cast("string")
        )

    # What decides about these texts names them several times; as columns of their own they
    # are read from the document once.
    read = valid.withColumn("raw_json", text).withColumns(
        {"_time_text": field(lambda s: s.ts_field), "_type_text": field(lambda s: s.type_field)}
    )
    return read.select(
        "event_id",
        parse_iso(F.col("_time_text")).alias("event_time"),
        ingested_at.alias("ingested_at"),
        "source",
        "source_file",
        "source_line_number",
        _by_source(specs, _event_type).alias("event_type"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        json_text(document, "$.agent_id").alias("agent_id"),
        json_text(document, "$.lease_id").alias("lease_id"),
        "source_fingerprint_sha256",
        F.lit(session_id).alias("collector_session_id"),
        "raw_json",
    )


def clean_commits(commits: DataFrame, sha: str = "sha", committed_at: str = "committed_at") -> DataFrame:
    """Commits with a full identifier and a readable time."""
    moment = F.col(committed_at)
    if dict(commits.dtypes)[committed_at] == "string":
        moment = parse_iso(moment)
    cleaned = commits.select(F.col(sha).alias("sha"), moment.alias("committed_at"))
    return cleaned.filter(
        (F.length("sha") == SHA_LENGTH) & F.col("committed_at").isNotNull()
    )


def attribute_asof(
    events: DataFrame, commits: DataFrame, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Each event with the latest commit at or before its time.

    An ordinary commit history is broadcast by day, so events are not shuffled; one
    too large for that goes through the sliced window.
    """
    found = last_known_small(
        events, commits, "event_time", "committed_at", "sha", "source_git_sha"
    )
    if found is None:
        found = last_known(
            events,
            commits,
            ts="event_time",
            right_ts="committed_at",
            values={"source_git_sha": "sha"},
            tie="sha",
            rows_per_slice=rows_per_slice,
        )
    return _with_provenance(found, INFERRED)


def attribute_constant(events: DataFrame, sha: Optional[str]) -> DataFrame:
    """Each event with the version seen when it was ingested."""
    return _with_provenance(
        events.withColumn("source_git_sha", F.lit(sha).cast("string")), OBSERVED
    )


def _with_provenance(events: DataFrame, label: str) -> DataFrame:
    known = F.when(F.col("source_git_sha").isNotNull(), F.lit(label))
    return events.withColumn(
        "git_sha_provenance", known.otherwise(F.lit(UNAVAILABLE))
    ).select(*BRONZE.names)


def dedup_new(
    rows: DataFrame, existing: DataFrame, id: str = "event_id", repeats_within: bool = True
) -> DataFrame:
    """Rows whose id is not stored yet, one for each id.

    Where ids cannot repeat within ``rows`` the caller says so and saves a shuffle
    of whole rows.
    """
    once = rows.dropDuplicates([id]) if repeats_within else rows
    return once.join(existing.select(id), id, "left_anti").select(*rows.columns)


def file_stats(lines: DataFrame, new_by_file: DataFrame) -> DataFrame:
    """Lines, valid, malformed, new and duplicate rows of each file."""
    counted = lines.groupBy("source", "source_file").agg(
        F.count("*").alias("lines_read"),
        F.count_if(F.col("error_type").isNull()).alias("valid_json_rows"),
        F.count_if(F.col("error_type").isNotNull()).alias("malformed_rows"),
    )
    new_rows = F.coalesce("new_rows", F.lit(0))
    return (
        counted.join(new_by_file, ["source", "source_file"], "left")
        .withColumn("new_rows", new_rows)
        .withColumn("duplicate_rows", F.col("valid_json_rows") - F.col("new_rows"))
    )


def source_stats(files: DataFrame, by_file: DataFrame, session_id: str) -> DataFrame:
    """Per-source totals of a session; sources without new lines keep their files."""
    counts = ("lines_read", "valid_json_rows", "malformed_rows", "new_rows", "duplicate_rows")
    joined = files.select("source", "source_file", "byte_limit").join(
        by_file, ["source", "source_file"], "left"
    )
    return joined.groupBy("source").agg(
        F.lit(session_id).alias("session_id"),
        F.count("*").alias("files"),
        F.sum("byte_limit").alias("snapshot_bytes"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
    )
