"""Tables that earlier sessions stored."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadline.schemas import BRONZE, FILE_RESULTS, LEAVES, OFFSETS, SESSIONS, SOURCE_STATS, empty

_STATS = T.StructType(
    [f for f in SOURCE_STATS.fields if f.name not in ("session_id", "source")]
)
_MANIFEST = T.StructType(
    [*SESSIONS.fields, T.StructField("sources", T.MapType(T.StringType(), _STATS))]
)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder exists, on whichever file system the path names."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    return files.exists(target)


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    """All stored events, columns matched by name; typed and empty before any exist.

    Filters on ``source`` and ``event_date`` prune partitions.
    """
    schema = T.StructType([*BRONZE.fields, T.StructField("event_date", T.StringType())])
    path = f"{folder}/bronze"
    if not path_exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).option("mergeSchema", True).parquet(path)


def read_manifests(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Session rows and (session, source) rows from the stored session documents."""
    path = f"{folder}/state/manifests"
    if not path_exists(spark, path):
        return empty(spark, SESSIONS), empty(spark, SOURCE_STATS)
    documents = (
        spark.read.schema(_MANIFEST)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    zero = F.lit(0).cast("bigint")
    sessions = documents.select(
        "session_id",
        "started_at",
        "completed_at",
        "mode",
        "full_scan",
        F.coalesce("written_rows", zero).alias("written_rows"),
        F.coalesce("quarantined_rows", zero).alias("quarantined_rows"),
        F.coalesce("reconciled", F.lit(False)).alias("reconciled"),
    )
    sources = documents.select(
        "session_id", F.explode("sources").alias("source", "stats")
    ).select("session_id", "source", "stats.*")
    return sessions, sources.select(*SOURCE_STATS.names)


def saved_offsets(spark: SparkSession, folder: str) -> Optional[DataFrame]:
    """The latest offset of each file, or None before the first session."""
    path = f"{folder}/state/offsets"
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema(OFFSETS).parquet(path)
    values = F.struct("source", "byte_offset", "line_number", "prefix_sha256", "session_id")
    return (
        rows.groupBy("source_file")
        .agg(F.max_by(values, "session_id").alias("_latest"))
        .select("source_file", "_latest.*")
    )


def stored_leaves(spark: SparkSession, folder: str) -> Optional[DataFrame]:
    """The latest digest of each whole byte range of each file, or None before any."""
    path = f"{folder}/state/ranges"
    if not path_exists(spark, path):
        return None
    values = F.struct(*[name for name in LEAVES.names if name not in ("source_file", "start", "end")])
    rows = spark.read.schema(LEAVES).parquet(path)
    return (
        rows.groupBy("source_file", "start", "end")
        .agg(F.max_by(values, "session_id").alias("_latest"))
        .select("source_file", "start", "end", "_latest.*")
    )


def file_results(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each session and file: bytes, lines, and what became of them."""
    path = f"{folder}/state/files"
    if not path_exists(spark, path):
        return empty(spark, FILE_RESULTS)
    return spark.read.schema(FILE_RESULTS).parquet(path)
