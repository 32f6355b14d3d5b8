"""Listing and freezing of growing files: nothing past the frozen size is read."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce
from typing import BinaryIO, Optional
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadline.schemas import empty
from leadline.sources.specs import SourceSpec

_LISTING = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("byte_limit", T.LongType()),
        T.StructField("modified_at", T.TimestampType()),
    ]
)


def root_uri(root: str) -> str:
    """The root as the prefix that Spark's file listing reports."""
    if "://" in root or root.startswith("file:"):
        return root.rstrip("/")
    return "file://" + os.path.realpath(root)


def open_file(uri: str) -> BinaryIO:
    """Open a file of any file system for seeking reads, inside a task."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path), "rb")
    known, path = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return known.open_input_file(path)


def _path_problem(uri: str, root: str) -> Optional[str]:
    parts = urlsplit(uri)
    if parts.scheme not in ("", "file"):
        return None  # object stores have no links
    path, inside = unquote(parts.path), unquote(urlsplit(root).path)
    if os.path.islink(path):
        return f"refusing a symbolic link: {path}"
    if not os.path.realpath(path).startswith(inside.rstrip("/") + "/"):
        return f"file lies outside the source root: {path}"
    if not os.path.isfile(path):
        return f"not a regular file: {path}"
    return None


def path_problem(path: Column, root: str) -> Column:
    """NULL for an acceptable file, else the reason to reject it."""

    def check(batch: pa.Array) -> pa.Array:
        return pa.array([_path_problem(uri, root) for uri in batch.to_pylist()], pa.string())

    return F.arrow_udf(check, "string")(path)


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, root: str, specs: Sequence[SourceSpec]) -> DataFrame:
    """Matching files with their sizes; file contents are not touched."""
    base = root_uri(root)
    found = []
    for spec in specs:
        try:
            files = spark.read.format("binaryFile").load(f"{base}/{spec.glob}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.append(
            files.select(
                F.lit(spec.name).alias("source"),
                F.col("_metadata.file_path").alias("path"),
                F.col("_metadata.file_size").alias("byte_limit"),
                F.col("_metadata.file_modification_time").alias("modified_at"),
            )
        )
    if not found:
        return empty(spark, _LISTING)
    listed = reduce(DataFrame.unionByName, found)
    # Listings spell local paths as file:/x or file:///x.
    spelled = F.regexp_replace("path", "^file:/+", "file:///")
    decoded_root = unquote(base)
    return listed.withColumn("path", spelled).select(
        "source",
        "path",
        F.substring(_decoded(F.col("path")), len(decoded_root) + 2, 1 << 30).alias(
            "source_file"
        ),
        "byte_limit",
        "modified_at",
    )


def freeze(
    spark: SparkSession, root: str, specs: Sequence[SourceSpec], folder: str
) -> DataFrame:
    """Fix the read boundary of a session as a stored table of files and sizes.

    Raises ``ValueError`` for links and files outside the root.
    """
    listing = list_files(spark, root, specs)
    listing.write.mode("overwrite").parquet(f"{folder}/frozen")
    frozen = spark.read.schema(listing.schema).parquet(f"{folder}/frozen")
    refuse_bad_paths(frozen, root)
    return frozen


def refuse_bad_paths(frozen: DataFrame, root: str) -> None:
    """Raise ``ValueError`` if a boundary holds a link or a file outside the root."""
    problem = path_problem(F.col("path"), root_uri(root))
    rejected = frozen.select(problem.alias("why")).filter("why IS NOT NULL").limit(1).collect()
    if rejected:
        raise ValueError(rejected[0]["why"])
