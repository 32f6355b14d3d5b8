"""The published document: written whole, mirrored, and verified by reading it back."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
from collections.abc import Mapping
from typing import Optional

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from leadline.plans.contracts import MAX_AGE_SECONDS, ContractError, check_document


def _write(path: str, content: bytes) -> None:
    """Write beside the target and move into place, so readers see all or nothing."""
    if "://" in path:
        files, target = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    else:
        files, target = pafs.LocalFileSystem(), os.path.abspath(path)
    files.create_dir(os.path.dirname(target), recursive=True)
    with files.open_output_stream(target + ".tmp") as stream:
        stream.write(content)
    files.move(target + ".tmp", target)


def export_snapshot(
    document: Mapping[str, object],
    out: str,
    mirror: Optional[str] = None,
    now: Optional[dt.datetime] = None,
    max_age: int = MAX_AGE_SECONDS,
) -> dict[str, object]:
    """Check the document, then write it; the mirror gets the same bytes."""
    counts = check_document(document, now, max_age)
    content = (json.dumps(document, indent=2, sort_keys=True, default=str) + "\n").encode()
    for path in filter(None, (out, mirror)):
        _write(path, content)
    return {
        "output": out,
        "mirror": mirror,
        "bytes": len(content),
        "sha256": hashlib.sha256(content).hexdigest(),
        "datasets": counts,
    }


def verify_export(
    spark: SparkSession,
    path: str,
    sha256: str,
    now: Optional[dt.datetime] = None,
    max_age: int = MAX_AGE_SECONDS,
) -> dict[str, int]:
    """Stored bytes must have the digest, and the rules must hold for them again."""
    stored = (
        spark.read.format("binaryFile")
        .load(path)
        .select(F.sha2("content", 256).alias("sha256"), F.decode("content", "utf-8").alias("text"))
        .first()
    )
    if stored["sha256"] != sha256:
        raise ContractError("the stored snapshot differs from the one written")
    return check_document(json.loads(stored["text"]), now, max_age)
