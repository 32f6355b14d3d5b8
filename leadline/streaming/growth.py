"""A stream of frozen file boundaries, and incremental ingest driven by it.

The stream carries no log content: each micro-batch names the files that grew and
the size each had when the batch was planned. The batch is then one ingest session,
which reads exactly up to those sizes on the executors.

Its offset is the number of a version of the listing. Versions are Parquet files beside the
checkpoint, one for each change, so an offset has one size whatever the number of files, and
a batch that is planned again after a failure finds the versions it lies between.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import re
from collections.abc import Iterator, Sequence
from typing import Optional
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from leadline.config import delete_folder, prepare_session, shared_folder
from leadline.plans.ingest import ingest_session
from leadline.sources.files import root_uri
from leadline.sources.lines import GROWTH
from leadline.sources.specs import EVENT_SOURCES, SourceSpec

_BOUNDARY = (
    "source string, path string, source_file string, byte_limit bigint, modified_at timestamp"
)
_VERSION = pa.schema(
    [("source", pa.string()), ("name", pa.string()), ("size", pa.int64()), ("modified_ns", pa.int64())]
)
FILES_PER_PARTITION = 10_000
_MAGIC = re.compile(r"[*?\[]")


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    if urlsplit(uri).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlsplit(uri).path
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def matching_files(files: pafs.FileSystem, base: str, glob: str) -> Iterator[pafs.FileInfo]:
    """Files below ``base`` that match, folder part by folder part as in a batch listing.

    Folders without a wildcard are not listed.
    """
    folders = [base.rstrip("/")]
    *above, last = glob.split("/")
    for part in above:
        if not _MAGIC.search(part):
            folders = [f"{folder}/{part}" for folder in folders]
            continue
        found = (info for folder in folders for info in _inside(files, folder))
        folders = [
            info.path for info in found if info.type == pafs.FileType.Directory and fnmatch.fnmatchcase(info.base_name, part)
        ]
    for folder in folders:
        for info in _inside(files, folder):
            if info.type == pafs.FileType.File and fnmatch.fnmatchcase(info.base_name, last):
                yield info


def _inside(files: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    return files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))


class _Boundary(InputPartition):
    """Some of the files that a version has and the one before it lacks."""

    def __init__(self, start: int, end: int, part: int, parts: int):
        self.start, self.end, self.part, self.parts = start, end, part, parts


class _GrowthReader(DataSourceStreamReader):
    """Offsets are ``{"version": n}``; version 0 is the empty listing."""

    def __init__(self, root: str, specs: Sequence[tuple[str, str]], versions: str):
        self.root = root
        self.specs = specs
        self.versions = versions

    def initialOffset(self) -> dict:
        return {"version": 0}

    def _path(self, version: int) -> tuple[pafs.FileSystem, str]:
        files, folder = _store(self.versions)
        return files, f"{folder}/{version:012d}.parquet"

    def _read(self, version: int) -> pa.Table:
        if version == 0:
            return _VERSION.empty_table()
        files, path = self._path(version)
        return pq.read_table(path, filesystem=files)

    def _latest(self) -> int:
        files, folder = _store(self.versions)
        numbers = [int(info.base_name[:12]) for info in _inside(files, folder) if info.base_name.endswith(".parquet")]
        return max(numbers, default=0)

    def _listing(self) -> pa.Table:
        files, base = _store(self.root)
        rows = sorted(
            (source, info.path[len(base.rstrip("/")) + 1 :], info.size, info.mtime_ns or 0)
            for source, glob in self.specs
            for info in matching_files(files, base, glob)
        )
        columns = list(zip(*rows, strict=True)) or [()] * len(_VERSION)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _VERSION, strict=True)], schema=_VERSION)

    def latestOffset(self) -> dict:
        """The number of the newest version, a new one if the files have changed."""
        version, listing = self._latest(), self._listing()
        if not listing.equals(self._read(version)):
            version += 1
            files, path = self._path(version)
            files.create_dir(path.rpartition("/")[0], recursive=True)
            # Written aside, so that a version is whole or absent.
            pq.write_table(listing, f"{path}.new", filesystem=files)
            files.move(f"{path}.new", path)
        return {"version": version}

    def _grown(self, start: int, end: int) -> list[tuple]:
        rows = [tuple(row.values()) for row in self._read(end).to_pylist()]
        before = {tuple(row.values()) for row in self._read(start).to_pylist()}
        return [row for row in rows if row not in before]

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        first, last = start.get("version", 0), end["version"]
        parts = -(-len(self._grown(first, last)) // FILES_PER_PARTITION)
        return [_Boundary(first, last, part, parts) for part in range(parts)]

    def read(self, partition: _Boundary) -> Iterator[tuple]:
        grown = self._grown(partition.start, partition.end)
        for source, name, size, modified_ns in grown[partition.part :: partition.parts]:
            modified = dt.datetime.fromtimestamp(modified_ns / 1e9, dt.timezone.utc)
            yield source, f"{self.root}/{name}", name, size, modified

    def commit(self, end: dict) -> None:
        """Versions before the one a restart may ask for are not needed again."""
        files, folder = _store(self.versions)
        for info in _inside(files, folder):
            if info.base_name.endswith(".parquet") and int(info.base_name[:12]) < end["version"] - 1:
                files.delete_file(info.path)


class GrowingFiles(DataSource):
    """Options: ``root``, ``versions`` (a shared folder), and ``specs`` as ``source=glob`` pairs
    separated by ``;``."""

    @classmethod
    def name(cls) -> str:
        return "growing_files"

    def schema(self) -> str:
        return _BOUNDARY

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        pairs = [pair.split("=", 1) for pair in self.options["specs"].split(";")]
        return _GrowthReader(self.options["root"], [(s, g) for s, g in pairs], self.options["versions"])


def growing_files(
    spark: SparkSession, root: str, versions: str, specs: Sequence[SourceSpec] = EVENT_SOURCES
) -> DataFrame:
    """Streaming DataFrame of files that grew, with their frozen sizes.

    ``versions`` is a folder of this stream, kept as long as its checkpoint.
    """
    prepare_session(spark)
    spark.dataSource.register(GrowingFiles)
    return (
        spark.readStream.format("growing_files")
        .option("root", root_uri(root))
        .option("versions", root_uri(versions))
        .option("specs", ";".join(f"{spec.name}={spec.glob}" for spec in specs))
        .load()
    )


def ingest_stream(
    spark: SparkSession,
    root: str,
    data: str,
    checkpoint: str,
    version: Optional[str] = None,
    specs: Sequence[SourceSpec] = EVENT_SOURCES,
    every: Optional[str] = None,
    tail: str = "hold",
    verify: str = GROWTH,
) -> StreamingQuery:
    """Keep storing new events; without ``every`` take what is there and stop.

    Each batch hashes what grew (``verify``, see ``ingest_session``); batches follow one
    another closely, and hashing all of every file each time would grow with its square.

    A repeated micro-batch stores nothing twice, because events are known by id.
    """

    def session(batch: DataFrame, _batch_id: int) -> None:
        folder = shared_folder(batch.sparkSession, "boundary")
        try:
            batch.write.mode("overwrite").parquet(folder)
            frozen = batch.sparkSession.read.schema(batch.schema).parquet(folder)
            if not frozen.isEmpty():
                ingest_session(
                    batch.sparkSession,
                    root,
                    data,
                    version=version,
                    specs=specs,
                    tail=tail,
                    frozen=frozen,
                    verify=verify,
                )
        finally:
            delete_folder(batch.sparkSession, folder)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        growing_files(spark, root, f"{checkpoint.rstrip('/')}-listing", specs)
        .writeStream.foreachBatch(session)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
