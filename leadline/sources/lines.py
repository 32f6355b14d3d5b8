"""Lines with file-relative numbers and raw bytes, from files of any size.

Files are cut into equal byte ranges, so one huge file is many tasks. A first pass
counts line ends and hashes each range; a running sum over ranges gives each range
the number of its first line; a second pass cuts the ranges into lines.

Range digests are the leaves of a hash tree over each file: the digest of a prefix is that
of its leaves. Sessions store the leaves of whole ranges, so a later one may take them as
read and hash what grew, and the range the growth starts in, only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadline.functions.verdict import error_names
from leadline.sources.files import open_file

# Fixed value: fingerprints of longer files depend on it.
RANGE_BYTES = 64 * 1024 * 1024
_READ_AHEAD = 1024 * 1024
_MOST_BYTES = (1 << 31) - 1  # offsets within a range are 32-bit
_ROWS_PER_BATCH = 8192
_NEWLINE = 10
_EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()

# ``mark`` is an offset inside the range; what is said of it is NULL without one.
_RANGE_FACTS = (
    "path string, start bigint, end bigint, mark bigint, newlines bigint, line_end bigint, "
    "digest string, digest_to_line_end string, digest_to_mark string, newlines_from_mark bigint"
)
_LINES = (
    "source string, source_file string, source_line_number bigint, raw binary, "
    "error_type string"
)


def _read(handle, start: int, length: int) -> bytes:
    handle.seek(start)
    content = handle.read(length)
    if len(content) != length:
        raise RuntimeError("a source file shrank while it was being read")
    return content


def _range_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with open_file(row["path"]) as handle:
                content = memoryview(_read(handle, row["start"], row["end"] - row["start"]))
            text = content.obj
            line_end = text.rfind(b"\n") + 1
            mark = None if row["mark"] is None else row["mark"] - row["start"]
            # One digest, read off at every offset that is asked for.
            digest, done, at = hashlib.sha256(), 0, {}
            for offset in sorted({line_end, len(content), *([] if mark is None else [mark])}):
                digest.update(content[done:offset])
                done, at[offset] = offset, digest.hexdigest()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        **row,
                        "newlines": text.count(b"\n"),
                        "line_end": row["start"] + line_end if line_end else None,
                        "digest": at[len(content)],
                        "digest_to_line_end": at[line_end],
                        "digest_to_mark": None if mark is None else at[mark],
                        "newlines_from_mark": None if mark is None else text.count(b"\n", mark),
                    }
                ],
                schema=_facts_schema(),
            )


def _facts_schema() -> pa.Schema:
    texts = ("path", "digest", "digest_to_line_end", "digest_to_mark")
    names = [part.split()[0] for part in _RANGE_FACTS.split(", ")]
    return pa.schema([(name, pa.string() if name in texts else pa.int64()) for name in names])


def _balanced(ranges: DataFrame, count: int) -> DataFrame:
    """Spread about ``count`` ranges evenly over tasks: tiny rows, but not tiny work."""
    most = 20 * ranges.sparkSession.sparkContext.defaultParallelism
    return ranges.repartition(min(max(count, 1), most))


def count_ranges(files: DataFrame, range_bytes: int) -> int:
    counted = files.agg(F.sum(F.ceil(F.col("byte_limit") / range_bytes))).first()
    return int(counted[0] or 0)


def grid(files: DataFrame, first: Column, last: Column, range_bytes: int) -> DataFrame:
    """Byte ranges between two offsets of each file, cut at multiples of the range size."""
    numbers = F.when(
        last > first,
        F.sequence(F.floor(first / range_bytes), F.ceil(last / range_bytes) - F.lit(1)),
    )
    return (
        files.filter(last > first)
        .withColumn("_number", F.explode(numbers))
        .withColumns(
            {
                "start": F.greatest(F.col("_number") * range_bytes, first),
                "end": F.least((F.col("_number") + 1) * range_bytes, last),
            }
        )
        .drop("_number")
    )


def range_facts(
    spark: SparkSession, ranges: DataFrame, folder: str, count: int
) -> DataFrame:
    """Line ends and digests of byte ranges (path, start, end, mark), as a stored table."""
    wanted = ranges.select("path", "start", "end", "mark").distinct()
    facts = _balanced(wanted, count).mapInArrow(_range_facts, _RANGE_FACTS)
    facts.write.mode("append").parquet(f"{folder}/ranges")
    return spark.read.schema(facts.schema).parquet(f"{folder}/ranges")


def prefix_digest(digests: Column) -> Column:
    """Digest of a prefix from the structs (start, digest) of its ranges.

    A prefix of one range has the plain sha256 of its bytes; a longer one the sha256
    of its ranges' digests in order, so that no task has to read all of a file.
    """
    in_order = F.transform(F.array_sort(digests), lambda part: part["digest"])
    return (
        F.when(F.size(in_order) == 0, F.lit(_EMPTY_DIGEST))
        .when(F.size(in_order) == 1, in_order[0])
        .otherwise(F.sha2(F.encode(F.array_join(in_order, ""), "utf-8"), 256))
    )


def _line_batches(row: dict, classify: bool) -> Iterator[pa.RecordBatch]:
    start, end, stop = row["start"], row["end"], row["stop"]
    lead = 0 if row["is_first"] else 1
    with open_file(row["path"]) as handle:
        content = _read(handle, start - lead, end - start + lead)
        parts, at = [content], end
        while at < stop and not parts[-1].endswith(b"\n"):
            more = _read(handle, at, min(_READ_AHEAD, stop - at))
            cut = more.find(b"\n")
            parts.append(more if cut < 0 else more[: cut + 1])
            at += len(more)
            if cut >= 0:
                break
    content = b"".join(parts)
    ends = np.flatnonzero(np.frombuffer(content, dtype=np.uint8) == _NEWLINE) + 1
    number = row["lines_before"] + 1
    begin = 0
    if lead:
        if not len(ends):
            return  # the whole range lies inside one line of an earlier range
        begin = int(ends[0])
        ends = ends[1:]
        if begin > 1:  # the range starts inside a line
            number += 1
    if begin < len(content) and (not len(ends) or ends[-1] < len(content)):
        ends = np.append(ends, len(content))
    begins = np.concatenate(([begin], ends[:-1])) if len(ends) else np.empty(0, dtype=np.int64)
    owned = int(np.searchsorted(begins, end - start + lead))
    if not owned:
        return
    if ends[owned - 1] > _MOST_BYTES:
        raise ValueError(f"a range and its last line exceed 2 GiB in {row['source_file']}")
    offsets = np.append(begins[:owned], ends[owned - 1]).astype(np.int32)
    raws = pa.BinaryArray.from_buffers(
        pa.binary(), owned, [None, pa.py_buffer(offsets), pa.py_buffer(content)]
    )
    for first in range(0, owned, _ROWS_PER_BATCH):
        piece = raws.slice(first, _ROWS_PER_BATCH)
        rows = len(piece)
        errors = error_names(piece) if classify else pa.nulls(rows, pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row["source"]] * rows, pa.string()),
                pa.array([row["source_file"]] * rows, pa.string()),
                pa.array(np.arange(number + first, number + first + rows), pa.int64()),
                piece,
                errors,
            ],
            names=["source", "source_file", "source_line_number", "raw", "error_type"],
        )


def read_lines(plan: DataFrame, count: int, classify: bool = True) -> DataFrame:
    """Lines of about ``count`` planned ranges (see ``plan_ranges``), each with its verdict."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _line_batches(row, classify)

    return _balanced(plan, count).mapInArrow(scan, _LINES)


def plan_ranges(
    files: DataFrame, facts: DataFrame, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Ranges between each file's ``start_byte`` and ``stop``, with lines before each.

    ``files`` has source, path, source_file, start_byte, start_line and stop.
    """
    # The first range may start inside one of the facts, at its mark.
    counted = facts.select(
        "path",
        F.explode(
            F.array(
                F.struct("start", "end", "newlines"),
                F.struct(F.col("mark").alias("start"), "end", F.col("newlines_from_mark").alias("newlines")),
            )
        ).alias("_range"),
    ).select("path", "_range.*")
    ranges = grid(files, F.col("start_byte"), F.col("byte_limit"), range_bytes).join(
        counted.filter("start < end").distinct(), ["path", "start", "end"]
    )
    earlier = (
        Window.partitionBy("source", "path")
        .orderBy("start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("newlines").over(earlier), F.lit(0))
    return (
        ranges.withColumn("lines_before", F.col("start_line") + before)
        .filter(F.col("start") < F.col("stop"))
        .select(
            "source",
            "source_file",
            "path",
            "start",
            F.least("end", "stop").alias("end"),
            "stop",
            (F.col("start") == F.col("start_byte")).alias("is_first"),
            "lines_before",
        )
    )


# How a session makes sure that what it read before is still there.
FULL, GROWTH = "full", "growth"


def _with_saved(frozen: DataFrame, saved: Optional[DataFrame]) -> DataFrame:
    """Frozen files with where their last session stopped, if they still reach that far."""
    names = {"saved_offset": "byte_offset", "saved_line": "line_number", "saved_digest": "prefix_sha256"}
    if saved is None:
        kinds = ("bigint", "bigint", "string")
        return frozen.withColumns({new: F.lit(None).cast(kind) for new, kind in zip(names, kinds)})
    stopped = saved.select("source_file", *[F.col(old).alias(new) for new, old in names.items()])
    files = frozen.join(stopped, "source_file", "left")
    usable = F.col("saved_offset") <= F.col("byte_limit")
    return files.withColumn("saved_offset", F.when(usable, F.col("saved_offset")))


def _known_leaves(files: DataFrame, leaves: DataFrame, range_bytes: int) -> DataFrame:
    """Stored leaves below the range in which each file's saved offset lies; complete or none."""
    below = F.floor((F.col("saved_offset") - 1) / range_bytes) * range_bytes
    placed = files.filter(below > 0).select("path", "source_file", below.alias("_below"))
    found = leaves.join(placed, "source_file").filter(
        (F.col("end") <= F.col("_below")) & (F.col("end") - F.col("start") == range_bytes) & (F.col("start") % range_bytes == 0)
    )
    whole = found.groupBy("path").agg(F.sum(F.col("end") - F.col("start")).alias("_sum"), F.max("_below").alias("_needed"))
    complete = whole.filter("_sum = _needed").select("path")
    return found.join(complete, "path", "left_semi").select(
        "path",
        "start",
        "end",
        F.lit(None).cast("bigint").alias("mark"),
        "newlines",
        "line_end",
        "digest",
        "digest_to_line_end",
        F.lit(None).cast("string").alias("digest_to_mark"),
        F.lit(None).cast("bigint").alias("newlines_from_mark"),
    )


def _judged(files: DataFrame, facts: DataFrame) -> DataFrame:
    """Files with the digests of their prefixes, and whether each resumes where it stopped."""
    part = F.struct("start", "end", "mark", "digest", "digest_to_line_end", "digest_to_mark")
    by_file = facts.groupBy("path").agg(
        F.collect_list(part).alias("_parts"),
        F.coalesce(F.max("line_end"), F.lit(0)).cast("bigint").alias("last_line_end"),
    )
    offset, last_end = F.col("saved_offset"), F.col("last_line_end")

    def upto(end: Column, at_end: str) -> Column:
        """Leaves of the prefix that ends here: the range it ends in counts up to there."""
        return F.transform(
            F.filter("_parts", lambda part: part["start"] < end),
            lambda part: F.struct(
                part["start"].alias("start"),
                F.when(part["end"] > end, part[at_end]).otherwise(part["digest"]).alias("digest"),
            ),
        )

    nothing = F.lit(_EMPTY_DIGEST)
    known = files.join(by_file, "path", "left").withColumns(
        {
            "fingerprint": F.coalesce(prefix_digest(upto(F.col("byte_limit"), "digest")), nothing),
            "found_digest": F.coalesce(prefix_digest(upto(offset, "digest_to_mark")), nothing),
            "held_digest": F.coalesce(prefix_digest(upto(last_end, "digest_to_line_end")), nothing),
            "last_line_end": F.coalesce(last_end, F.lit(0).cast("bigint")),
        }
    )
    same = offset.isNotNull() & (F.col("found_digest") == F.col("saved_digest"))
    return known.withColumn("resumes", F.coalesce(same, F.lit(False))).drop("_parts")


def resume_plan(
    spark: SparkSession,
    frozen: DataFrame,
    saved: Optional[DataFrame],
    folder: str,
    tail: str = "hold",
    range_bytes: int = RANGE_BYTES,
    leaves: Optional[DataFrame] = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Where each frozen file is read from and up to, the ranges to read, and new leaves.

    A file resumes at its saved offset only if the bytes before it are unchanged;
    a shorter or rewritten file starts over. Without ``leaves`` all bytes are hashed again.
    With those of earlier sessions only the growth is, and the range it starts in: a file
    whose earlier ranges alone were edited in place then goes unnoticed. ``tail`` decides
    about bytes after the last line end: ``hold`` leaves them for a later session, ``read``
    takes them as a line. The first result has one row for each file: start_byte, start_line,
    stop, fingerprint, hashed_bytes and the digest of the prefix up to ``stop``.
    """
    files = _with_saved(frozen, saved)
    offset, limit, zero = F.col("saved_offset"), F.col("byte_limit"), F.lit(0).cast("bigint")
    mark = F.when((offset > F.col("start")) & (offset <= F.col("end")), offset).alias("mark")

    def hashed(some: DataFrame, first: Column, last: Column) -> DataFrame:
        ranges = grid(some, first, last, range_bytes).select("path", "start", "end", mark)
        return range_facts(spark, ranges, folder, count_ranges(frozen, range_bytes))

    if leaves is None or saved is None:
        facts = hashed(files, zero, limit)
        judged = _judged(files, facts)
    else:
        # A small table: as many rows as the files have ranges.
        known = _known_leaves(files, leaves, range_bytes)
        known.write.mode("overwrite").parquet(f"{folder}/leaves")
        known = spark.read.schema(known.schema).parquet(f"{folder}/leaves")
        covered = known.groupBy("path").agg(F.max("end").alias("covered"))
        files = files.join(covered, "path", "left").withColumn("covered", F.coalesce("covered", zero))
        facts = hashed(files, F.col("covered"), limit)
        doubtful = _judged(files, facts.unionByName(known)).filter("NOT resumes AND covered > 0")
        changed = doubtful.select(*files.columns)
        changed.write.mode("overwrite").parquet(f"{folder}/changed")
        changed = spark.read.schema(changed.schema).parquet(f"{folder}/changed")
        if not changed.isEmpty():
            facts = hashed(changed, zero, F.col("covered"))
        known = known.join(changed.select("path"), "path", "left_anti")
        judged = _judged(files, facts.unionByName(known))
    resumes, line_end = F.col("resumes"), F.col("last_line_end")
    start = F.when(resumes, offset).otherwise(zero)
    # Nothing new but an unfinished line: stay where the session started.
    stop = F.greatest(start, line_end) if tail == "hold" else limit
    sizes = facts.groupBy("path").agg(F.sum(F.col("end") - F.col("start")).alias("hashed_bytes"))
    planned = judged.join(sizes, "path", "left").select(
        "source",
        "path",
        "source_file",
        "byte_limit",
        "modified_at",
        "fingerprint",
        start.alias("start_byte"),
        F.when(resumes, F.col("saved_line")).otherwise(zero).alias("start_line"),
        stop.alias("stop"),
        F.when(stop == limit, F.col("fingerprint"))
        .when(stop == line_end, F.col("held_digest"))
        .otherwise(F.col("saved_digest"))
        .alias("prefix_digest"),
        F.coalesce("hashed_bytes", zero).alias("hashed_bytes"),
    )
    planned.write.mode("overwrite").parquet(f"{folder}/files")
    stored = spark.read.schema(planned.schema).parquet(f"{folder}/files")
    all_facts = facts if leaves is None or saved is None else facts.unionByName(known)
    fresh = facts.filter(F.col("end") - F.col("start") == range_bytes).join(
        stored.select("path", "source_file").distinct(), "path"
    )
    return stored, plan_ranges(stored, all_facts, range_bytes), fresh
