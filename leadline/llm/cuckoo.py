"""Exact dedup over an index of cuckoo filters.

The index is a table with one row for each shard of the digest space. A shard holds a cuckoo
filter (two candidate buckets of four fingerprints for each key) and, slot by slot, the full
digests with their least id and count. A fingerprint hit is verified against the digest in
that slot, so two texts are equal only if their SHA-256 is. A full filter is rebuilt with
twice the buckets from the stored digests. Deleting lowers a count and frees the slot at
zero; a digest that lives on gets the least id of the rows that are left.

Rows of one digest are combined by Spark before a shard sees them, so a text that a third of
all rows hold is one entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.llm.words import GAP

KEYS_PER_SHARD = 50_000
SLOTS = 4
MOST_KICKS = 200
INDEX = "shard int, buckets int, prints binary, digests binary, ids binary, counts binary"
NO_ID = np.iinfo(np.int64).max


class CuckooShard:
    """Digests of 32 bytes with a least id and a count."""

    def __init__(self, buckets: int = 64) -> None:
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        """``buckets`` is a power of two."""
        self.buckets = buckets
        self.prints = [0] * (buckets * SLOTS)
        self.digests: list[bytes] = [b""] * (buckets * SLOTS)
        self.ids = [NO_ID] * (buckets * SLOTS)
        self.counts = [0] * (buckets * SLOTS)

    def _print(self, digest: bytes) -> int:
        return int.from_bytes(digest[8:10], "little") or 1  # 0 marks an empty slot

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = self._print(digest)
        first = int.from_bytes(digest[10:16], "little") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.buckets - 1)

    def find(self, digest: bytes) -> int:
        """The slot that holds this digest, or -1."""
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.digests[slot] == digest:
                    return slot
        return -1

    def insert(self, digest: bytes, ident: int, count: int) -> None:
        slot = self.find(digest)
        if slot >= 0:
            self.ids[slot] = min(self.ids[slot], ident)
            self.counts[slot] += count
            return
        entry = self._place((digest, ident, count))
        while entry is not None:
            entry = self._grow(entry)

    def delete(self, digest: bytes, count: int) -> bool:
        """Take back ``count`` rows of a digest; False if it is not there.

        Which ids are left only the rows know: see ``rename``.
        """
        slot = self.find(digest)
        if slot < 0:
            return False
        self.counts[slot] -= count
        if self.counts[slot] <= 0:
            self.prints[slot], self.digests[slot] = 0, b""
            self.ids[slot], self.counts[slot] = NO_ID, 0
        return True

    def rename(self, digest: bytes, ident: int) -> None:
        """The least id of the rows that a digest has left."""
        slot = self.find(digest)
        if slot >= 0:
            self.ids[slot] = ident

    def _put(self, slot: int, entry: tuple[bytes, int, int]) -> None:
        self.prints[slot] = self._print(entry[0])
        self.digests[slot], self.ids[slot], self.counts[slot] = entry

    def _place(self, entry: tuple[bytes, int, int]) -> tuple[bytes, int, int] | None:
        """Store an entry; returns the one left over if kicking did not end."""
        _, first, second = self._places(entry[0])
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self._put(slot, entry)
                    return None
        bucket = first
        for kick in range(MOST_KICKS):
            slot = bucket * SLOTS + kick % SLOTS
            moved = (self.digests[slot], self.ids[slot], self.counts[slot])
            self._put(slot, entry)
            entry = moved
            bucket = self._other(bucket, self._print(entry[0]))
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[free]:
                    self._put(free, entry)
                    return None
        return entry

    def _grow(self, extra: tuple[bytes, int, int]) -> tuple[bytes, int, int] | None:
        """Twice the buckets, filled again from the stored digests."""
        held = [*self.entries(), extra]
        buckets = self.buckets
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._place(entry) is None for entry in held):
                return None

    def entries(self) -> list[tuple[bytes, int, int]]:
        return [
            (self.digests[slot], self.ids[slot], self.counts[slot])
            for slot, mark in enumerate(self.prints)
            if mark
        ]

    def to_table(self, shard: int) -> pa.Table:
        row = {
            "shard": pa.array([shard], pa.int32()),
            "buckets": pa.array([self.buckets], pa.int32()),
            "prints": pa.array([np.array(self.prints, np.uint16).tobytes()], pa.binary()),
            "digests": pa.array([b"".join(d or bytes(32) for d in self.digests)], pa.binary()),
            "ids": pa.array([np.array(self.ids, np.int64).tobytes()], pa.binary()),
            "counts": pa.array([np.array(self.counts, np.int64).tobytes()], pa.binary()),
        }
        return pa.table(row)

    @classmethod
    def from_row(cls, row: dict) -> CuckooShard:
        shard = cls(row["buckets"])
        shard.prints = np.frombuffer(row["prints"], np.uint16).tolist()
        blob = row["digests"]
        shard.digests = [blob[i : i + 32] if m else b"" for i, m in zip(range(0, len(blob), 32), shard.prints, strict=True)]
        shard.ids = np.frombuffer(row["ids"], np.int64).tolist()
        shard.counts = np.frombuffer(row["counts"], np.int64).tolist()
        return shard


def digest_of(text: Column) -> Column:
    """SHA-256 of the text with each run of white space as one space; null as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " "), 256))


def _by_shard(entries: DataFrame, shards: int) -> DataFrame:
    """Rows (digest, id, n), one for each digest, with their shard."""
    number = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    rows = entries.groupBy("digest").agg(F.min(F.coalesce("id", F.lit(NO_ID))).alias("id"), F.sum("n").alias("n"))
    return rows.select(number.alias("shard"), "digest", "id", "n")


def build_index(entries: DataFrame, shards: int) -> DataFrame:
    """Index of rows (digest binary, id long, n long)."""

    def fill(table: pa.Table) -> pa.Table:
        shard = CuckooShard()
        columns = (table.column(name).to_pylist() for name in ("digest", "id", "n"))
        for digest, ident, count in zip(*columns, strict=True):
            shard.insert(digest, ident, count)
        return shard.to_table(table.column("shard")[0].as_py())

    return _by_shard(entries, shards).groupBy("shard").applyInArrow(lambda table: fill(table), INDEX)


def update_index(index: DataFrame, entries: DataFrame, stored: DataFrame, shards: int) -> DataFrame:
    """The index after inserting rows with n > 0 and deleting those with n < 0.

    ``stored`` are the rows (digest, id) that are live after the change; those of shrunken
    digests say which id is the least now.
    """

    def change(held: pa.Table, rows: pa.Table) -> pa.Table:
        found = held.to_pylist()
        shard = CuckooShard.from_row(found[0]) if found else CuckooShard()
        columns = (rows.column(name).to_pylist() for name in ("digest", "id", "n"))
        # Insertions, then deletions, then new least ids (n = 0).
        changes = sorted(zip(*columns, strict=True), key=lambda change: (change[2] == 0, change[2] < 0))
        for digest, ident, count in changes:
            if count > 0:
                shard.insert(digest, ident, count)
            elif count < 0:
                shard.delete(digest, -count)
            else:
                shard.rename(digest, ident)
        number = found[0]["shard"] if found else rows.column("shard")[0].as_py()
        return shard.to_table(number)

    shrunk = entries.where("n < 0")
    named = stored.join(shrunk.select("digest").distinct(), "digest", "left_semi").select("digest", "id", F.lit(0).alias("n"))
    grown, shrunk, named = (_by_shard(rows, shards) for rows in (entries.where("n > 0"), shrunk, named))
    return (
        index.groupBy("shard")
        .cogroup(grown.unionByName(shrunk).unionByName(named).groupBy("shard"))
        .applyInArrow(lambda held, rows: change(held, rows), INDEX)
    )


def index_entries(index: DataFrame) -> DataFrame:
    """Live digests of an index: digest, keep_id, group_size."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = CuckooShard.from_row(row).entries()
                yield pa.record_batch(
                    {
                        "digest": pa.array([entry[0] for entry in held], pa.binary()),
                        "keep_id": pa.array([None if e[1] == NO_ID else e[1] for e in held], pa.int64()),
                        "group_size": pa.array([entry[2] for entry in held], pa.int64()),
                    }
                )

    return index.mapInArrow(read, "digest binary, keep_id long, group_size long")


def _rows(documents: DataFrame, ident: str, text: str) -> DataFrame:
    """Id, digest and how often both occur together; written once to the shared folder."""
    return (
        documents.select(F.col(ident).cast("long").alias("id"), digest_of(F.col(text)).alias("digest"))
        .groupBy("id", "digest")
        .agg(F.count(F.lit(1)).alias("n"))
        .checkpoint()
    )


def _classed(rows: DataFrame) -> DataFrame:
    shards = rows.count() // KEYS_PER_SHARD + 1
    return rows.join(index_entries(build_index(rows, shards)), "digest")


def exact_groups(documents: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``documents``: ident, keep_id, group_size, kept, digest.

    * Texts are equal if they are once each run of white space is one space; null counts as
      the empty text.
    * The row of least id stays; a null id is larger than all others. Of rows repeated with
      one id and equal texts, one stays.
    * Other columns are ignored; an empty table gives an empty result.
    """
    first = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return (
        _classed(_rows(documents, ident, text))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select(F.col("id").alias(ident), "keep_id", "group_size", first.alias("kept"), "digest")
    )


def keep_first(documents: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns and no others.

    Where a row is repeated with id and text, any one of the repetitions stays.
    """
    rows = _rows(documents, ident, text)
    key, digest = fresh_name(documents.columns, "key"), fresh_name(documents.columns, "digest")
    stays = _classed(rows).where(F.col("id").eqNullSafe(F.col("keep_id")))
    stays = stays.select(F.col("id").alias(key), F.col("digest").alias(digest + "_"))
    found = documents.withColumn(digest, digest_of(F.col(text)))
    same = F.col(ident).cast("long").eqNullSafe(F.col(key)) & (F.col(digest) == F.col(digest + "_"))
    found = found.join(stays, same, "left_semi")
    if rows.where("n > 1").limit(1).count():
        found = found.dropDuplicates([ident, digest])
    return found.drop(digest)


def fresh_name(names: list[str], wish: str) -> str:
    """A column name that is not taken, with or without a further underscore."""
    taken = {name.lower().rstrip("_") for name in names}
    while wish in taken:
        wish += "x"
    return wish
