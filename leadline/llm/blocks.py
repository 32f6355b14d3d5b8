"""Documents in blocks, keys in buckets: the one exchange pattern of this package.

A *block* is a set of whole documents chosen by a hash of the id, some megabytes of text.
A *bucket* is a share of the key space (hashes of shingles, symbols, words). A block first
combines equal keys of its own documents, so a key held by a third of all documents reaches
its bucket as one entry for each block. Entries travel as packed arrays: one row for each
pair of block and bucket, not one for each key. Buckets answer to blocks in the same way.

Both sides are pure functions of their rows, so a lost task is simply run again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
# Above this many blocks they grow instead, so one key has at most this many entries.
MOST_BLOCKS = 1_000_000
LAST = np.iinfo(np.int64).max


def count_blocks(frame: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks for this much text; at least one."""
    total = frame.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return int(min(MOST_BLOCKS, total // block_bytes + 1))


def in_blocks(frame: DataFrame, ident: str, text: str, blocks: int, *extra: Column) -> DataFrame:
    """Rows (block, id, data and what ``extra`` names); data are the bytes of the text.

    A null id counts as the largest one in comparisons; a null text as empty.
    """
    key = F.col(ident).cast("long")
    return frame.select(
        F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"),
        key.alias("id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"),
        *extra,
    )


def rows_of(table: pa.Table) -> tuple[np.ndarray, list[bytes], pa.Table]:
    """Ids (null: the largest), texts and the table, ordered by id and then by text."""
    texts = table.column("data").to_pylist()
    ids = table.column("id").fill_null(LAST).to_numpy()
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order], table.take(pa.array(order, pa.int64()))


def id_column(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == LAST)


def packed_schema(key: str, arrays: int) -> str:
    """Columns of packed entries: where they go, where they come from, the arrays."""
    other = "bucket" if key == "block" else "block"
    return ", ".join([f"{key} int", f"{other} int", *(f"a{i} binary" for i in range(arrays))])


def pack(key: str, source: int, goes_to: np.ndarray, arrays: list[np.ndarray]) -> pa.Table:
    """One row for each destination present, its entries in the order given."""
    other = "bucket" if key == "block" else "block"
    order = np.argsort(goes_to, kind="stable")
    where = goes_to[order]
    starts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]]) if len(where) else where[:0]
    ends = np.r_[starts[1:], len(where)] if len(where) else starts
    columns = {
        key: pa.array(where[starts].astype(np.int32)),
        other: pa.array(np.full(len(starts), source, np.int32)),
    }
    for i, array in enumerate(arrays):
        array = array[order]
        parts = [_narrow(array[a:b]) for a, b in zip(starts, ends, strict=True)]
        columns[f"a{i}"] = pa.array(parts, pa.binary())
    return pa.table(columns)


def _narrow(array: np.ndarray) -> bytes:
    """The width in bytes, then the values; numbers take the least width that holds them."""
    if array.dtype == np.int64 and len(array) and array.min() >= 0:
        most = array.max()
        for kind in (np.uint8, np.uint16, np.uint32):
            if most <= np.iinfo(kind).max:
                array = array.astype(kind)
                break
    return bytes([array.itemsize]) + array.tobytes()


_UNSIGNED = {1: np.uint8, 2: np.uint16, 4: np.uint32}


def unpack(table: pa.Table, index: int, dtype: type = np.int64) -> list[np.ndarray]:
    """The arrays of one packed column, one for each row."""
    found = []
    for part in table.column(f"a{index}").to_pylist():
        kind = dtype if part[0] == 8 else _UNSIGNED[part[0]]
        found.append(np.frombuffer(part, kind, offset=1).astype(dtype))
    return found


def joined(table: pa.Table, index: int, dtype: type = np.int64) -> np.ndarray:
    """One packed column of all rows, end to end."""
    return np.concatenate([np.zeros(0, dtype), *unpack(table, index, dtype)])


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys % np.uint64(buckets)).astype(np.int64)


class Sent:
    """What a block sent to which bucket, so that answers can name entries by number.

    A block computes its entries anew with each pass, in the same order.
    """

    def __init__(self, goes_to: np.ndarray) -> None:
        self.order = np.argsort(goes_to, kind="stable")
        where = goes_to[self.order]
        self.first = dict(zip(*np.unique(where, return_index=True), strict=True))

    def entries(self, buckets: list[int], numbers: list[np.ndarray]) -> np.ndarray:
        """The entries that these buckets answered, in the order of the answers."""
        places = [self.first[bucket] + number for bucket, number in zip(buckets, numbers, strict=True)]
        return self.order[np.concatenate([np.zeros(0, np.int64), *places])]


def numbered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of a bucket: its block, and its number in what that block sent."""
    sizes = [(len(part) - 1) // part[0] for part in table.column("a0").to_pylist()]
    block = np.repeat(table.column("block").to_numpy(), sizes)
    number = np.concatenate([np.zeros(0, np.int64), *map(np.arange, sizes)])
    return block.astype(np.int64), number
