"""Joins that match NULL keys, and lists of very large groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.config import checkpoint_folder

# A list of large groups is broadcast up to this size, and joined by shuffle beyond.
MOST_BROADCAST_BYTES = 8 << 20
_BYTES_PER_ROW = 64  # of a broadcast row, beside its texts


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str
) -> DataFrame:
    """Equi-join in which a NULL key equals a NULL key; ``left`` keeps the keys."""
    renamed = {key: f"_right_{key}" for key in keys}
    other = right.withColumnsRenamed(renamed)
    condition = reduce(
        Column.__and__, [F.col(key).eqNullSafe(F.col(renamed[key])) for key in keys]
    )
    return left.join(other, condition, how).drop(*renamed.values())


class LargeGroups(NamedTuple):
    """All groups above a number of rows: the list, its length, the bytes of its keys, their rows."""

    groups: DataFrame
    count: int
    key_bytes: int
    rows: int

    def sized(self, frame: DataFrame, more_bytes: int = 0) -> DataFrame:
        """``frame``, with one row for each group, broadcast if that is known to be small.

        ``more_bytes`` is what a row holds beside its keys.
        """
        whole = self.key_bytes + self.count * (_BYTES_PER_ROW + more_bytes)
        return F.broadcast(frame) if whole <= MOST_BROADCAST_BYTES else frame


def large_groups(df: DataFrame, keys: Sequence[str], more_than: int) -> LargeGroups:
    """Every group above ``more_than`` rows; runs one job that counts rows by key.

    There are at most rows / more_than of them. The list is written to the checkpoint
    folder, so it is computed once, and an empty one spares the caller its large branch.
    """
    checkpoint_folder(df.sparkSession)
    counted = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    listed = counted.filter(F.col("_rows") > more_than).checkpoint()
    length = F.octet_length(F.concat_ws("", *[F.to_json(F.struct(key)) for key in keys]))
    size = listed.agg(F.count("*").alias("n"), F.sum(length).alias("bytes"), F.sum("_rows").alias("rows")).first()
    return LargeGroups(listed.select(*keys), size["n"], size["bytes"] or 0, size["rows"] or 0)


def reduce_with_label(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    additive: Mapping[str, Column],
    maxima: Mapping[str, Column],
) -> DataFrame:
    """Group by ``keys`` with additive aggregates, maxima and the least ``label``.

    A text aggregate beside numeric ones would make Spark sort all rows before
    combining them. Labels have few values, so they first join the grouping keys,
    rows combine by hashing, and the least label is picked from what is left.
    """
    combined = df.groupBy(*keys, label).agg(
        *[column.alias(name) for name, column in additive.items()],
        *[F.max(column).alias(name) for name, column in maxima.items()],
    )
    return combined.groupBy(*keys).agg(
        F.min(label).alias(label),
        *[F.sum(name).alias(name) for name in additive],
        *[F.max(name).alias(name) for name in maxima],
    )


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row frames, without a product."""
    together = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), single_rows
    )
    return together.agg(*[F.max(name).alias(name) for name in together.columns])
