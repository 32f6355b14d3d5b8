"""Row-to-row operators over long sequences: previous row, and last known value.

A window over a key puts all rows of the key into one task, which fails when one
key holds a large share of the data. Here the rows of every key above ``rows_per_slice``
rows are sorted once into ranges of (key, order) and stored; rows of a range are cut into
slices by their place in it, so slices are even whatever keys, times and ties are. Each slice
is reduced to its last state, the few states of a key are scanned in order, and each slice
gets the one before it as an extra row at its head. So the result is that of the uncut
window, and no row looks anything up. One job first counts rows by key; rows of smaller keys
take a plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadline.operators.keys import join_null_safe, large_groups

ROWS_PER_SLICE = 250_000
# Small slices share a range partition of about this many rows.
ROWS_PER_RANGE = 10_000
# monotonically_increasing_id holds the row's place in its partition below this bit.
_PLACE_BITS = 33


def in_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows_per_slice: int = ROWS_PER_SLICE
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of large keys with ``_slice``, and the rows of all other keys.

    Slices hold at most ``rows_per_slice`` rows that follow one another in ``order`` within
    their key, and their numbers rise with it; a slice may hold several keys. They are stored
    in the checkpoint folder: ranges are drawn from a sample, and one drawing must serve all
    uses. Without a large key the first part is None.
    """
    large = large_groups(df.select(*keys), keys, rows_per_slice)
    if not large.count:
        return None, df
    groups = large.sized(large.groups)
    ranges = -(-large.rows // max(rows_per_slice, ROWS_PER_RANGE))
    by = [F.col(key).asc_nulls_first() for key in keys] + list(order)
    ranged = join_null_safe(df, groups, keys, "left_semi").repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id()
    within = F.floor(place.bitwiseAND((1 << _PLACE_BITS) - 1) / F.lit(rows_per_slice)).cast("bigint")
    number = F.shiftleft(F.shiftright(place, _PLACE_BITS), _PLACE_BITS) + within
    return ranged.withColumn("_slice", number).checkpoint(), join_null_safe(df, groups, keys, "left_anti")


def _nulls_last(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def _as_struct(*names: str) -> Column:
    """A struct that sorts as the columns would with NULLs last."""
    parts: list[Column] = []
    for number, name in enumerate(names):
        parts += [F.col(name).isNull().alias(f"n{number}"), F.col(name).alias(f"v{number}")]
    return F.struct(*parts)


def previous_rows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    columns: Mapping[str, str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``{new name: column}`` holding each column's value one row earlier.

    Rows of a key are ordered by ``ts``, then ``tie``, NULLs last.
    """
    sources = list(dict.fromkeys(columns.values()))
    sliced, rest = in_slices(df, keys, _nulls_last(ts, tie), rows_per_slice)
    whole = Window.partitionBy(*keys).orderBy(*_nulls_last(ts, tie))
    plain = rest.withColumns({new: F.lag(old).over(whole) for new, old in columns.items()})
    if sliced is None:
        return plain
    tails = sliced.groupBy(*keys, "_slice").agg(F.max_by(F.struct(*sources), _as_struct(ts, tie)).alias("_tail"))
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    heads = (
        tails.withColumn("_before", F.lag("_tail").over(by_slice))
        .filter(F.col("_before").isNotNull())
        .select(
            *keys,
            "_slice",
            F.lit(0).alias("_turn"),
            *[F.col(f"_before.{name}").alias(f"_carried_{name}") for name in sources],
        )
    )
    body = sliced.withColumn("_turn", F.lit(1)).withColumns({f"_carried_{name}": F.col(name) for name in sources})
    in_order = Window.partitionBy(*keys, "_slice").orderBy(
        F.col("_turn"), *_nulls_last(ts, tie)
    )
    carried = (
        body.unionByName(heads, allowMissingColumns=True)
        .withColumns(
            {new: F.lag(f"_carried_{old}").over(in_order) for new, old in columns.items()}
        )
        .filter(F.col("_turn") == 1)
        .drop("_turn", "_slice", *[f"_carried_{name}" for name in sources])
    )
    return carried.unionByName(plain)


def last_known(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    right_ts: str,
    values: Mapping[str, str],
    by: Sequence[str] = (),
    tie: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """As-of join: add the values of the latest ``right`` row at or before ``ts``.

    ``values`` is ``{new name: column of right}``. Among right rows of one instant
    the greatest ``tie`` wins. Rows of ``left`` with no time, or before the first
    right row, get NULLs; every row of ``left`` comes out once.
    """
    keys = list(by) or ["_everything"]
    packed = F.struct(*[F.col(old).alias(new) for new, old in values.items()])
    order_value = F.col(tie) if tie else F.lit(None).cast("string")
    asked = left.filter(F.col(ts).isNotNull()).withColumns({"_at": F.col(ts), "_side": F.lit(1)})
    known = right.filter(F.col(right_ts).isNotNull()).select(
        *by,
        F.col(right_ts).alias("_at"),
        F.lit(0).alias("_side"),
        order_value.alias("_tie"),
        packed.alias("_known"),
    )
    both = asked.unionByName(known, allowMissingColumns=True)
    if not by:
        both = both.withColumn("_everything", F.lit(0))
    # A NULL tie is the least; equal ties are decided by the values. Right rows come before
    # left rows of the same instant.
    order = ["_at", "_side", "_tie", "_known"]
    sliced, rest = in_slices(both, keys, [F.col(name).asc_nulls_first() for name in order], rows_per_slice)
    body = _carried_on(rest, keys, order)
    if sliced is not None:
        state = F.when(F.col("_known").isNotNull(), F.struct(*order))
        tails = sliced.groupBy(*keys, "_slice").agg(F.max_by("_known", state).alias("_tail"))
        earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        heads = (
            tails.withColumn("_known", F.last("_tail", ignorenulls=True).over(earlier))
            .filter(F.col("_known").isNotNull())
            .select(*keys, "_slice", F.lit(-1).alias("_turn"), "_known")
        )
        headed = sliced.withColumn("_turn", F.lit(0)).unionByName(heads, allowMissingColumns=True)
        body = body.unionByName(_carried_on(headed, [*keys, "_slice"], ["_turn", *order]).drop("_turn", "_slice"))
    types = dict(right.dtypes)
    untimed = left.filter(F.col(ts).isNull()).select(
        "*", *[F.lit(None).cast(types[old]).alias(new) for new, old in values.items()]
    )
    return (
        body.filter(F.col("_side") == 1)
        .select(*left.columns, *[F.col(f"_latest.{new}").alias(new) for new in values])
        .unionByName(untimed)
    )


def _carried_on(rows: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``_latest``, the last value of ``_known`` up to each of them."""
    so_far = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_latest", F.last("_known", ignorenulls=True).over(so_far))


# Above this many rows or days the right side is not broadcast.
SMALL_ROWS = 50_000
SMALL_DAYS = 50_000


def last_known_small(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    right_ts: str,
    value: str,
    new: str,
) -> DataFrame | None:
    """``last_known`` for a dimension small enough to broadcast; None if it is not.

    The dimension becomes one row for each day between its first and last: the value
    carried into the day and the changes within it. ``left`` is joined by day and not
    shuffled. Of equal instants the greatest value wins.
    """
    known = right.filter(F.col(right_ts).isNotNull()).select(
        F.to_date(right_ts).alias("_day"), F.struct(right_ts, value).alias("_change")
    )
    size = known.agg(
        F.count("*").alias("n"),
        F.min("_day").alias("first"),
        F.max("_day").alias("last"),
        F.datediff(F.max("_day"), F.min("_day")).alias("days"),
    ).first()
    if size["n"] == 0:
        return left.withColumn(new, F.lit(None).cast(dict(right.dtypes)[value]))
    if size["n"] > SMALL_ROWS or size["days"] > SMALL_DAYS:
        return None
    every_day = left.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(size["first"]), F.lit(size["last"]))).alias("_day")
    )
    by_day = known.groupBy("_day").agg(F.collect_list("_change").alias("_changes"))
    # One row for each day of the dimension, at most SMALL_DAYS.
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = every_day.join(by_day, "_day", "left").select(
        F.col("_day").alias("_lookup_day"),
        "_changes",
        F.last(F.array_max("_changes"), ignorenulls=True).over(earlier).alias("_carried"),
    )
    asked = left.withColumn("_day", F.least(F.to_date(ts), F.lit(size["last"])))
    within = F.array_max(
        F.filter("_changes", lambda change: change[right_ts] <= F.col(ts))
    )
    joined = asked.join(F.broadcast(days), F.col("_day") == F.col("_lookup_day"), "left")
    found = F.coalesce(within, "_carried")[value]
    # least() skips NULL, so a missing time would take the last day.
    return joined.withColumn(new, F.when(F.col(ts).isNotNull(), found)).select(
        *left.columns, new
    )


def changes(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    watched: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rows where a watched column differs from the key's row before, and first rows.

    Adds ``previous_<column>``.
    """
    names = {f"previous_{name}": name for name in watched}
    marked = df.withColumn("_row", F.lit(True))
    seen = previous_rows(marked, keys, ts, tie, {**names, "_earlier": "_row"}, rows_per_slice)
    differs = F.lit(False)
    for new, old in names.items():
        differs = differs | ~F.col(new).eqNullSafe(F.col(old))
    return seen.filter(F.col("_earlier").isNull() | differs).drop("_earlier", "_row")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], *order: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The last row of each key, as an aggregate that combines before the shuffle."""
    kept = [name for name in (columns or df.columns) if name not in keys]
    newest = F.max_by(F.struct(*kept), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def latest_row(df: DataFrame, *order: str) -> DataFrame:
    """The single last row: a top-1, so no sort of the whole and no global window."""
    return df.orderBy(*[F.col(name).desc_nulls_last() for name in order]).limit(1)
