"""Aggregate expressions with the NULL and division rules the tables rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600.0


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def _ordering(value: Column, order: tuple[Column, ...]) -> Column:
    # Rows without a value or without a time take no part.
    return F.when(value.isNotNull() & order[0].isNotNull(), F.struct(*order))


def first_by(value: Column, *order: Column) -> Column:
    return F.min_by(value, _ordering(value, order))


def last_by(value: Column, *order: Column) -> Column:
    return F.max_by(value, _ordering(value, order))


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def per_hour(amount: Column, seconds: Column) -> Column:
    """Amount for each hour of ``seconds``; NULL when there were none.

    Multiplying before dividing, in double, keeps the digits that decimal
    arithmetic on ``3600.0`` would lose.
    """
    return amount.cast("double") * F.lit(SECONDS_PER_HOUR) / F.nullif(
        seconds.cast("double"), F.lit(0.0)
    )


def observed_or_unavailable(rows: Column, label: str = "state_observer_counter") -> Column:
    return F.when(rows > 0, F.lit(label)).otherwise(F.lit("unavailable"))


def any_label(column: Column, label: str = "state_observer_counter") -> Column:
    """The label if any row of the group carries it."""
    return observed_or_unavailable(F.count_if(column == label), label)
