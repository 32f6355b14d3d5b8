"""Late typing of JSON payloads: a bad field is NULL, never an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LONG_LIMIT = 9.2e18


def json_text(document: Column, path: str) -> Column:
    return F.get_json_object(document, path)


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def _whole(text: Column, kind: str) -> Column:
    # '1.5' and '1e3' are numbers too: they round, halves away from zero.
    number = F.round(text.try_cast("double"))
    rounded = F.when(F.abs(number) < _LONG_LIMIT, number.try_cast(kind))
    return F.coalesce(text.try_cast(kind), rounded)


def to_long(text: Column) -> Column:
    return _whole(text, "bigint")


def to_int(text: Column) -> Column:
    return _whole(text, "int")


def to_boolean(text: Column) -> Column:
    return text.try_cast("boolean")


def count_or_zero(value: Column) -> Column:
    """A count that reads as 0 where it is missing, unreadable or negative."""
    return F.greatest(F.lit(0).cast("bigint"), F.coalesce(value.try_cast("bigint"), F.lit(0)))


_READERS = {
    "string": lambda text: text,
    "double": to_double,
    "bigint": to_long,
    "int": to_int,
    "boolean": to_boolean,
}


def typed_json(
    document: Column, fields: Mapping[str, tuple[str, str]]
) -> list[Column]:
    """One typed column for each ``{name: (json path, type)}``; parses for each field."""
    return [
        _READERS[kind](json_text(document, path)).alias(name)
        for name, (path, kind) in fields.items()
    ]


def type_json(
    df: DataFrame,
    document: str,
    fields: Mapping[str, tuple[str, str]],
    keep: Sequence[str | Column],
    after: Sequence[str | Column] = (),
) -> DataFrame:
    """``keep``, the typed fields and ``after``.

    Every field is read from the text of the document, however many there are: a parsed
    form would rewrite numbers (1.0 as 1, long ones in exponent form).
    """
    return df.select(*keep, *typed_json(F.col(document), fields), *after)
