"""Instants from text, differences between instants, and text from instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text shapes of instants.
_STARTS_WITH_DATE = r"^\d{4}-\d{2}-\d{2}"
_DATE_ONLY = r"^\d{4}-\d{2}-\d{2}$"
_HAS_OFFSET = r"[T ].*([zZ]|[+-]\d{2}(:?\d{2}){0,2})$"
_SHORT_OFFSET = r"([+-]\d{2})$"
_ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"
_ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def parse_iso(text: Column) -> Column:
    """ISO text to an instant; without an offset it is UTC; anything else is NULL."""
    with_time = F.when(text.rlike(_DATE_ONLY), F.concat(text, F.lit("T00:00:00"))).otherwise(text)
    zoned = F.when(with_time.rlike(_HAS_OFFSET), with_time).otherwise(
        F.concat(with_time, F.lit("+00:00"))
    )
    return F.when(text.rlike(_STARTS_WITH_DATE), zoned.try_cast("timestamp"))


def parse_with_short_offset(text: Column) -> Column:
    """As ``parse_iso`` for texts that may end in an hour-only offset such as ``-04``."""
    return parse_iso(F.regexp_replace(text, _SHORT_OFFSET, "$1:00"))


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed, not elapsed whole seconds."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def age_seconds(as_of: Column, moment: Column) -> Column:
    micros = F.unix_micros(as_of) - F.unix_micros(moment)
    return F.greatest(F.lit(0.0), micros / F.lit(1e6))


def iso_text(moment: Column) -> Column:
    """ISO text with offset; a fraction only where there is one."""
    fraction = F.pmod(F.unix_micros(moment), F.lit(1_000_000))
    return F.when(fraction == 0, F.date_format(moment, _ISO_SECONDS)).otherwise(
        F.date_format(moment, _ISO_MICROS)
    )
