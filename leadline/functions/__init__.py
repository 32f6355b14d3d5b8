"""Column helpers: typing, time, identity and statistics."""

from leadline.functions.identity import (
    canonical_json,
    event_digest,
    short_id,
    text_digest,
)
from leadline.functions.stats import (
    any_label,
    count_where,
    first_by,
    last_by,
    observed_or_unavailable,
    per_hour,
    ratio,
)
from leadline.functions.timing import (
    age_seconds,
    iso_text,
    parse_iso,
    parse_with_short_offset,
    seconds_between,
)
from leadline.functions.typing import (
    count_or_zero,
    json_text,
    to_boolean,
    to_double,
    to_int,
    to_long,
    type_json,
    typed_json,
)

__all__ = [
    "age_seconds",
    "any_label",
    "canonical_json",
    "count_or_zero",
    "count_where",
    "event_digest",
    "first_by",
    "iso_text",
    "json_text",
    "last_by",
    "observed_or_unavailable",
    "parse_iso",
    "parse_with_short_offset",
    "per_hour",
    "ratio",
    "seconds_between",
    "short_id",
    "text_digest",
    "to_boolean",
    "to_double",
    "to_int",
    "to_long",
    "type_json",
    "typed_json",
]
