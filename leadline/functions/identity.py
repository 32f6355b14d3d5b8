"""Content identities as native expressions; canonical JSON in Arrow batches."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_NUL = b"\x00"
SHORT_ID_LENGTH = 8


def _utf8(text: Column) -> Column:
    return F.encode(text, "utf-8")


def event_digest(path: Column, position: Column, content: Column) -> Column:
    """sha256 over path, position and bytes, NUL between them."""
    return F.sha2(
        F.concat(
            _utf8(path), F.lit(_NUL), _utf8(position.cast("string")), F.lit(_NUL), content
        ),
        256,
    )


def text_digest(text: Column) -> Column:
    return F.sha2(_utf8(text), 256)


def short_id(identifier: Column) -> Column:
    return F.substring(identifier, 1, SHORT_ID_LENGTH)


def canonical_json(columns: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys and explicit nulls, as ``json.dumps`` writes it.

    Spark's own writer has other texts for doubles outside 0.001 to 10,000,000 and leaves
    letters beyond ASCII as they are.
    """

    def write(rows: pa.Array) -> pa.Array:
        texts = [
            json.dumps(row, sort_keys=True, separators=(",", ":"), default=lambda value: value.isoformat())
            for row in rows.to_pylist()
        ]
        return pa.array(texts, pa.string())

    fields = [columns[name].alias(name) for name in sorted(columns)]
    return F.arrow_udf(write, "string")(F.struct(*fields))
