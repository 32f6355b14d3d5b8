"""Is a raw line one JSON object? Which error otherwise?

The rule is that of a strict UTF-8 decode followed by Python's JSON reader
(NaN and repeated keys pass, trailing text does not). No built-in function
decides the same way, so this is the one scalar function that runs in Python,
on Arrow batches.
"""

from __future__ import annotations

import json
from typing import Optional

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def error_name(raw: Optional[bytes]) -> Optional[str]:
    if raw is None:
        return "ValueError"
    try:
        if not isinstance(json.loads(raw.decode("utf-8").rstrip("\r\n")), dict):
            return "ValueError"
    except ValueError as problem:
        return type(problem).__name__
    except RecursionError:
        return "RecursionError"
    return None


def error_names(raws: pa.Array) -> pa.Array:
    return pa.array([error_name(raw) for raw in raws.to_pylist()], pa.string())


def json_object_error(raw: Column) -> Column:
    """NULL for a JSON object, else the name of the error."""

    def verdict(batch: pa.Array) -> pa.Array:
        return error_names(batch)

    return F.arrow_udf(verdict, "string")(raw)
