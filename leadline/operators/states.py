"""Sampled state documents and table rows as stored events."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import Optional

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadline.functions import canonical_json, event_digest, json_text, text_digest
from leadline.functions.verdict import error_name
from leadline.operators.ingest import OBSERVED, SCHEMA_VERSION, UNAVAILABLE
from leadline.schemas import BRONZE
from leadline.sources.relational import TABLE_KEYS, check_allowed

# Names under which states and table rows are stored.
STATE_FILE = "runtime/farm-supervisor/primary.json"
STATE_SOURCE = "state_snapshot"
TABLE_EVENT = "database_snapshot"


# Documents that are Python objects at the same time.
_ROWS_AT_ONCE = 1000
_CANONICAL = "struct<plain:string,config:string,raw:string>"


def _sorted_text(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def canonical_state(text: Column, observed_at: Column, version: Optional[str]) -> Column:
    """Sorted compact texts of a document, of its configuration, and of the stored row.

    NULL for what is not one JSON object. State documents are few and small, so the JSON
    reader of the strict rule is used: it accepts NaN, takes the last of repeated keys and
    leaves numbers as they are written.
    """

    def read(texts: pa.Array, times: pa.Array) -> pa.Array:
        names = ("plain", "config", "raw")
        found: dict[str, list[Optional[str]]] = {name: [] for name in names}
        for at in range(0, len(texts), _ROWS_AT_ONCE):
            pieces = (part.slice(at, _ROWS_AT_ONCE).to_pylist() for part in (texts, times))
            for document, moment in zip(*pieces):
                for name, value in zip(names, written(document, moment)):
                    found[name].append(value)
        columns = [pa.array(found[name], pa.string()) for name in names]
        absent = columns[0].is_null()
        return pa.StructArray.from_arrays(columns, names, mask=absent)

    def written(document: Optional[str], moment: Optional[datetime]) -> tuple[Optional[str], ...]:
        if document is None or moment is None or error_name(document.encode("utf-8", "surrogatepass")):
            return None, None, None
        payload = json.loads(document)
        config = _sorted_text(payload.get("config"))
        utc = moment.astimezone(timezone.utc) if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
        added = {
            "observation_time": utc.isoformat(),
            "configuration_hash": hashlib.sha256(config.encode()).hexdigest(),
            "observed_source_git_sha": version,
        }
        return _sorted_text(payload), config, _sorted_text({**payload, **added})

    # Else a filter on the result is pushed below it and evaluates it again, in a second
    # Python worker beside the first of each task.
    return F.arrow_udf(read, _CANONICAL).asNondeterministic()(text, observed_at)


def _provenance(sha: Column) -> Column:
    return F.when(sha.isNotNull(), F.lit(OBSERVED)).otherwise(F.lit(UNAVAILABLE))


def to_state_rows(
    documents: DataFrame,
    observed_at: Column,
    version: Optional[str],
    document: str = "document",
    source_file: str | Column = STATE_FILE,
) -> DataFrame:
    """State documents as stored events; what is not one JSON object is left out.

    The stored text adds the observation time, a hash of the configuration and the
    version to the document. The time in microseconds takes the place of the line
    number in the identity, beside the file that the document is from.
    """
    sha = F.lit(version).cast("string")
    file = F.lit(source_file) if isinstance(source_file, str) else source_file
    base = documents.select(
        F.col(document).alias("_text"), observed_at.alias("_at"), file.alias("_file")
    )
    number = F.unix_micros("_at")
    return (
        base.withColumn("_state", canonical_state(F.col("_text"), F.col("_at"), version))
        .filter(F.col("_state").isNotNull())
        .withColumn("raw_json", F.col("_state.raw"))
        .select(
            event_digest(F.col("_file"), number, F.encode("raw_json", "utf-8")).alias("event_id"),
            F.col("_at").alias("event_time"),
            F.col("_at").alias("ingested_at"),
            F.lit(STATE_SOURCE).alias("source"),
            F.col("_file").alias("source_file"),
            number.alias("source_line_number"),
            F.lit(STATE_SOURCE).alias("event_type"),
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            json_text(F.col("_text"), "$.agent_id").alias("agent_id"),
            json_text(F.col("_text"), "$.lease_id").alias("lease_id"),
            sha.alias("source_git_sha"),
            _provenance(sha).alias("git_sha_provenance"),
            text_digest(F.col("_state.plain")).alias("source_fingerprint_sha256"),
            F.concat(F.lit("observer-"), F.date_format("_at", "yyyyMMdd")).alias(
                "collector_session_id"
            ),
            "raw_json",
        )
        .select(*BRONZE.names)
    )


def _plain(field: T.StructField) -> Column:
    """JSON-safe value: times as ISO text, decimals as text, bytes as hex, short floats."""
    column, kind = F.col(field.name), field.dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.when(micros.endswith(".000000"), whole).otherwise(micros)
    if isinstance(kind, (T.DateType, T.DecimalType)):
        return column.cast("string")
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(column))
    if isinstance(kind, T.FloatType):
        return column.cast("string").cast("double")
    return column


def to_snapshot_rows(
    table: DataFrame,
    name: str,
    keys: Sequence[str],
    snapshot_at: Column,
    snapshot_id: str,
    version: Optional[str] = None,
    prefix: str = "table",
) -> DataFrame:
    """Rows of one table as stored events.

    Identity covers snapshot, table, key and row. The position within the table is a
    hash of the key rather than a running number, which would need all rows in one
    order.
    """
    values = {field.name: _plain(field) for field in table.schema.fields}
    key_values = {key: values[key] for key in keys}
    row, key = canonical_json(values), canonical_json(key_values)
    sha = F.lit(version).cast("string")
    source_file = f"{prefix}/{name}"
    position = F.shiftrightunsigned(F.xxhash64(key), 1)
    identity = F.concat_ws(
        "",
        F.lit('{"primary_key":'),
        key,
        F.lit(',"row":'),
        row,
        F.lit(f',"snapshot_id":"{snapshot_id}","table":"{name}"}}'),
    )
    columns = ",".join(sorted(table.columns))
    return table.select(
        event_digest(F.lit(source_file), position, F.encode(identity, "utf-8")).alias(
            "event_id"
        ),
        snapshot_at.alias("event_time"),
        snapshot_at.alias("ingested_at"),
        F.lit(f"{prefix}_{name}").alias("source"),
        F.lit(source_file).alias("source_file"),
        position.alias("source_line_number"),
        F.lit(TABLE_EVENT).alias("event_type"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(None).cast("string").alias("agent_id"),
        F.lit(None).cast("string").alias("lease_id"),
        sha.alias("source_git_sha"),
        _provenance(sha).alias("git_sha_provenance"),
        text_digest(F.lit(columns)).alias("source_fingerprint_sha256"),
        F.lit(f"{prefix}-{snapshot_id}").alias("collector_session_id"),
        row.alias("raw_json"),
    ).select(*BRONZE.names)


def snapshot_tables(
    tables: Mapping[str, DataFrame],
    snapshot_at: Column,
    snapshot_id: str,
    version: Optional[str] = None,
    keys: Mapping[str, Sequence[str]] = TABLE_KEYS,
    prefix: str = "table",
) -> DataFrame:
    """All rows of several allow-listed tables as stored events."""
    check_allowed(list(tables), keys)
    return reduce(
        DataFrame.unionByName,
        [
            to_snapshot_rows(df, name, keys[name], snapshot_at, snapshot_id, version, prefix)
            for name, df in tables.items()
        ],
    )
