"""Small JSON documents: sampled state, catalogue, direct observation, commits."""

from __future__ import annotations

from typing import Optional

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadline.functions import parse_with_short_offset
from leadline.functions.verdict import json_object_error
from leadline.schemas import OBSERVATION_ROOT, OBSERVATION_ROW

# Limits and accepted names of the documents.
MAX_STATE_BYTES = 1024 * 1024
CATALOG_SIZE = 20
STATUSES = ("spawned", "primed", "cooldown_blocked", "lottery_open", "unknown")
OBSERVATION_ROOT_FIELDS = (
    "schema_version",
    "observed_at",
    "map_started_at",
    "ruleset_git_sha",
    "nms",
)

CATALOG_ROW = T.StructType(
    [
        *[
            T.StructField(name, T.StringType())
            for name in (
                "nm_key",
                "display_name",
                "zone",
                "placeholder",
                "rule_kind",
                "image_url",
                "profile_url",
                "rule_source_url",
            )
        ],
        *[
            T.StructField(name, T.IntegerType())
            for name in (
                "script_default_chance_percent",
                "script_default_cooldown_seconds",
                "image_width",
                "image_height",
            )
        ],
    ]
)


def valid_state_documents(files: DataFrame) -> DataFrame:
    """Documents (path, content, length) that hold one JSON object of accepted size."""
    sized = files.filter((F.col("length") > 0) & (F.col("length") <= MAX_STATE_BYTES))
    checked = sized.withColumn("_error", json_object_error(F.col("content")))
    return checked.filter("_error IS NULL").select(
        "path",
        F.col("modificationTime").alias("modified_at"),
        F.decode("content", "utf-8").alias("document"),
    )


def read_state_documents(spark: SparkSession, path: str) -> Optional[DataFrame]:
    """State documents below a path or glob; None if there is no such file."""
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return valid_state_documents(files)


def read_catalog(
    spark: SparkSession, path: str, expected: int = CATALOG_SIZE
) -> DataFrame:
    """The reference list; it must have exactly ``expected`` distinct keys."""
    schema = T.StructType([T.StructField("nms", T.ArrayType(CATALOG_ROW))])
    document = spark.read.schema(schema).option("multiLine", True).json(path)
    rows = document.select(F.inline("nms"))
    counts = rows.agg(F.count("*"), F.countDistinct("nm_key"), F.count("nm_key")).first()
    if tuple(counts) != (expected, expected, expected):
        raise ValueError(f"the catalogue must hold exactly {expected} uniquely keyed rows")
    return rows


def _reject(message: str, names: list[str]) -> None:
    if names:
        raise ValueError(f"{message}: {', '.join(sorted(names))}")


def read_observation(
    spark: SparkSession, path: str
) -> tuple[DataFrame, DataFrame]:
    """One direct observation: its root fields, and its rows.

    Raises ``ValueError`` for unknown fields, unknown statuses, missing or repeated
    keys, and an unreadable time. The document is one file of a bounded list, so its
    keys may be looked at on the driver.
    """
    text = spark.read.text(path, wholetext=True)
    document = text.select(F.try_parse_json("value").alias("_d"), "value")
    root_keys = document.select(
        F.json_object_keys("value").alias("root"),
        F.try_variant_get("_d", "$.nms", "array<variant>").alias("rows"),
    ).first()
    if root_keys is None or root_keys["root"] is None:
        raise ValueError("the observation root must be one object")
    allowed = set(OBSERVATION_ROOT_FIELDS)
    _reject("observation has unexpected fields", list(set(root_keys["root"]) - allowed))
    if root_keys["rows"] is None:
        raise ValueError("the observation must hold a list of rows")
    elements = document.select(
        F.explode(F.try_variant_get("_d", "$.nms", "array<variant>")).alias("_row")
    ).select(F.to_json("_row").alias("_json"))
    typed = elements.select(
        F.json_object_keys("_json").alias("_keys"),
        F.from_json("_json", OBSERVATION_ROW).alias("_o"),
    ).select("_keys", "_o.*")
    row_fields = F.array(*[F.lit(name) for name in OBSERVATION_ROW.names])
    extra = typed.select(F.explode(F.array_except("_keys", row_fields)).alias("f")).distinct()
    _reject(
        "observation row has unexpected fields", [row["f"] for row in extra.collect()]
    )
    if not typed.filter(F.col("_keys").isNull()).isEmpty():
        raise ValueError("observation rows must be objects")
    bad = typed.filter(F.col("status").isNull() | ~F.col("status").isin(*STATUSES))
    _reject("invalid status", [str(row["status"]) for row in bad.collect()])
    if not typed.filter(F.coalesce("nm_key", F.lit("")) == "").isEmpty():
        raise ValueError("an observation row has no key")
    repeated = typed.groupBy("nm_key").count().filter("count > 1")
    _reject("duplicate observation row", [r["nm_key"] for r in repeated.collect()])
    root = document.select(F.from_json("value", OBSERVATION_ROOT).alias("_r")).select("_r.*")
    moment = parse_with_short_offset(F.col("observed_at"))
    if root.filter(moment.isNotNull()).isEmpty():
        raise ValueError("the observation has no readable observed_at time")
    return root, typed.drop("_keys")


# Why an observation is refused.
ROOT, ROOT_FIELD, NO_ROWS, NO_TIME = "root_not_object", "unexpected_root_field", "rows_missing", "unreadable_time"
ROW, ROW_FIELD, STATUS, NO_KEY, KEY_AGAIN = (
    "row_not_object", "unexpected_row_field", "invalid_status", "key_missing", "key_repeated"
)


def observation_faults(documents: DataFrame, ident: str, text: str) -> DataFrame:
    """Every reason to refuse each of many observation documents, as rows (ident, fault, detail).

    A document without a row here is accepted. Field sets are compared as arrays and rows
    travel as VARIANT, so nothing is looked at on the driver; keys that repeat in one document
    are counted by (document, key).
    """
    parsed = documents.select(F.col(ident), F.col(text).alias("_text"), F.try_parse_json(text).alias("_d")).withColumns(
        {
            "_keys": F.when(F.col("_d").isNotNull(), F.json_object_keys("_text")),
            "_rows": F.try_variant_get("_d", "$.nms", "array<variant>"),
            "_moment": parse_with_short_offset(F.try_variant_get("_d", "$.observed_at", "string")),
        }
    )
    is_object = F.col("_keys").isNotNull()
    root_fields = F.array(*[F.lit(name) for name in OBSERVATION_ROOT_FIELDS])

    def fault(condition: Column, name: str, detail: Column | None = None) -> Column:
        said = F.lit(None).cast("string") if detail is None else detail
        return F.when(condition, F.struct(F.lit(name).alias("fault"), said.alias("detail")))

    of_root = F.array(
        fault(~is_object, ROOT),
        fault(is_object & F.col("_rows").isNull(), NO_ROWS),
        fault(is_object & F.col("_moment").isNull(), NO_TIME),
    )
    extra = F.transform(F.array_except("_keys", root_fields), lambda name: fault(F.lit(True), ROOT_FIELD, name))
    root_faults = parsed.select(ident, F.explode(F.filter(F.concat(of_root, F.coalesce(extra, F.array())), lambda f: f.isNotNull())).alias("_f"))

    rows = parsed.filter(is_object).select(ident, F.explode("_rows").alias("_row")).select(ident, F.to_json("_row").alias("_json"))
    typed = rows.select(ident, F.json_object_keys("_json").alias("_keys"), F.from_json("_json", OBSERVATION_ROW).alias("_o"))
    row_object = F.col("_keys").isNotNull()
    key, status = F.coalesce("_o.nm_key", F.lit("")), F.col("_o.status")
    row_fields = F.array(*[F.lit(name) for name in OBSERVATION_ROW.names])
    of_row = F.array(
        fault(~row_object, ROW),
        fault(row_object & (key == ""), NO_KEY),
        fault(row_object & (status.isNull() | ~status.isin(*STATUSES)), STATUS, status),
    )
    extra = F.transform(F.array_except("_keys", row_fields), lambda name: fault(F.lit(True), ROW_FIELD, name))
    row_faults = typed.select(ident, F.explode(F.filter(F.concat(of_row, F.coalesce(extra, F.array())), lambda f: f.isNotNull())).alias("_f"))
    repeated = typed.filter(row_object & (key != "")).groupBy(ident, key.alias("detail")).count().filter("count > 1")
    return (
        root_faults.unionByName(row_faults)
        .select(ident, "_f.fault", "_f.detail")
        .unionByName(repeated.select(ident, F.lit(KEY_AGAIN).alias("fault"), "detail"))
        .distinct()
    )


def accepted_observations(documents: DataFrame, ident: str, text: str) -> DataFrame:
    """The typed rows of all observation documents that have no fault."""
    refused = observation_faults(documents, ident, text).select(ident).distinct()
    kept = documents.select(ident, text).join(refused, ident, "left_anti")
    element = F.explode(F.try_variant_get(F.try_parse_json(text), "$.nms", "array<variant>"))
    return kept.select(ident, element.alias("_row")).select(
        ident, F.from_json(F.to_json("_row"), OBSERVATION_ROW).alias("_o")
    ).select(ident, "_o.*")


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """Commits from text lines of identifier, tab, ISO time."""
    parts = F.split("value", "\t", 2)
    return (
        spark.read.text(path)
        .filter(F.size(parts) == 2)
        .select(parts[0].alias("sha"), parts[1].alias("committed_at"))
    )
