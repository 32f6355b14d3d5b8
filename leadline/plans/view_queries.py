"""Typed event families, attribution, payload and document checks on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadline.operators.ingest import attribute_asof, clean_commits, dedup_new
from leadline.plans import silver, table_queries
from leadline.plans.contracts import payload_report
from leadline.plans.tables import events, seconds_text, table
from leadline.schemas import BRONZE
from leadline.sources.documents import accepted_observations, observation_faults

QUERIES: dict[str, table_queries.Query] = {}


def query(build: table_queries.Query) -> table_queries.Query:
    QUERIES[build.__name__] = build
    return build


def _stored(spark: SparkSession, folder: str, source: str, event_type: Column, document: Column) -> DataFrame:
    """Events in the stored layout, with this payload."""
    given = {
        "event_id": F.col("event_id").cast("string"),
        "event_time": F.col("ts"),
        "ingested_at": F.col("ts"),
        "source": F.lit(source),
        "source_file": F.concat(F.lit("logs/"), F.col("event_type")),
        "source_line_number": F.col("serial"),
        "event_type": event_type,
        "schema_version": F.lit(1),
        "agent_id": F.col("owner"),
        "lease_id": F.col("user_id").cast("string"),
        "source_git_sha": F.col("version"),
        "git_sha_provenance": F.col("provenance"),
        "raw_json": F.to_json(document),
    }
    ev = events(spark, folder).withColumn("_k3", F.col("k") % 3)
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in BRONZE.fields]
    return ev.select(*columns)


def _shown(found: DataFrame, *drop: str) -> DataFrame:
    times = [f.name for f in found.schema.fields if f.dataType.typeName() in ("timestamp", "date")]
    shown = found.drop("raw_json", "ingested_at", *drop)
    return shown.withColumns({name: seconds_text(name) for name in times if name in shown.columns})


@query
def typed_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Action events with outcome, duration and error; some durations are no numbers."""
    k = F.col("k")
    document = F.struct(
        "outcome",
        F.when(k % 9 != 0, k.cast("string")).otherwise("slow").alias("duration_ms"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("E"), k.cast("string"))).alias("error_code"),
    )
    return _shown(silver.agent_actions(_stored(spark, folder, "agent_actions", F.col("operation"), document)))


def _supervisor(spark: SparkSession, folder: str) -> DataFrame:
    k, kind = F.col("k"), F.col("event_type")
    document = F.struct(
        F.concat(F.lit("mode"), F.col("_k3").cast("string")).alias("mode"),
        kind.alias("name"),
        F.when(F.col("_k3") == 0, k.cast("string")).otherwise(F.concat(k.cast("string"), F.lit(".5"))).alias("fight"),
        k.alias("zone_id"),
        F.concat(k.cast("string"), F.lit("x")).alias("to_zone_id"),
        (k % 75).alias("level"),
        (k % 101).alias("player_hp_percent"),
        F.when(F.col("_k3") == 1, "true").when(F.col("_k3") == 2, "no").alias("handoff"),
    )
    event_type = F.when(kind == "purchase", "fight_complete").otherwise(kind)
    return silver.supervisor_events(_stored(spark, folder, "farm_supervisor", event_type, document))


@query
def typed_supervisor_events(spark: SparkSession, folder: str) -> DataFrame:
    """Supervisor events; numbers as text, with halves, with letters; flags that are none."""
    unused = ("phase", "reason", "status", "from_zone_id", "target_level", "aggro_response_ms", "handoff_queue_ms")
    return _shown(_supervisor(spark, folder), *unused)


@query
def typed_fights(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(silver.fights(_supervisor(spark, folder)))


@query
def typed_navigation(spark: SparkSession, folder: str) -> DataFrame:
    """Probes with distances; every ninth is at the wrong place of the document."""
    k = F.col("k")
    document = F.struct(
        F.col("outcome"),
        (k + 1).alias("requested_distance"),
        F.when(k % 9 != 0, k).alias("displacement"),
        F.struct(k.alias("remaining")).alias("nested"),
        F.concat(F.lit(" "), (k % 101).cast("string")).alias("hp_percent"),
        F.concat(F.lit("mesh"), F.col("_k3").cast("string")).alias("mesh"),
    )
    return _shown(silver.navigation_attempts(_stored(spark, folder, "navigation", F.lit("navigation_probe"), document)))


@query
def attributed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Stored events with the commit before them; purchases stand for commits.

    Commits with a short identifier or an unreadable time do not count.
    """
    ev = events(spark, folder)
    sha = F.sha1(F.col("event_id").cast("string"))
    commits = ev.filter(F.col("event_type") == "purchase").select(
        F.when(F.col("serial") % 5 == 0, F.substring(sha, 1, 39)).otherwise(sha).alias("sha"),
        F.when(F.col("serial") % 7 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("committed_at"),
    )
    stored = _stored(spark, folder, "agent_actions", F.col("event_type"), F.struct("k")).drop("source_git_sha", "git_sha_provenance")
    found = attribute_asof(stored, clean_commits(commits))
    return found.select("event_id", "source_git_sha", "git_sha_provenance")


@query
def payload_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Forbidden keys planted in payloads: deep, in capitals, escaped, beside repeated keys.

    The same names as values, and inside of strings, are no keys.
    """
    serial = F.col("serial") % 10
    planted = (
        F.when(serial == 0, '{"a":[{"b":{"AGENT_ID":1}}]}')
        .when(serial == 1, '{"note":"agent_id","list":["lease_id"]}')
        .when(serial == 2, F.lit('{"text":"say \\"raw_json\\": 1"}'))
        .when(serial == 3, F.lit('{"deep":{"deeper":[[{"lease\\u005fid" : null}]]}}'))
        .when(serial == 4, '{"x":1,"x":2,"Raw_Payload":{}}')
        .when(serial == 5, '{"stream_key":"s","inner":{"stream_key":"t","bridge_token":[]}}')
        .otherwise(F.col("props"))
    )
    return payload_report(events(spark, folder).select(planted.alias("document")), "document")


def _observations(spark: SparkSession, folder: str) -> DataFrame:
    """A document for each customer, eight of ten with a fault each."""
    key, kind = F.col("c_custkey"), F.col("c_custkey") % 10
    status = F.when(kind == 1, "asleep").otherwise("primed")

    def row(number: int, *more: Column) -> Column:
        name = F.when(kind == (3 if number == 2 else -1), F.concat(F.lit("nm"), F.lit("1"))).when(
            (kind == 4) & F.lit(number == 1), ""
        ).otherwise(F.lit(f"nm{number}"))
        return F.to_json(F.struct(name.alias("nm_key"), status.alias("status"), key.alias("cooldown_remaining_seconds"), *more))

    rows = F.when(kind == 5, F.lit('[7]')).otherwise(
        F.concat(F.lit("["), row(1), F.lit(","), F.when(kind == 2, row(2, F.lit(1).alias("secret"))).otherwise(row(2)), F.lit("]"))
    )
    moment = F.when(kind == 6, "yesterday").otherwise("2026-07-31 09:49:07-04")
    root = F.concat(
        F.lit('{"observed_at":"'), moment, F.lit('"'),
        F.when(kind == 7, ',"extra":1').otherwise(""),
        F.when(kind == 8, "").otherwise(F.concat(F.lit(',"nms":'), rows)),
        F.lit("}"),
    )
    return table(spark, folder, "customer").select(key.alias("document_id"), F.when(kind == 9, "[]").otherwise(root).alias("text"))


@query
def refused_observations(spark: SparkSession, folder: str) -> DataFrame:
    return observation_faults(_observations(spark, folder), "document_id", "text")


@query
def observation_rows(spark: SparkSession, folder: str) -> DataFrame:
    found = accepted_observations(_observations(spark, folder), "document_id", "text")
    return found.select("document_id", "nm_key", "status", "cooldown_remaining_seconds")


@query
def new_content_once(spark: SparkSession, folder: str) -> DataFrame:
    """Contents of documents that no document of a given source has, each one once."""
    documents = table(spark, folder, "documents").select(F.sha2(F.col("text"), 256).alias("event_id"), "source")
    stored = documents.filter(F.substring("source", -1, 1) == "0").select("event_id").distinct()
    fresh = dedup_new(documents.filter(F.substring("source", -1, 1) != "0").select("event_id"), stored)
    return fresh
