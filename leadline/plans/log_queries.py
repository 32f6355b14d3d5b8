"""Ingest, state and contract operators on logs and documents made from the tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadline.config import SESSION_SETTINGS, delete_folder, shared_folder
from leadline.functions import json_text, to_double, to_long
from leadline.operators.states import snapshot_tables, to_state_rows
from leadline.plans import table_queries
from leadline.plans.contracts import dataset_report
from leadline.plans.ingest import ingest_session
from leadline.plans.silver import state_snapshots
from leadline.plans.tables import events, seconds_text, table
from leadline.sinks.tables import replace_partitions
from leadline.sources.specs import SourceSpec
from leadline.sources.stored import bronze, file_results, read_manifests
from leadline.streaming.buckets import bucket_totals
from leadline.streaming.dedup import once_within
from leadline.streaming.growth import ingest_stream
from leadline.streaming.states import flush_on_change

QUERIES: dict[str, table_queries.Query] = {}
LOGS = (SourceSpec("event_log", "logs/part-*", "at", "event"),)
RELEASE = "release"


def query(build: table_queries.Query) -> table_queries.Query:
    QUERIES[build.__name__] = build
    return build


def _write_logs(spark: SparkSession, folder: str) -> str:
    """All events as JSON lines in a shared folder; error events are cut short."""
    root = shared_folder(spark, "logs")
    line = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"),
            F.col("event_type").alias("event"),
            F.col("user_id").cast("string").alias("lease_id"),
            "value",
            F.struct("k").alias("counters"),
        )
    )
    cut = F.when(F.col("event_type") == "error", F.substring(line, 1, 20)).otherwise(line)
    events(spark, folder).select(cut.alias("value")).write.text(f"{root}/logs")
    return root


def _ingested_twice(spark: SparkSession, folder: str) -> str:
    root, data = _write_logs(spark, folder), shared_folder(spark, "data")
    for _ in range(2):
        ingest_session(
            spark, root, data, full_scan=True, specs=LOGS, version=RELEASE
        )
    return data


def _streamed(spark: SparkSession, folder: str) -> str:
    root, data = _write_logs(spark, folder), shared_folder(spark, "data")
    stream = ingest_stream(
        spark, root, data, shared_folder(spark, "checkpoint"), version=RELEASE, specs=LOGS
    )
    stream.awaitTermination()
    return data


# Log files of the resume query, and the bytes of one leaf of their hash trees.
RESUMED_FILES = 12
RESUMED_RANGE = 8192


def _write_files(lines: DataFrame, root: str) -> None:
    """One log for each value of ``file``, its lines in the order of ``place``.

    A file of an earlier call is replaced. The driver renames RESUMED_FILES files at most.
    """
    spark = lines.sparkSession
    written = shared_folder(spark, "written")
    dealt = lines.repartitionById(RESUMED_FILES, F.col("file").cast("int")).sortWithinPartitions("place")
    dealt.select("value").write.text(written)
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(context._jsc.hadoopConfiguration())
    store.mkdirs(path(f"{root}/logs"))
    for status in store.listStatus(path(written)):
        name = status.getPath().getName()
        if name.startswith("part-"):
            target = path(f"{root}/logs/part-{int(name[5:10]):02d}.log")
            store.delete(target, False)
            store.rename(status.getPath(), target)
    delete_folder(spark, written)


def _resumed(spark: SparkSession, folder: str) -> str:
    """Sessions before and after a third of the logs each was appended to, rewritten, shortened."""
    line = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"),
            F.concat(F.col("change"), "event_type").alias("event"),
            F.col("serial").cast("string").alias("lease_id"),
        )
    )
    placed = events(spark, folder).withColumns(
        {"part": F.col("serial") % 8, "file": F.floor(F.col("serial") / 8) % RESUMED_FILES}
    )
    place = F.struct("part", "serial").alias("place")
    root, data = shared_folder(spark, "logs"), shared_folder(spark, "data")

    def session(rows: DataFrame, change: str, session_id: str) -> None:
        kept = rows.withColumn("change", F.lit(change) if change == "" else F.when(F.col("file") % 3 == 1, change).otherwise(""))
        _write_files(kept.select(line.alias("value"), "file", place), root)
        ingest_session(
            spark, root, data, specs=LOGS, version=RELEASE, session_id=session_id,
            range_bytes=RESUMED_RANGE, verify="growth",
        )

    session(placed.filter("part < 4"), "", "session1")
    session(placed.filter("part < CASE file % 3 WHEN 0 THEN 8 WHEN 1 THEN 4 ELSE 2 END"), "again_", "session2")
    return data


@query
def ingest_resume(spark: SparkSession, folder: str) -> DataFrame:
    """What two sessions read of logs that grew, changed or shrank between them.

    ``hashed_growth_only`` says that no file had more bytes hashed than those from where it
    was read on, and one range before.
    """
    found = file_results(spark, _resumed(spark, folder))
    number = F.regexp_extract("source_file", r"part-(\d+)", 1).cast("int") % 3
    action = F.element_at(F.array(F.lit("appended"), F.lit("rewritten"), F.lit("shortened")), number + 1)
    most = F.col("snapshot_bytes") - F.col("start_byte") + F.when(number == 0, RESUMED_RANGE).otherwise(2 * RESUMED_RANGE)
    return found.groupBy(action.alias("action"), "session_id").agg(
        F.count("*").alias("files"),
        F.count_if(F.col("start_byte") > 0).alias("resumed_files"),
        F.sum("lines_read").alias("lines_read"),
        F.sum("valid_json_rows").alias("valid_json_rows"),
        F.sum("new_rows").alias("new_rows"),
        F.sum("duplicate_rows").alias("duplicate_rows"),
        F.bool_and(F.col("hashed_bytes") <= most).alias("hashed_growth_only"),
    )


@query
def ingest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Stored events after ingesting the same logs twice."""
    document = F.col("raw_json")
    value = to_double(json_text(document, "$.value"))
    return (
        bronze(spark, _ingested_twice(spark, folder))
        .groupBy("event_type", "event_date", "git_sha_provenance")
        .agg(
            F.count("*").alias("stored_rows"),
            F.countDistinct("event_id").alias("distinct_ids"),
            F.sum(to_long(json_text(document, "$.counters.k"))).alias("sum_k"),
            F.round(F.sum(value), 6).alias("sum_value"),
            seconds_text(F.max("event_time")).alias("latest"),
        )
    )


@query
def ingest_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Line counts of both sessions; the second finds only duplicates."""
    _, stats = read_manifests(spark, _ingested_twice(spark, folder))
    return stats.select(
        "source",
        F.when(F.col("new_rows") > 0, "first").otherwise("second").alias("session"),
        "lines_read",
        "valid_json_rows",
        "malformed_rows",
        "new_rows",
        "duplicate_rows",
    )


@query
def quarantined_lines(spark: SparkSession, folder: str) -> DataFrame:
    data = _ingested_twice(spark, folder)
    schema = "event_id string, error_type string, raw_line_base64 string, session_id string"
    lines = spark.read.schema(schema).json(f"{data}/quarantine")
    text = F.rtrim(F.decode(F.unbase64("raw_line_base64"), "utf-8"), F.lit("\r\n"))
    return lines.groupBy("error_type", text.alias("line")).agg(
        F.count("*").alias("times"), F.countDistinct("session_id").alias("sessions")
    )


@query
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Hour buckets of events that a stream stored."""
    stored = bronze(spark, _streamed(spark, folder))
    found = bucket_totals(
        stored, "event_time", "hour", {"stored_rows": F.count("*")}
    )
    return found.select(
        "period_grain", seconds_text("period_start").alias("period_start"), "stored_rows"
    )


def _stream_to_table(rows: DataFrame, purpose: str) -> DataFrame:
    """What a stream appends until its source is read to the end."""
    spark = rows.sparkSession
    found, checkpoint = shared_folder(spark, purpose), shared_folder(spark, f"{purpose}-checkpoint")
    stream = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    stream.start(found).awaitTermination()
    return spark.read.schema(rows.schema).parquet(found)


@query
def stream_flushes(spark: SparkSession, folder: str) -> DataFrame:
    """Sampled states of each user that a stream has let through: up to the last change of state."""
    document = F.to_json(F.struct((F.col("serial") % 2).cast("string").alias("lease_id"), F.col("event_type").alias("phase")))
    samples = events(spark, folder).select(
        F.concat(F.lit("states/"), F.col("user_id")).alias("source_file"), F.col("ts").alias("observed_at"), document.alias("document")
    )
    fed = shared_folder(spark, "samples")
    samples.write.parquet(fed)
    # Timers of an hour would keep asking for empty batches; nothing is flushed by them here.
    provider = "spark.sql.streaming.stateStore.providerClass"
    settings = {provider: SESSION_SETTINGS[provider], "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        stream = spark.readStream.schema(samples.schema).parquet(fed)
        passed = _stream_to_table(flush_on_change(stream, 1e-6), "flushed")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return passed.groupBy("source_file").agg(
        F.count("*").alias("samples"), seconds_text(F.max("observed_at")).alias("latest"), F.countDistinct("document").alias("states")
    )


@query
def stream_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Events that come twice, in two batches of a stream; each counts once."""
    ev = events(spark, folder).select(F.col("event_id").cast("string").alias("event_id"), "ts", "event_type", "value")
    fed = shared_folder(spark, "repeats")
    for part in ("first", "second"):
        ev.coalesce(1).write.parquet(f"{fed}/part={part}")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{fed}/part=*")
    found = _stream_to_table(once_within(stream, "event_id", "ts", "400 days"), "once")
    return found.groupBy("event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 6).alias("sum_value"))


@query
def replaced_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """A table by event type after its clicks changed, its errors went and signups came."""
    ev = events(spark, folder).select("event_type", "event_id", "value", "ts")
    path = f"{shared_folder(spark, 'replaced')}/table"
    kind = F.col("event_type")
    replace_partitions(ev.filter(kind != "signup"), path, ["event_type"])
    changed = F.when(kind == "click", F.col("value") + 1).otherwise(F.col("value"))
    plan = replace_partitions(ev.filter(kind != "error").withColumn("value", changed), path, ["event_type"])
    stored = spark.read.schema(ev.schema).parquet(path).groupBy("event_type").agg(
        F.count("*").alias("rows"), F.round(F.sum("value"), 6).alias("sum_value")
    )
    return plan.join(stored, "event_type", "left").select("event_type", "action", F.coalesce("rows", F.lit(0)).alias("rows"), "sum_value")


@query
def week_buckets(spark: SparkSession, folder: str) -> DataFrame:
    found = bucket_totals(
        events(spark, folder), "ts", "week", {"events": F.count("*"), "sum_k": F.sum("k")}
    )
    return found.select(
        seconds_text("period_start").alias("period_start"),
        seconds_text("period_end").alias("period_end"),
        "events",
        "sum_k",
    )


@query
def state_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One state document from each event, stored and typed again."""
    document = F.to_json(
        F.struct(
            F.col("event_type").alias("phase"),
            F.col("user_id").alias("lease_id"),
            F.struct((F.col("k") % 5).alias("maximum_fights")).alias("config"),
            F.struct(F.col("k").alias("exp_earned"), F.col("serial").alias("gil_earned")).alias(
                "counters"
            ),
            F.col("k").alias("elapsed_seconds"),
        )
    )
    documents = events(spark, folder).select(document.alias("document"), "ts")
    stored = to_state_rows(documents, F.col("ts"), None)
    return state_snapshots(stored).select(
        seconds_text("observed_at").alias("observed_at"),
        "lease_id",
        "phase",
        "elapsed_seconds",
        "exp_earned",
        "gil_earned",
        "configuration_hash",
        "git_sha_provenance",
    )


def _snapshot(tables: dict[str, DataFrame]) -> DataFrame:
    keys = {
        "customer": ("c_custkey",),
        "supplier": ("s_suppkey",),
        "nation": ("n_nationkey",),
        "orders": ("o_orderkey",),
    }
    found = snapshot_tables(
        tables,
        F.lit("2024-01-25 00:00:00").cast("timestamp"),
        "20240125T000000",
        keys=keys,
    )
    return found.select("source", "source_file", "event_type", "raw_json")


@query
def snapshot_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of four tables as canonical JSON, in the columns that its SQL names."""
    return _snapshot(
        {
            "customer": table(spark, folder, "customer").select("c_custkey", "c_mktsegment"),
            "supplier": table(spark, folder, "supplier").select("s_name", "s_suppkey"),
            "nation": table(spark, folder, "nation"),
            "orders": table(spark, folder, "orders").select("o_orderkey", "o_orderdate"),
        }
    )


@query
def snapshot_whole_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of four tables as canonical JSON, with all columns."""
    names = ("customer", "supplier", "nation", "orders")
    return _snapshot({name: table(spark, folder, name) for name in names})


@query
def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    """Presence, fields and row counts of derived datasets, one of them failing."""
    datasets = {
        "events_daily": table_queries.QUERIES["events_daily"](spark, folder),
        "sessions": table_queries.QUERIES["sessions_by_user"](spark, folder),
        "current": table_queries.QUERIES["velocity_current"](spark, folder),
    }
    found = dataset_report(
        datasets,
        required={
            "events_daily": ["event_date", "clicks", "rejection_rate"],
            "sessions": ["user_id", "event_count", "agent"],
            "current": ["ts"],
        },
        minimum={"current": 2},
    )
    return found.select("dataset", "missing_fields", "row_count", "passed")
