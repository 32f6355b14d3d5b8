"""Every operator on the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadline.functions import (
    event_digest,
    text_digest,
    to_boolean,
    type_json,
)
from leadline.operators import checks, consumer, ordered, rollups, status, velocity
from leadline.operators.attempts import attempt_performance
from leadline.operators.ingest import dedup_new
from leadline.operators.keys import join_null_safe
from leadline.operators.profile import quality_profile
from leadline.operators.progress import daily_progress
from leadline.operators.quantiles import exact_quantiles
from leadline.operators.reliability import (
    event_reliability,
    operation_reliability,
    operation_totals,
)
from leadline.operators.sessions import session_summary
from leadline.operators.versions import by_version
from leadline.plans.tables import day_of, events, rounded, seconds_text, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

COUNTERS = {"amount": "value", "serial": "serial"}
VELOCITY_GAP_SECONDS = 43_200
# Small enough that keys of the given tables are cut into slices.
SLICE_ROWS = 50
AS_OF = "2024-01-25 12:34:56"
HOUR_RETENTION_DAYS = 10
EVENT_COUNTS = {
    "clicks": "click",
    "views": "view",
    "purchases": "purchase",
    "signups": "signup",
    "errors": "error",
}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


def _is(kind: str):
    return F.col("event_type") == kind


# --- projections and identity -------------------------------------------------


@query
def json_typed_projection(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "events")
    fields = {
        "k_text": ("$.k", "string"),
        "k_long": ("$.k", "bigint"),
        "k_int": ("$.k", "int"),
        "k_double": ("$.k", "double"),
        "absent": ("$.no.such", "string"),
    }
    day = F.to_date(F.col("ts").cast("timestamp")).cast("string").alias("event_date")
    typed = type_json(raw, "props", fields, ["event_id", day])
    return typed.withColumn(
        "k_flag", F.coalesce(to_boolean(F.col("k_text")), F.lit(False))
    )


@query
def event_identity(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "events")
    digest = event_digest(
        F.lit("events/log"), F.col("event_id"), F.encode(F.col("props"), "utf-8")
    )
    return raw.select("event_id", digest.alias("digest"))


@query
def dedup_by_content(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return (
        documents.groupBy(text_digest(F.col("text")).alias("content_id"))
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    )


@query
def new_by_content(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of one half of the sources whose text the other half lacks."""
    documents = table(spark, folder, "documents").withColumn(
        "content_id", text_digest(F.col("text"))
    )
    even = F.substring("source", -1, 1).isin("0", "2", "4", "6", "8")
    stored = documents.filter(even).select("content_id").distinct()
    fresh = dedup_new(documents.filter(~even), stored, "content_id", repeats_within=False)
    return fresh.select("doc_id", "source")


@query
def distinct_new_content(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct texts of one half of the sources that the other half lacks."""
    documents = table(spark, folder, "documents").select(
        "source", text_digest(F.col("text")).alias("content_id")
    )
    even = F.substring("source", -1, 1).isin("0", "2", "4", "6", "8")
    stored = documents.filter(even).select("content_id").distinct()
    return dedup_new(documents.filter(~even), stored, "content_id").select("content_id")


# --- sessions and counters ----------------------------------------------------


def _sessions(ev: DataFrame) -> DataFrame:
    return session_summary(
        ev,
        key="user_id",
        ts="ts",
        tie="event_id",
        completed=_is("purchase"),
        configured=F.when(_is("signup"), F.col("k")),
        owner="owner",
        version="version",
        completed_name="purchases",
        configured_name="configured_k",
    )


@query
def sessions_by_user(spark: SparkSession, folder: str) -> DataFrame:
    found = _sessions(events(spark, folder))
    return found.withColumns(
        {
            name: seconds_text(name)
            for name in ("session_started_at", "session_last_event_at")
        }
    )


def _velocity(
    spark: SparkSession, folder: str, rows_per_slice: int = ordered.ROWS_PER_SLICE
) -> DataFrame:
    return velocity.counter_velocity(
        events(spark, folder),
        key="user_id",
        ts="ts",
        tie="event_id",
        elapsed="k",
        counters=COUNTERS,
        max_gap=VELOCITY_GAP_SECONDS,
        rows_per_slice=rows_per_slice,
    )


@query
def counter_velocity(spark: SparkSession, folder: str) -> DataFrame:
    return _shown_velocity(_velocity(spark, folder))


@query
def counter_velocity_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every session cut into slices."""
    return _shown_velocity(_velocity(spark, folder, SLICE_ROWS))


def _shown_velocity(found: DataFrame) -> DataFrame:
    return rounded(
        found.withColumns(
            {"ts": seconds_text("ts"), "previous_ts": seconds_text("previous_ts")}
        ),
        "session_value",
        "session_amount_per_active_hour",
        "session_serial_per_active_hour",
        "value_delta",
        "amount_per_active_hour",
        "serial_per_active_hour",
    )


def _rollup(spark: SparkSession, folder: str) -> DataFrame:
    return velocity.velocity_rollup(
        _velocity(spark, folder), "ts", COUNTERS, _as_of(), HOUR_RETENTION_DAYS
    )


@query
def velocity_rollup(spark: SparkSession, folder: str) -> DataFrame:
    found = _rollup(spark, folder)
    return rounded(
        found.withColumns(
            {name: seconds_text(name) for name in ("period_start", "period_end")}
        ),
        "value",
        "amount_per_active_hour",
        "serial_per_active_hour",
    )


@query
def velocity_current(spark: SparkSession, folder: str) -> DataFrame:
    found = velocity.velocity_current(
        _velocity(spark, folder),
        "ts",
        "event_id",
        ["ts", "event_id", "k", "session_value", "session_amount_per_active_hour",
         "metric_quality"],
    )
    return rounded(
        found.withColumn("ts", seconds_text("ts")),
        "session_value",
        "session_amount_per_active_hour",
    )


@query
def velocity_periods(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.velocity_periods(
        _rollup(spark, folder), "day", "2024-01-05", "2024-01-25"
    )
    return rounded(
        found.select(
            seconds_text("period_start").alias("period_start"),
            "is_complete",
            "active_seconds",
            "amount_per_active_hour",
        ),
        "amount_per_active_hour",
    )


# --- reliability --------------------------------------------------------------


def _operations(ev: DataFrame) -> DataFrame:
    return operation_reliability(
        ev,
        ["event_date", "operation", "version"],
        F.col("outcome") == "ok",
        F.col("outcome") == "error",
        "value",
    )


@query
def operation_reliability_daily(spark: SparkSession, folder: str) -> DataFrame:
    found = _operations(events(spark, folder))
    return rounded(
        found.withColumn("event_date", F.col("event_date").cast("string")),
        "success_rate",
        "duration_p50_ms",
        "duration_p95_ms",
    )


@query
def operation_reliability_total(spark: SparkSession, folder: str) -> DataFrame:
    found = operation_totals(_operations(events(spark, folder)))
    return rounded(found, "success_rate", "duration_p95_ms")


def _event_reliability(ev: DataFrame, attribute_once: bool = False) -> DataFrame:
    timed = ev.withColumns(
        {
            "click_value": F.when(_is("click"), F.col("value")),
            "view_k": F.when(_is("view"), F.col("k")),
        }
    )
    return event_reliability(
        timed,
        ev.filter(_is("signup")).withColumnsRenamed({"k": "deaths", "value": "recoveries"}),
        day="event_date",
        key="user_id",
        version="version",
        provenance="provenance",
        counts={name: _is(kind) for name, kind in EVENT_COUNTS.items()},
        latencies={"click": "click_value", "view": "view_k"},
        issued="clicks",
        rejected="errors",
        rejection_rate="rejection_rate",
        state_maxima=["deaths", "recoveries"],
        attribute_once=attribute_once,
    )


_EVENT_RATES = [
    "rejection_rate",
    *[f"{p}_{q}_ms" for p in ("click", "view") for q in ("p50", "p95", "max")],
]


@query
def event_reliability_daily(spark: SparkSession, folder: str) -> DataFrame:
    found = _event_reliability(events(spark, folder))
    return rounded(
        found.withColumn("event_date", F.col("event_date").cast("string")), *_EVENT_RATES
    )


@query
def event_reliability_once(spark: SparkSession, folder: str) -> DataFrame:
    """Sampled counters kept on the first version of a session and day only."""
    found = _event_reliability(events(spark, folder), attribute_once=True)
    return found.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.sum("deaths").alias("deaths"),
        F.sum("state_snapshot_count").alias("state_snapshot_count"),
    )


def _progress(ev: DataFrame) -> DataFrame:
    active = ev.filter(F.col("event_type").isin("click", "view", "purchase"))
    return daily_progress(
        active,
        ev.filter(F.col("event_type").isin("signup", "error")),
        _sessions(active.withColumn("event_type", F.lit("purchase"))).withColumn(
            "configured_k", F.col("purchases")
        ),
        key="user_id",
        day="event_date",
        version="version",
        provenance="provenance",
        counts={"purchases": _is("purchase"), "views": _is("view")},
        maxima={"best_view": F.when(_is("view"), F.col("k"))},
        configured="configured_k",
        place="place",
        sample_place="k",
        sample_ts="ts",
        sample_tie="event_id",
        elapsed="k",
        sample_counters={"observed_serial": "serial"},
        completed="purchases",
        sampled_completed="k",
        rate="purchases_per_hour",
    )


@query
def progress_by_session(spark: SparkSession, folder: str) -> DataFrame:
    found = _progress(events(spark, folder))
    return rounded(
        found.withColumn("event_date", F.col("event_date").cast("string")),
        "purchases_per_hour",
    )


def _attempts(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        day_of("o_orderdate").alias("event_date"),
        F.col("o_custkey").alias("customer"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderstatus")).alias(
            "version"
        ),
        F.col("o_orderpriority").alias("provenance"),
        "o_orderkey",
        "o_orderpriority",
    )
    lines = table(spark, folder, "lineitem").select(
        day_of("l_shipdate").alias("event_date"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linestatus")).alias("version"),
        F.col("l_linestatus").alias("provenance"),
        "l_returnflag",
        "l_quantity",
        "l_discount",
    )
    return attempt_performance(
        orders,
        lines,
        lines.filter(F.col("l_quantity") > 45),
        day="event_date",
        key="customer",
        version="version",
        provenance="provenance",
        place="place",
        place_value=F.coalesce(F.nullif("o_orderkey", F.lit(0)), F.lit(-1)),
        event_counts={
            "urgent": F.col("o_orderpriority") == "1-URGENT",
            "relaxed": F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"),
        },
        attempt_count="tries",
        outcome="l_returnflag",
        outcomes={"arrived": "a", "none": "n", "returned": "r"},
        success="arrived",
        success_rate="arrival_rate",
        averages={"average_quantity": "l_quantity", "average_discount": "l_discount"},
        proxy_count="large_lines",
    )


@query
def attempts_by_day(spark: SparkSession, folder: str) -> DataFrame:
    found = _attempts(spark, folder)
    return rounded(
        found.withColumn("event_date", F.col("event_date").cast("string")),
        "arrival_rate",
        "average_quantity",
        "average_discount",
    )


def _versions(ev: DataFrame) -> DataFrame:
    tried = ev.groupBy("event_date", "version").agg(
        F.count_if(_is("view")).alias("views"), F.count_if(_is("signup")).alias("signups")
    )
    return by_version(
        _event_reliability(ev),
        _operations(ev),
        tried,
        version="version",
        provenance="provenance",
        day="event_date",
        event_sums=["purchases", "clicks", "errors"],
        issued="clicks",
        rejected="errors",
        rejection_rate="rejection_rate",
        operation_count="operations",
        operation_failures="operation_failures",
        failure_rate="failure_rate",
        attempt_sums=["views", "signups"],
    )


@query
def version_comparison(spark: SparkSession, folder: str) -> DataFrame:
    found = _versions(events(spark, folder))
    return rounded(
        found.withColumns(
            {
                name: F.col(name).cast("string")
                for name in ("first_event_date", "last_event_date")
            }
        ),
        "rejection_rate",
        "failure_rate",
    )


@query
def version_table(spark: SparkSession, folder: str) -> DataFrame:
    found = rollups.version_table(
        _versions(events(spark, folder)).withColumn(
            "version", F.concat(F.lit("release-"), "version")
        ),
        "version",
        ["provenance", "purchases", "rejection_rate", "operations"],
        ["first_event_date", "last_event_date"],
    )
    return rounded(found, "rejection_rate")


# --- quality ------------------------------------------------------------------


def _sources(spark: SparkSession, folder: str) -> DataFrame:
    ev = events(spark, folder).select(
        F.lit("events").alias("source"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("event_time"),
        (F.col("ts") + F.expr("interval 1 hour")).alias("ingested_at"),
    )
    documents = table(spark, folder, "documents").select(
        F.lit("documents").alias("source"),
        text_digest(F.col("text")).alias("event_id"),
        F.lit(None).cast("timestamp").alias("event_time"),
        F.lit(None).cast("timestamp").alias("ingested_at"),
    )
    turns = table(spark, folder, "conversations").select(
        F.lit("conversations").alias("source"),
        F.when(
            F.col("role") != "system",
            F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")),
        ).alias("event_id"),
        F.lit(None).cast("timestamp").alias("event_time"),
        F.lit(None).cast("timestamp").alias("ingested_at"),
    )
    return reduce(DataFrame.unionByName, [ev, documents, turns])


def _source_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Bookkeeping rows by (session, source), derived from events and orders."""
    good = F.count_if(_is("error") == F.lit(False))
    by_day = (
        events(spark, folder)
        .groupBy(F.date_format("ts", "yyyyMMdd").alias("session_id"))
        .agg(
            F.count("*").alias("lines_read"),
            good.alias("valid_json_rows"),
            F.count_if(_is("error")).alias("malformed_rows"),
            (good - F.count_if(_is("view"))).alias("new_rows"),
            F.count_if(_is("view")).alias("duplicate_rows"),
        )
        .withColumn("source", F.lit("events"))
    )
    by_priority = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("session_id"))
        .agg(
            F.count("*").alias("lines_read"),
            F.count_if(F.col("o_orderstatus") == "F").alias("valid_json_rows"),
            F.count_if(F.col("o_orderstatus") == "O").alias("malformed_rows"),
            F.count_if(F.col("o_orderstatus") == "F").alias("new_rows"),
            F.lit(0).cast("bigint").alias("duplicate_rows"),
        )
        .withColumn("source", F.lit("orders"))
    )
    return by_day.unionByName(by_priority)


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality_profile(_sources(spark, folder), _source_stats(spark, folder))


@query
def quality_by_source(spark: SparkSession, folder: str) -> DataFrame:
    found = _profile(spark, folder)
    return found.withColumns(
        {
            name: seconds_text(name)
            for name in ("earliest_event_time", "latest_event_time", "latest_ingested_at")
        }
    )


@query
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    return checks.quality_gate(_profile(spark, folder))


@query
def coverage_window(spark: SparkSession, folder: str) -> DataFrame:
    found = rollups.coverage_window(_profile(spark, folder))
    return found.select(*[seconds_text(name).alias(name) for name in found.columns])


@query
def source_status(spark: SparkSession, folder: str) -> DataFrame:
    return consumer.source_status(
        _profile(spark, folder),
        {"events": "Event log", "orders": "Order book"},
        observed_source="documents",
    )


@query
def relationship_check(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    filled = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F")
    return checks.orphans(lines, filled, "l_orderkey", "o_orderkey")


@query
def uniqueness_check(spark: SparkSession, folder: str) -> DataFrame:
    return checks.duplicate_ids(
        table(spark, folder, "documents").select(text_digest(F.col("text")).alias("content_id")),
        "content_id",
    )


@query
def column_checks(spark: SparkSession, folder: str) -> DataFrame:
    return checks.column_checks(
        events(spark, folder).select("event_id", "user_id", "version"),
        not_null=["event_id", "version"],
        unique=["event_id", "user_id"],
    )


@query
def accepted_values_check(spark: SparkSession, folder: str) -> DataFrame:
    return checks.outside_accepted(
        table(spark, folder, "lineitem"), "l_returnflag", ["A", "N"]
    )


@query
def reconciliation_check(spark: SparkSession, folder: str) -> DataFrame:
    return checks.count_mismatches(_source_stats(spark, folder))


@query
def quarantine_check(spark: SparkSession, folder: str) -> DataFrame:
    sessions = (
        events(spark, folder)
        .groupBy(F.date_format("ts", "yyyyMMdd").alias("session_id"))
        .agg(F.count_if(_is("error") & (F.col("k") != 13)).alias("quarantined_rows"))
    )
    return checks.quarantine_mismatches(sessions, _source_stats(spark, folder))


# --- order, joins over time ---------------------------------------------------


@query
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    found = ordered.latest_per_key(
        events(spark, folder),
        ["user_id"],
        "ts",
        "event_id",
        columns=["user_id", "event_id", "ts", "event_type", "value"],
    )
    return found.withColumn("ts", seconds_text("ts"))


@query
def asof_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return _asof_attribution(spark, folder, ordered.ROWS_PER_SLICE)


@query
def asof_attribution_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every user cut into slices."""
    return _asof_attribution(spark, folder, SLICE_ROWS // 10)


def _asof_attribution(spark: SparkSession, folder: str, rows_per_slice: int) -> DataFrame:
    ev = events(spark, folder)
    found = ordered.last_known(
        ev.filter(_is("error")).select("event_id", "user_id", "ts"),
        ev.filter(_is("signup")).select(
            "user_id", F.col("ts").alias("signed_at"), F.col("event_id").alias("signup_id")
        ),
        ts="ts",
        right_ts="signed_at",
        values={"signup_id": "signup_id"},
        by=["user_id"],
        tie="signup_id",
        rows_per_slice=rows_per_slice,
    )
    return found.withColumn("ts", seconds_text("ts"))


def _releases(ev: DataFrame) -> DataFrame:
    """Purchases in the place of commits."""
    return ev.filter(_is("purchase")).select(
        F.col("ts").alias("committed_at"), F.col("event_id").alias("sha")
    )


def _asof_version(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Every event with the latest purchase of anyone at or before it."""
    ev = events(spark, folder)
    found = ordered.last_known(
        ev.select("event_id", "ts"),
        _releases(ev),
        ts="ts",
        right_ts="committed_at",
        values={"release_id": "sha"},
        tie="sha",
        **options,
    )
    return _with_label(found)


def _with_label(found: DataFrame) -> DataFrame:
    known = F.when(F.col("release_id").isNotNull(), "inferred_from_commit_time")
    return found.select("event_id", "release_id", known.otherwise("unavailable").alias("provenance"))


@query
def asof_version(spark: SparkSession, folder: str) -> DataFrame:
    return _asof_version(spark, folder)


@query
def asof_version_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the one key that all rows share cut into slices."""
    return _asof_version(spark, folder, rows_per_slice=SLICE_ROWS)


@query
def asof_version_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The same through the broadcast by day; a history too large for it is windowed."""
    ev = events(spark, folder)
    asked, releases = ev.select("event_id", "ts"), _releases(ev)
    found = ordered.last_known_small(asked, releases, "ts", "committed_at", "sha", "release_id")
    return _asof_version(spark, folder) if found is None else _with_label(found)


@query
def change_points(spark: SparkSession, folder: str) -> DataFrame:
    return _change_points(events(spark, folder), ordered.ROWS_PER_SLICE)


@query
def change_points_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every user cut into slices."""
    return _change_points(events(spark, folder), SLICE_ROWS)


@query
def change_points_with_holes(spark: SparkSession, folder: str) -> DataFrame:
    """Sliced, with missing keys and times and with times far from all others."""
    serial = F.col("serial")
    holes = events(spark, folder).withColumns(
        {
            "user_id": F.when(F.col("user_id") % 13 != 0, F.col("user_id")),
            "ts": F.when(serial % 101 == 0, F.lit("1970-01-01 00:00:01").cast("timestamp")).when(
                serial % 11 != 0, F.col("ts")
            ),
        }
    )
    return _change_points(holes, SLICE_ROWS)


def _change_points(ev: DataFrame, rows_per_slice: int) -> DataFrame:
    found = ordered.changes(
        ev.select("event_id", "user_id", "ts", "event_type", "version"),
        ["user_id"],
        "ts",
        "event_id",
        ["event_type", "version"],
        rows_per_slice,
    )
    return found.withColumn("ts", seconds_text("ts"))


@query
def last_known_with_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Sliced as-of join on days: many right rows of one instant, ties missing."""
    ev = events(spark, folder)
    found = ordered.last_known(
        ev.select("event_id", "user_id", F.when(F.col("serial") % 11 != 0, F.col("ts")).alias("ts")),
        ev.filter(_is("view")).select(
            "user_id",
            F.date_trunc("day", "ts").alias("seen_at"),
            F.when(F.col("serial") % 3 != 0, F.col("k")).alias("tie"),
            F.col("event_id").alias("view_id"),
        ),
        ts="ts",
        right_ts="seen_at",
        values={"view_id": "view_id"},
        by=["user_id"],
        tie="tie",
        rows_per_slice=SLICE_ROWS,
    )
    return found.select("event_id", "view_id")


@query
def operation_reliability_bracketed(spark: SparkSession, folder: str) -> DataFrame:
    """Latency quantiles with brackets around each of them."""
    ev = events(spark, folder).withColumn("group", F.col("user_id") % 5)
    found = exact_quantiles(
        ev, ["group", "event_type"], {"value": "value", "k": "k"}, {"p50": 0.5, "p95": 0.95}, accuracy=40
    )
    return rounded(found, "value_p50", "value_p95", "k_p50", "k_p95")


@query
def null_safe_join(spark: SparkSession, folder: str) -> DataFrame:
    def hidden(name: str):
        return F.when(F.col(name) != 3, F.col(name)).alias("nation")

    by_customer = (
        table(spark, folder, "customer")
        .groupBy(hidden("c_nationkey"), "c_mktsegment")
        .agg(F.count("*").alias("customers"))
    )
    by_supplier = (
        table(spark, folder, "supplier")
        .groupBy(hidden("s_nationkey"))
        .agg(F.count("*").alias("suppliers"))
    )
    return join_null_safe(by_customer, by_supplier, ["nation"], "left")


# --- reference list -----------------------------------------------------------


def _catalog(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("nm_key"),
        F.col("n_name").alias("display_name"),
    )


def _observed(spark: SparkSession, folder: str) -> DataFrame:
    # One observation for each nation with an even number of suppliers.
    return (
        table(spark, folder, "supplier")
        .groupBy(F.col("s_nationkey").cast("string").alias("nm_key"))
        .agg(
            F.count("*").alias("suppliers"),
            F.round(F.sum("s_acctbal")).cast("bigint").alias("total"),
        )
        .filter(F.col("suppliers") % 2 == 0)
        .select(
            "nm_key",
            F.when(F.col("total") % 2 == 0, "spawned").otherwise("primed").alias("status"),
            F.col("suppliers").alias("effective_chance_percent"),
            F.when(F.col("total") % 3 != 0, "alive").alias("placeholder_status"),
            F.concat(
                F.lit("2024-01-25T"),
                F.lpad((F.lit(8) + F.col("suppliers") % 5).cast("string"), 2, "0"),
                F.lit(":00:00Z"),
            ).alias("observed_at"),
            F.when(F.col("total") % 3 == 0, "2024-01-20T00:00:00+00:00").alias(
                "last_observed_kill_at"
            ),
        )
    )


def _completions(spark: SparkSession, folder: str) -> DataFrame:
    bought = (
        table(spark, folder, "customer")
        .join(
            table(spark, folder, "orders").select("o_custkey", "o_orderdate"),
            F.col("c_custkey") == F.col("o_custkey"),
        )
        .filter(F.col("c_nationkey") % 4 != 0)
        .join(
            table(spark, folder, "nation").select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
        )
        .withColumn("at", F.col("o_orderdate").cast("timestamp"))
    )
    return rollups.completions_by_target(bought, "n_name", "at")


@query
def completions_by_target(spark: SparkSession, folder: str) -> DataFrame:
    return _completions(spark, folder).withColumn(
        "last_recorded_defeat_at", seconds_text("last_recorded_defeat_at")
    )


@query
def entity_status(spark: SparkSession, folder: str) -> DataFrame:
    completions = _completions(spark, folder).withColumn(
        "last_recorded_defeat_at",
        F.concat(seconds_text("last_recorded_defeat_at"), F.lit("+00")),
    )
    return status.entity_status(
        _catalog(spark, folder),
        _observed(spark, folder),
        completions,
        _as_of(),
        observed_fields=[
            "placeholder_status",
            "last_observed_kill_at",
            "effective_chance_percent",
        ],
    )


@query
def unknown_observed_keys(spark: SparkSession, folder: str) -> DataFrame:
    catalog = _catalog(spark, folder).join(
        table(spark, folder, "customer")
        .groupBy(F.col("c_nationkey").cast("string").alias("nm_key"))
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") % 2 == 0),
        "nm_key",
    )
    return status.unknown_keys(_observed(spark, folder), catalog, "nm_key")


# --- published daily tables and questions asked of them ------------------------


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.daily_totals(
        _event_reliability(events(spark, folder)),
        "event_date",
        sums=list(EVENT_COUNTS),
        maxima=["click_p95_ms", "click_max_ms", "view_p95_ms", "view_max_ms", "deaths"],
        labels={"deaths_quality": "state_metric_quality"},
        rates={"rejection_rate": ("errors", ["clicks", "errors"])},
    )


@query
def events_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_daily(spark, folder), "rejection_rate", "click_p95_ms", "view_p95_ms")


@query
def progress_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.daily_totals(
        _progress(events(spark, folder)),
        "event_date",
        sums=["purchases", "views", "observed_serial", "state_snapshot_count"],
        maxima=["best_view"],
        labels={"coverage_quality": "coverage_quality"},
    )


@query
def attempts_daily(spark: SparkSession, folder: str) -> DataFrame:
    found = rollups.daily_totals(
        _attempts(spark, folder),
        "event_date",
        sums=["urgent", "relaxed", "tries", "arrived", "none", "returned"],
        maxima=["large_lines"],
        rates={"arrival_rate": ("arrived", ["tries"])},
    )
    return rounded(found, "arrival_rate")


@query
def unpivot_mix(spark: SparkSession, folder: str) -> DataFrame:
    return consumer.mix(
        _daily(spark, folder), ["event_date"], ["clicks", "views"], "kind", "count"
    )


@query
def outcome_totals(spark: SparkSession, folder: str) -> DataFrame:
    return consumer.outcome_totals(
        _attempts(spark, folder),
        {"arrived": "arrived", "none": "none", "returned": "returned"},
    )


@query
def headline_totals(spark: SparkSession, folder: str) -> DataFrame:
    chosen = consumer.between_days(_daily(spark, folder), "2024-01-05", "2024-01-20")
    return consumer.totals(chosen, ["purchases", "clicks", "errors"])


@query
def success_share(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.success_share(
        operation_totals(_operations(events(spark, folder))),
        "successful_operations",
        "operation_count",
        "success_share",
    )
    return rounded(found, "success_share")


@query
def milestones_by_day(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.milestones(_daily(spark, folder), ["signups", "purchases"])
    return found.select("event_date", "milestones")


@query
def top_operations(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.top_by_volume(
        operation_totals(_operations(events(spark, folder))),
        "operation_count",
        ["operation"],
        5,
    )
    return rounded(
        found.select("operation", "operation_count", "success_rate", "relative_volume"),
        "success_rate",
        "relative_volume",
    )


@query
def recent_days_peak(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.recent_days(_daily(spark, folder), "event_date", "purchases")
    return rounded(found, "relative_height", "change_from_day_before")


@query
def rate_change(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.rate_change(_daily(spark, folder), "event_date", "rejection_rate")
    return rounded(found, *found.columns)


@query
def action_share(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.shares(_daily(spark, folder), ["clicks", "views", "purchases"])
    return rounded(found, "share")


@query
def latest_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.latest_arrivals(
        _attempts(spark, folder), "arrived", "tries", "large_lines"
    )
    return rounded(found, "arrival_rate")


@query
def stale_sessions(spark: SparkSession, folder: str) -> DataFrame:
    sessions = _sessions(events(spark, folder))
    return sessions.select(
        "user_id",
        consumer.is_stale(_as_of(), F.col("session_last_event_at")).alias("is_stale"),
    )


@query
def current_period(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.current_period(_rollup(spark, folder), "week")
    return found.select(
        seconds_text("period_start").alias("period_start"), "active_seconds", "serial"
    )


@query
def completed_periods(spark: SparkSession, folder: str) -> DataFrame:
    found = consumer.completed_periods(_rollup(spark, folder), "week")
    return found.select(seconds_text("period_start").alias("period_start"), "serial")


@query
def observer_summary(spark: SparkSession, folder: str) -> DataFrame:
    observed = _observed(spark, folder)
    root = observed.agg(F.max("observed_at").alias("observed_at")).select(
        F.lit(1).alias("schema_version"),
        "observed_at",
        F.lit("2024-01-01T00:00:00Z").alias("map_started_at"),
        F.lit("0123456789abcdef").alias("ruleset_git_sha"),
    )
    return status.observer_summary(_catalog(spark, folder), root, observed, _as_of())


@query
def findings(spark: SparkSession, folder: str) -> DataFrame:
    ev = events(spark, folder)
    fought = _event_reliability(ev).withColumnsRenamed(
        {
            "purchases": "completed_fights",
            "clicks": "attack_issued",
            "errors": "attack_rejections",
        }
    )
    tried = _attempts(spark, folder).withColumnsRenamed(
        {
            "arrived": "successful_collision_probes",
            "none": "partial_progress_probes",
            "returned": "stalled_probes",
        }
    )
    found = consumer.findings(fought, _operations(ev), tried)
    return rounded(found, "attack_rejection_rate", "success_rate", "probe_arrival_rate")
