"""From logs and sampled states to stored tables and the published document."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leadline.operators import checks, consumer
from leadline.operators.states import snapshot_tables, to_state_rows
from leadline.plans.silver import state_snapshots
from leadline.plans.contracts import ContractError
from leadline.plans.ingest import ingest_session
from leadline.plans.refresh import build_tables, load_snapshot, publish
from leadline.sinks.bronze import write_bronze
from leadline.sources.documents import read_commits, read_state_documents
from leadline.sources.relational import check_allowed
from leadline.sources.stored import bronze

NOW = dt.datetime(2026, 7, 31, 12, tzinfo=dt.timezone.utc)
SHA = "0123456789" * 4


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("refresh")
    root, data = base / "source", str(base / "data")
    lines = lambda rows: "".join(json.dumps(r) + "\n" for r in rows)
    _write(root / "runtime/audit/agent-actions.jsonl", lines(
        {"timestamp": f"2026-07-30T0{h}:00:00Z", "operation": op, "outcome": "ok", "duration_ms": h}
        for h in range(5) for op in ("move", "look")
    ) + "{bad\n")
    _write(root / "runtime/farm-supervisor/one.log", lines(
        {"at": f"2026-07-30T0{h}:00:00Z", "event": e, "lease_id": "L1", "name": "Target-1"}
        for h in range(3) for e in ("attack_issued", "fight_complete")
    ))
    _write(root / "runtime/navigation/collision-probes.jsonl", lines(
        {"timestamp": "2026-07-30T01:00:00Z", "outcome": o} for o in ("arrived", "stalled")
    ))
    _write(base / "commits.txt", f"{SHA}\t2026-07-29T00:00:00Z\nnot a commit\n")
    commits = read_commits(spark, str(base / "commits.txt"))
    ingest_session(spark, str(root), data, historical=True, full_scan=True, commits=commits)
    for number in range(4):
        state = {"lease_id": "L1", "phase": "x", "elapsed_seconds": 600 * number,
                 "config": {"b": 1, "a": [2]}, "counters": {"exp_earned": 50 * number, "gil_earned": number}}
        document = spark.createDataFrame([(json.dumps(state),)], "document string")
        at = F.lit(dt.datetime(2026, 7, 30, number)).cast("timestamp")
        write_bronze(to_state_rows(document, at, SHA), data)
    catalog = {"nms": [{"nm_key": f"t{n}", "display_name": f"Target-{n}"} for n in range(20)]}
    _write(base / "catalog.json", json.dumps(catalog))
    tables = build_tables(spark, data, "silver_t", "gold_t")
    written = publish(spark, tables, str(base / "catalog.json"), str(base / "out.json"),
                      str(base / "mirror.json"), now=NOW)
    return base, data, tables, written


def test_published_document(built):
    base, _, _, written = built
    document = json.loads((base / "out.json").read_text())
    assert (base / "mirror.json").read_bytes() == (base / "out.json").read_bytes()
    sets = document["datasets"]
    assert written["datasets"]["progression_velocity"] == len(sets["progression_velocity"])
    assert [r["period_grain"] for r in sets["progression_velocity"]] == ["hour"] * 3 + ["day", "week"]
    day = sets["progression_velocity"][3]
    assert (day["exp_earned"], day["active_seconds"], day["exp_per_active_hour"]) == (150, 1800, 300.0)
    assert day["period_start"] == "2026-07-30T00:00:00+00:00" and day["is_complete"]
    assert sets["progression_current"][0]["lease_exp_earned"] == 150
    assert sets["mcp_operations"][0]["operation_count"] == 5
    assert sets["commit_performance"][0]["source_git_sha"] == SHA[:8]
    assert sets["combat_daily"][0]["completed_fights"] == 3
    assert sets["navigation_daily"][0]["collision_probe_success_rate"] == 0.5
    assert document["coverage"]["earliest_event_time"] == "2026-07-30T00:00:00+00:00"
    target = next(r for r in sets["nm_status"] if r["nm_key"] == "t1")
    assert (target["recorded_defeat_count"], target["data_quality"]) == (3, "recorded_defeat_only")
    assert target["last_observed_kill_at"] == "2026-07-30T02:00:00+00:00"


def test_load_prefers_tables_then_the_document(spark, built):
    base = built[0]
    live = load_snapshot(spark, str(base / "out.json"), str(base / "catalog.json"), "gold_t", "silver_t", NOW)
    assert live["mode"] == "local_gold_models"
    stored = load_snapshot(spark, str(base / "out.json"), None, "nowhere", "nowhere")
    assert stored["mode"] == "published_aggregate_snapshot"
    assert live["datasets"]["mcp_operations"] == stored["datasets"]["mcp_operations"]


def test_tables_can_be_rebuilt_and_rules_stop_them(spark, built):
    _, data, tables, _ = built
    for _ in range(2):
        assert build_tables(spark, data, "silver_u", "gold_u")["silver_fights"].count() == 3
    copied = f"{data}-copy"
    events = bronze(spark, data)
    write_bronze(events, copied)
    write_bronze(events.limit(1), copied)
    with pytest.raises(ContractError, match="stored once"):
        build_tables(spark, copied, "silver_u", "gold_u")


def test_state_rows(spark, built):
    _, data, tables, _ = built
    row = tables["silver_state_snapshots"].orderBy("observed_at").first()
    raw = json.loads(row["raw_json"])
    import hashlib

    config = json.dumps(raw["config"], sort_keys=True, separators=(",", ":"))
    assert raw["configuration_hash"] == hashlib.sha256(config.encode()).hexdigest()
    assert row["configuration_hash"] == raw["configuration_hash"]
    assert row["raw_json"] == json.dumps(raw, sort_keys=True, separators=(",", ":"))
    assert raw["observation_time"] == "2026-07-30T00:00:00+00:00"
    assert raw["observed_source_git_sha"] == SHA
    stored = bronze(spark, data).filter("source = 'state_snapshot'").orderBy("event_time").first()
    micros = stored["source_line_number"]
    digest = hashlib.sha256(
        b"runtime/farm-supervisor/primary.json\x00" + str(micros).encode() + b"\x00" + row["raw_json"].encode()
    )
    assert stored["event_id"] == digest.hexdigest()
    assert stored["collector_session_id"] == "observer-20260730"


def test_state_documents_are_checked(spark, tmp_path):
    assert read_state_documents(spark, str(tmp_path / "none.json")) is None
    _write(tmp_path / "s/good.json", '{"a": 1}')
    _write(tmp_path / "s/list.json", "[1]")
    _write(tmp_path / "s/empty.json", "")
    _write(tmp_path / "s/large.json", '{"a": "' + "x" * (1 << 20) + '"}')
    found = read_state_documents(spark, str(tmp_path / "s/*.json")).collect()
    assert [r["document"] for r in found] == ['{"a": 1}']


def test_table_snapshots(spark):
    rows = spark.sql(
        "select 1 charid, date '2026-01-02' d, timestamp '2026-01-02 03:04:05' t, "
        "1.50BD price, X'0aff' b, cast(null as string) n"
    )
    at = F.lit("2026-07-30 00:00:00").cast("timestamp")
    found = snapshot_tables({"chars": rows}, at, "id1", SHA, prefix="db").first()
    assert json.loads(found["raw_json"]) == {
        "b": "0aff", "charid": 1, "d": "2026-01-02", "n": None, "price": "1.50", "t": "2026-01-02T03:04:05",
    }
    assert (found["source"], found["event_type"]) == ("db_chars", "database_snapshot")
    again = snapshot_tables({"chars": rows}, at, "id2", SHA, prefix="db").first()
    assert again["event_id"] != found["event_id"]
    with pytest.raises(ValueError, match="accounts"):
        check_allowed(["chars", "accounts"], {"chars": ("charid",)})


def test_table_rows_are_written_like_json_dumps(spark):
    values = [0.0, -0.0, 100.0, 2095.23, 1e-5, 0.0005, 12345678.9, 1e7, 1e15, 1e16, 2.0**-44, 1e300, None]
    texts = ["plain", "é ☃ 𝄞", 'quote " back \\ slash / ', "line\n\t\x01\x7f", "long " * 2000, "", None]
    rows = [(i, v, texts[i % len(texts)], 0.1) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "charid long, d double, s string, f float")
    at = F.lit("2026-07-30 00:00:00").cast("timestamp")
    found = snapshot_tables({"chars": frame}, at, "id1", SHA, prefix="db").select("raw_json").collect()
    want = [json.dumps(dict(zip("d f s".split(), (v, f, s))) | {"charid": i}, sort_keys=True, separators=(",", ":")) for i, v, s, f in rows]
    assert sorted(r.raw_json for r in found) == sorted(want)


def test_failing_names_only_checks_with_rows(spark):
    some, none = spark.range(1), spark.range(0)
    assert checks.failing({"a": some, "b": none}) == ["a"]


def test_findings_and_status(built):
    tables = built[2]
    row = consumer.findings(
        tables["gold_combat_reliability"], tables["gold_mcp_operation_reliability"],
        tables["gold_navigation_performance"],
    ).first()
    assert (row["completed_fights"], row["operations"], row["success_rate"]) == (3, 10, 1.0)
    assert row["probe_arrival_rate"] == 0.5 and row["attack_rejection_rate"] == 0.0
    shown = consumer.source_status(
        tables["gold_data_quality"], {"navigation": "Probes"}, "state_snapshot"
    )
    assert {r["source"]: r["status"] for r in shown.collect()} == {
        "agent_actions": "Reconciled", "farm_supervisor": "Reconciled", "Probes": "Reconciled",
        "state_snapshot": "Observed",
    }


def test_states_are_read_in_one_python_step(spark):
    """A second one would be a second worker of each task."""
    rows = [('{"lease_id":"l"}', dt.datetime(2026, 8, 1, 5)), ("[1]", dt.datetime(2026, 8, 1, 5)), (None, None)] * 1500
    frame = spark.createDataFrame(rows, "document string, at timestamp")
    found = state_snapshots(to_state_rows(frame, F.col("at"), None))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in found.select("lease_id").distinct().collect()] == [("l",)] and found.count() == 1500
