"""Ingest sessions on literal files: lines, resume, quarantine, identity, attribution."""

from __future__ import annotations

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from leadline.config import shared_folder
from leadline.operators.ingest import (
    attribute_asof,
    clean_commits,
    dedup_new,
    to_envelope,
)
from leadline.plans.ingest import ingest_session
from leadline.sources.files import freeze
from leadline.sources.lines import read_lines, resume_plan
from leadline.sources.specs import EVENT_SOURCES, SourceSpec
from leadline.sources.stored import bronze, file_results, read_manifests, saved_offsets

ACTION = {
    "timestamp": "2026-08-04T06:30:00Z",
    "agent_id": "second",
    "operation": "inventory_read",
    "outcome": "ok",
    "duration_ms": 37,
    "params": {"page": 2},
}
FIGHT = {"at": "2026-08-04T06:31:12Z", "event": "fight_complete", "lease_id": "run-b", "fight": 3}
PROBE = {"timestamp": "2026-08-04T06:32:40Z", "agent_id": "second", "outcome": "blocked"}
ONE_LOG = (SourceSpec("log", "log.jsonl", "at", "event"),)
SHA = "a" * 40


def _write(root, name, content: bytes):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as handle:
        handle.write(content)
    return path


def _lines(*documents) -> bytes:
    return b"".join(json.dumps(d).encode() + b"\n" for d in documents)


@pytest.fixture
def places(tmp_path):
    root, data = tmp_path / "source", tmp_path / "data"
    root.mkdir()
    return str(root), str(data)


def test_backfill_reconciles_quarantines_and_repeats_safely(spark, places):
    root, data = places
    _write(root, "runtime/audit/agent-actions.jsonl", _lines(ACTION) + b"{malformed\n")
    _write(root, "runtime/farm-supervisor/lease.log", _lines(FIGHT))
    _write(root, "runtime/navigation/collision-probes.jsonl", _lines(PROBE))
    commits = spark.createDataFrame(
        [(SHA, "2026-07-29T00:00:00Z"), ("short", "2026-07-29T00:00:00Z"), ("b" * 40, "later")],
        "sha string, committed_at string",
    )
    first = ingest_session(spark, root, data, historical=True, full_scan=True, commits=commits)
    second = ingest_session(spark, root, data, historical=True, full_scan=True, commits=commits)
    assert (first["written_rows"], first["quarantined_rows"]) == (3, 1)
    assert (second["written_rows"], second["quarantined_rows"]) == (0, 1)

    rows = {r["source"]: r for r in bronze(spark, data).collect()}
    assert len(rows) == 3
    fight = rows["farm_supervisor"]
    raw = _lines(FIGHT)
    assert fight["event_id"] == hashlib.sha256(
        b"runtime/farm-supervisor/lease.log\x001\x00" + raw
    ).hexdigest()
    assert fight["source_fingerprint_sha256"] == hashlib.sha256(raw).hexdigest()
    assert json.loads(fight["raw_json"]) == FIGHT
    assert (fight["event_type"], fight["lease_id"], fight["event_date"]) == (
        "fight_complete", "run-b", "2026-08-04",
    )
    assert rows["navigation"]["event_type"] == "navigation_probe"
    assert {r["source_git_sha"] for r in rows.values()} == {SHA}
    assert {r["git_sha_provenance"] for r in rows.values()} == {"inferred_from_commit_time"}

    sessions, stats = read_manifests(spark, data)
    assert {r["reconciled"] for r in sessions.collect()} == {True}
    by_session = stats.groupBy("session_id").agg(
        F.sum("valid_json_rows"), F.sum("malformed_rows"), F.sum("duplicate_rows")
    )
    assert {tuple(r)[1:] for r in by_session.collect()} == {(3, 1, 0), (3, 1, 3)}
    bad = spark.read.json(f"{data}/quarantine")
    assert {r["error_type"] for r in bad.collect()} == {"JSONDecodeError"}
    assert bad.select("session_id").distinct().count() == 2


@pytest.mark.parametrize("range_bytes", [1, 3, 7, 64, 1 << 20])
@pytest.mark.parametrize("ending", [b"\n", b""])
def test_lines_of_small_ranges(spark, places, range_bytes, ending):
    root, _ = places
    lines = [b"{}", b"", b"\r", b'{"k": "' + b"x" * 40 + b'"}', b"abc", b"\xff\xfe", b"z"]
    content = b"\n".join(lines) + ending
    _write(root, "log.jsonl", content)
    folder = shared_folder(spark, "t")
    frozen = freeze(spark, root, ONE_LOG, folder)
    files, ranges, _ = resume_plan(spark, frozen, None, folder, "read", range_bytes)
    found = read_lines(ranges, 10).orderBy("source_line_number").collect()
    expected = content.splitlines(keepends=True) if b"\r" not in content else None
    pieces = [line + b"\n" for line in lines]
    if not ending:
        pieces[-1] = lines[-1]
    assert [bytes(r["raw"]) for r in found] == pieces
    assert [r["source_line_number"] for r in found] == list(range(1, len(pieces) + 1))
    assert expected is None
    row = files.first()
    if range_bytes >= len(content):
        assert row["fingerprint"] == hashlib.sha256(content).hexdigest()
    assert row["stop"] == len(content)


def test_envelope_defaults(spark):
    documents = [
        '{"event":"e","agent_id":7,"at":"2026-07-30T00:00:00"}',
        '{"event":"","lease_id":null}',
        '{"event":0}',
        '{"event":"0"}',
        '{"event":false}',
        '{"event":[]}',
        '{"at":5}',
    ]
    rows = [(f"id{i}", "log", "log.jsonl", i, bytearray(d.encode() + b"\r\n"), "f") for i, d in enumerate(documents)]
    df = spark.createDataFrame(
        rows,
        "event_id string, source string, source_file string, source_line_number long, "
        "raw binary, source_fingerprint_sha256 string",
    )
    now = F.lit("2026-08-01 00:00:00").cast("timestamp")
    found = to_envelope(df, ONE_LOG, "s1", now).orderBy("source_line_number").collect()
    assert [r["event_type"] for r in found] == [
        "e", "unknown", "unknown", "0", "unknown", "unknown", "unknown",
    ]
    assert [r["raw_json"] for r in found] == documents
    assert found[0]["agent_id"] == "7" and found[1]["lease_id"] is None
    assert found[0]["event_time"] is not None and found[6]["event_time"] is None


def _ids(spark, data):
    return {r["event_id"] for r in bronze(spark, data).collect()}


def test_growth_torn_line_shrink_and_rewrite(spark, places):
    root, data = places
    one, two, three = ({"event": e, "at": "2026-07-30T00:00:00Z"} for e in "abc")
    half = _lines(two)[:9]

    def run(**options):
        return ingest_session(spark, root, data, specs=ONE_LOG, version="v", range_bytes=16, **options)

    _write(root, "log.jsonl", _lines(one) + half)
    first = run()
    assert (first["written_rows"], first["quarantined_rows"]) == (1, 0)
    offset = saved_offsets(spark, data).first()
    assert (offset["byte_offset"], offset["line_number"]) == (len(_lines(one)), 1)
    results = spark.read.parquet(f"{data}/state/files").first()
    assert results["tail_bytes"] == len(half)

    # Nothing new, then the line is completed and one more follows.
    assert run()["written_rows"] == 0
    _write(root, "log.jsonl", _lines(one, two, three))
    assert run()["written_rows"] == 2
    numbers = bronze(spark, data).select("event_type", "source_line_number").collect()
    assert {tuple(r) for r in numbers} == {("a", 1), ("b", 2), ("c", 3)}

    # Only new bytes are read when the prefix is unchanged.
    _write(root, "log.jsonl", _lines(one, two, three, one))
    run()
    latest = read_manifests(spark, data)[1].orderBy(F.desc("session_id")).first()
    assert (latest["lines_read"], latest["new_rows"]) == (1, 1)

    # A shorter file is read from its start; its lines are known already.
    _write(root, "log.jsonl", _lines(one, two))
    assert run()["written_rows"] == 0
    latest = read_manifests(spark, data)[1].orderBy(F.desc("session_id")).first()
    assert (latest["lines_read"], latest["duplicate_rows"]) == (2, 2)

    # A file rewritten in place is read from its start.
    _write(root, "log.jsonl", _lines(three, two, one))
    assert run()["written_rows"] == 2
    assert len(_ids(spark, data)) == 6


def test_growth_is_hashed_and_not_what_earlier_sessions_read(spark, places):
    root, data = places
    rows = [{"event": f"e{i:04d}", "at": "2026-07-30T00:00:00Z"} for i in range(60)]

    def run(*some, verify="growth"):
        _write(root, "log.jsonl", _lines(*some))
        written = ingest_session(spark, root, data, specs=ONE_LOG, range_bytes=256, verify=verify)["written_rows"]
        latest = file_results(spark, data).orderBy(F.desc("session_id")).first()
        return written, latest["start_line_number"], latest["hashed_bytes"]

    size = len(_lines(*rows[:20]))
    assert run(*rows[:20]) == (20, 0, size)
    # The range in which the growth starts is hashed again, no other.
    written, line, hashed = run(*rows[:50])
    assert (written, line) == (30, 20)
    assert hashed == len(_lines(*rows[:50])) - (size - 1) // 256 * 256
    fingerprint = file_results(spark, data).orderBy(F.desc("session_id")).first()["fingerprint_sha256"]
    # Hashing everything finds the same digest, and the same place to go on from.
    assert run(*rows[:50], verify="full") == (0, 50, len(_lines(*rows[:50])))
    assert file_results(spark, data).orderBy(F.desc("session_id")).first()["fingerprint_sha256"] == fingerprint
    # A rewritten file is told by its last range, a shortened one by its size.
    changed = [{**row, "event": "x" + row["event"][1:]} for row in rows[:50]]
    assert run(*changed) == (50, 0, len(_lines(*changed)))
    assert run(*changed[:10])[:2] == (0, 0)
    # Leaves of the longer file are not taken for those of the one that grows again. Lines that
    # stood at their places before are known.
    assert run(*changed[:10], *rows[10:40])[:2] == (0, 10)
    assert run(*changed[:10], *rows[10:60], verify="full")[:2] == (10, 40)
    with pytest.raises(ValueError, match="verify"):
        run(rows[0], verify="some")


def test_full_scan_takes_an_unfinished_last_line(spark, places):
    root, data = places
    _write(root, "log.jsonl", _lines(FIGHT)[:-1])
    assert ingest_session(spark, root, data, specs=ONE_LOG)["written_rows"] == 0
    assert ingest_session(spark, root, data, specs=ONE_LOG, full_scan=True)["written_rows"] == 1


def test_missing_sources_and_unknown_dates(spark, places):
    root, data = places
    assert ingest_session(spark, root, data)["written_rows"] == 0
    _write(root, "runtime/audit/agent-actions.jsonl", _lines({"operation": "x"}))
    assert ingest_session(spark, root, data)["written_rows"] == 1
    row = bronze(spark, data).first()
    assert row["event_time"] is None and row["event_date"] == "unknown"
    assert row["git_sha_provenance"] == "unavailable"


def test_links_are_rejected(spark, places, tmp_path):
    root, data = places
    outside = _write(str(tmp_path), "outside/secret.log", _lines(FIGHT))
    os.makedirs(f"{root}/runtime/farm-supervisor")
    os.symlink(outside, f"{root}/runtime/farm-supervisor/linked.log")
    with pytest.raises(ValueError, match="symbolic link"):
        ingest_session(spark, root, data)


def test_linked_folder_escapes(spark, places, tmp_path):
    root, data = places
    _write(str(tmp_path), "outside/secret.log", _lines(FIGHT))
    os.makedirs(f"{root}/runtime")
    os.symlink(f"{tmp_path}/outside", f"{root}/runtime/farm-supervisor")
    with pytest.raises(ValueError, match="outside the source root"):
        ingest_session(spark, root, data)


def test_dedup_within_and_against_stored(spark):
    new = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3)], "event_id string, v int")
    stored = spark.createDataFrame([("c",)], "event_id string")
    assert sorted(r["event_id"] for r in dedup_new(new, stored).collect()) == ["a", "b"]


def test_attribution_by_time(spark):
    commits = clean_commits(
        spark.createDataFrame(
            [(c * 40, t) for c, t in [("a", "2026-01-01T00:00:00Z"), ("b", "2026-01-03T00:00:00Z"),
                                      ("c", "2026-01-03T00:00:00Z")]],
            "sha string, committed_at string",
        )
    )
    times = ["2025-12-31 23:59:59", "2026-01-01 00:00:00", "2026-01-02 12:00:00",
             "2026-01-03 00:00:00", "2027-01-01 00:00:00", None]
    from leadline.schemas import BRONZE

    events = spark.createDataFrame([(f"e{i}", t) for i, t in enumerate(times)], "event_id string, t string")
    full = events.select(
        *[
            (F.col("event_id") if f.name == "event_id"
             else F.col("t").cast("timestamp").alias("event_time") if f.name == "event_time"
             else F.lit(None).cast(f.dataType).alias(f.name))
            for f in BRONZE.fields
            if f.name not in ("source_git_sha", "git_sha_provenance")
        ]
    )
    found = attribute_asof(full, commits).orderBy("event_id").collect()
    assert [(r["source_git_sha"] or "-")[0] for r in found] == ["-", "a", "a", "c", "c", "-"]
    assert found[0]["git_sha_provenance"] == "unavailable"


def test_source_names_are_the_allowed_ones():
    assert [s.name for s in EVENT_SOURCES] == ["agent_actions", "farm_supervisor", "navigation"]


def test_fields_are_read_from_a_document_once(spark):
    lines = spark.createDataFrame(
        [("log", "f", 1, b'{"at":"2026-07-30","kind":"0"}\n', "id", "print"), ("log", "f", 2, b'{"at":"2026-07-30T01:00:00+02:00","kind":0}', "id", "print")],
        "source string, source_file string, source_line_number long, raw binary, event_id string, source_fingerprint_sha256 string",
    )
    found = to_envelope(lines, (SourceSpec("log", "*", "at", "kind"),), "s", F.lit(None).cast("timestamp"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.at") == 1
    rows = found.select("event_type", F.unix_seconds("event_time").alias("at")).collect()
    assert sorted(tuple(r) for r in rows) == [("0", 1785369600), ("unknown", 1785366000)]
