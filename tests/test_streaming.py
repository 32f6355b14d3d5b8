"""Streams: growing logs, sampled states with flushes on change, tumbling buckets."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import pickle
import random
import time
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadline.config import observer_interval
from leadline.operators.states import to_state_rows
from leadline.sources.specs import SourceSpec
from leadline.sources.stored import bronze
from leadline.streaming import growth
from leadline.streaming.buckets import bucket_totals
from leadline.streaming.growth import _GrowthReader, ingest_stream
from leadline.streaming.states import _FlushOnChange, flush_on_change, observe_states, store_samples

LOGS = (SourceSpec("log", "logs/*.jsonl", "at", "event"),)


def _append(path, *kinds, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("a", encoding="utf-8") as handle:
        for kind in kinds:
            handle.write(json.dumps({"event": kind, "at": "2026-07-30T00:00:00Z"}) + end)


def test_incremental_ingest_restarts(spark, tmp_path):
    root, data, checkpoint = (str(tmp_path / n) for n in ("root", "data", "checkpoint"))

    def run():
        ingest_stream(spark, root, data, checkpoint, version="v", specs=LOGS).awaitTermination()
        if not (tmp_path / "data/bronze").exists():
            return []
        return sorted(
            (r["source_file"], r["source_line_number"], r["event_type"])
            for r in bronze(spark, data).collect()
        )

    (tmp_path / "root").mkdir()
    assert run() == []
    one, two = tmp_path / "root/logs/one.jsonl", tmp_path / "root/logs/two.jsonl"
    _append(one, "a", "b")
    assert run() == [("logs/one.jsonl", 1, "a"), ("logs/one.jsonl", 2, "b")]
    _append(one, "c")
    _append(two, "d")
    expected = [("logs/one.jsonl", 1, "a"), ("logs/one.jsonl", 2, "b"),
                ("logs/one.jsonl", 3, "c"), ("logs/two.jsonl", 1, "d")]
    assert run() == expected
    assert run() == expected


def test_interval_bounds():
    for bad in (1, 4.9, 301):
        with pytest.raises(ValueError):
            observer_interval(bad)
    assert observer_interval() == 60.0 and observer_interval(5) == 5.0


def test_single_sample(spark, tmp_path):
    root, data = tmp_path / "root", str(tmp_path / "data")
    root.mkdir()
    name = "runtime/farm-supervisor/primary.json"

    def sample(n):
        query = observe_states(spark, str(root), data, str(tmp_path / f"c{n}"), once=True)
        query.awaitTermination()

    sample(1)
    assert not (tmp_path / "data").exists()
    path = root / name
    path.parent.mkdir(parents=True)
    path.write_text("[1]")
    sample(2)
    assert not (tmp_path / "data").exists()
    path.write_text(json.dumps({"agent_id": "primary", "lease_id": "l", "counters": {"exp_earned": 5}}))
    sample(3)
    row = bronze(spark, data).first()
    assert (row["source"], row["lease_id"]) == ("state_snapshot", "l")


def test_flush_on_change(spark, tmp_path):
    source = tmp_path / "in"
    schema = "source_file string, observed_at timestamp, document string"

    def add(number, phase):
        row = [("f", dt.datetime(2026, 7, 30, 0, number), json.dumps({"lease_id": "l", "phase": phase}))]
        spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(str(source))

    def released(wanted):
        found = []
        for _ in range(60):
            if (tmp_path / "out/_spark_metadata").exists():
                table = spark.read.schema(schema).parquet(str(tmp_path / "out"))
                found = sorted(r["observed_at"].minute for r in table.collect())
            if len(found) >= wanted:
                break
            time.sleep(0.5)
        return found

    add(0, "idle")
    stream = spark.readStream.schema(schema).parquet(str(source))
    # Timers keep such a query going, so it is stopped rather than awaited.
    query = (
        flush_on_change(stream, 900)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(processingTime="200 milliseconds")
        .start()
    )
    try:
        assert released(1) == [0]  # the first state differs from none
        add(1, "idle")
        add(2, "fight")
        assert released(3) == [0, 1, 2]  # the change lets the held one out too
        for n in (3, 4, 5):
            add(n, "fight")
        time.sleep(3)
        assert released(3) == [0, 1, 2]  # held
        add(6, "fight")  # an hour's worth at 900 s is four samples
        assert released(7) == [0, 1, 2, 3, 4, 5, 6]
    finally:
        query.stop()


class _Calls:
    """States of one document in plain Python; counts what would be round trips."""

    def __init__(self):
        self.n, self.values, self.held, self.timers = 0, {}, [], []

    def getValueState(self, name, _schema):
        return SimpleNamespace(get=lambda: self._call(self.values.get(name)), update=lambda v: self._call(self.values.update({name: v})))

    def getListState(self, _name, _schema):
        return SimpleNamespace(
            get=lambda: iter(self._call(list(self.held))), clear=lambda: self._call(self.held.clear()), appendList=lambda v: self._call(self.held.extend(v))
        )

    def _call(self, value):
        self.n += 1
        return value

    def registerTimer(self, at):
        self._call(self.timers.append(at))

    def deleteTimer(self, at):
        self._call(self.timers.remove(at))

    def listTimers(self):
        return self._call(list(self.timers))


@pytest.mark.parametrize("limit", [3, 10**9])
def test_samples_of_a_batch_cost_few_calls(limit):
    """What goes out is what a plain reading of the rule gives; no call for each sample."""
    rng, handle, processor = random.Random(limit), _Calls(), _FlushOnChange(limit)
    processor.init(handle)
    got, want, held, last, at = [], [], [], None, -(10**15)
    clock = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: 5)
    for size in (1, 1, 1, 200, 1, 2, 1, 1, 1, 150, 3):
        rows = [(at + i, str(at + i), "l", rng.choice("ab") if size > 1 else "a") for i in range(size)]
        at += size
        for micros, text, *state in rows:
            held.append((micros, text))
            if state != last or len(held) >= limit:
                want, held, last = want + held, [], state
        rng.shuffle(rows)
        frame, handle.n = pd.DataFrame(rows, columns=["at", "document", "lease_id", "phase"]), 0
        for passed in processor.handleInputRows(("f",), iter([frame[:70], frame[70:]]), clock):
            got += list(zip(passed["at"].tolist(), passed["document"]))
        assert handle.n <= 10
        assert got == want and len(handle.held) == len(held) and len(handle.timers) == bool(held)


@pytest.mark.parametrize("grain", ["hour", "day", "week"])
def test_buckets_agree_between_stream_and_table(spark, tmp_path, grain):
    rows = [(dt.datetime(2026, 7, 26, 23, 30) + dt.timedelta(hours=7 * i), i) for i in range(60)]
    table = spark.createDataFrame(rows, "at timestamp, v int")
    table.write.parquet(str(tmp_path / "in"))
    totals = {"n": F.count("*"), "total": F.sum("v")}
    batch = {tuple(r) for r in bucket_totals(table, "at", grain, totals).collect()}
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    name = f"buckets_{grain}_{time.time_ns()}"
    query = (
        bucket_totals(stream, "at", grain, totals, late="1 hour")
        .writeStream.format("memory").queryName(name).outputMode("complete").start()
    )
    query.processAllAvailable()
    query.stop()
    assert {tuple(r) for r in spark.table(name).collect()} == batch
    starts = {r[1] for r in batch}
    if grain == "week":
        assert all(start.weekday() == 0 for start in starts)


def test_streams_refuse_links(spark, tmp_path):
    outside = tmp_path / "elsewhere.jsonl"
    _append(outside, "secret")
    (tmp_path / "root/logs").mkdir(parents=True)
    (tmp_path / "root/logs/link.jsonl").symlink_to(outside)
    query = ingest_stream(
        spark, str(tmp_path / "root"), str(tmp_path / "data"), str(tmp_path / "c"), version="v", specs=LOGS
    )
    with pytest.raises(Exception, match="symbolic link"):
        query.awaitTermination()
    assert not (tmp_path / "data/bronze").exists()


def test_documents_have_their_own_identity(spark):
    at = dt.datetime(2026, 8, 1, 5, 0, 0, 250000)
    text = '{"lease_id": "l", "config": {"b": 1.0, "a": NaN}, "b": 1, "b": 2}'
    rows = [("one.json", at, text), ("two.json", at, text), ("bad.json", at, "[1]"), ("worse.json", at, None)]
    frame = spark.createDataFrame(rows, "source_file string, observed_at timestamp, document string")
    found = to_state_rows(frame, F.col("observed_at"), "s" * 40, source_file=F.col("source_file")).collect()
    assert sorted(r["source_file"] for r in found) == ["one.json", "two.json"]
    assert len({r["event_id"] for r in found}) == 2
    stored = json.loads(found[0]["raw_json"])
    assert stored["b"] == 2 and stored["observation_time"] == "2026-08-01T05:00:00.250000+00:00"
    config = '{"a":NaN,"b":1.0}'
    assert stored["configuration_hash"] == hashlib.sha256(config.encode()).hexdigest()


def test_a_repeated_batch_stores_nothing_twice(spark, tmp_path):
    at = dt.datetime(2026, 8, 1, 5)
    rows = [("a.json", at, '{"lease_id":"l"}'), ("b.json", at, '{"lease_id":"l"}')]
    frame = spark.createDataFrame(rows, "source_file string, observed_at timestamp, document string")
    data = str(tmp_path / "data")
    for _ in range(2):
        store_samples(frame, data, None)
    assert bronze(spark, data).count() == 2


def _touched(root, names, text="{}\n"):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def _reader(tmp_path, glob="logs/*/day-?.log"):
    return _GrowthReader(f"file://{tmp_path}/root", [("log", glob)], f"file://{tmp_path}/versions")


def _names(reader, start, end):
    parts = [pickle.loads(pickle.dumps(part)) for part in reader.partitions(start, end)]
    return sorted(row[2] for part in parts for row in reader.read(part)), len(parts)


def test_offsets_have_one_size_whatever_the_number_of_files(tmp_path, monkeypatch):
    monkeypatch.setattr(growth, "FILES_PER_PARTITION", 1000)
    reader, none = _reader(tmp_path, "logs/*.log"), {"version": 0}
    _touched(tmp_path / "root", [f"logs/{i}.log" for i in range(10)])
    few = reader.latestOffset()
    _touched(tmp_path / "root", [f"logs/more-{i}.log" for i in range(10_000)])
    many = reader.latestOffset()
    assert len(json.dumps(few)) == len(json.dumps(many)) and few != many
    assert _names(reader, none, few)[0] == sorted(f"logs/{i}.log" for i in range(10))
    names, parts = _names(reader, few, many)
    assert names == sorted(f"logs/more-{i}.log" for i in range(10_000)) and parts == 10


def test_versions_change_with_the_files_and_can_be_planned_again(tmp_path):
    reader = _reader(tmp_path)
    assert reader.initialOffset() == reader.latestOffset() == {"version": 0}
    _touched(tmp_path / "root", ["logs/a/day-1.log", "logs/b/day-2.log", "logs/b/day-10.log", "logs/day-3.log", "else/a/day-4.log"])
    first = reader.latestOffset()
    assert reader.latestOffset() == first
    assert _names(reader, reader.initialOffset(), first)[0] == ["logs/a/day-1.log", "logs/b/day-2.log"]
    _touched(tmp_path / "root", ["logs/b/day-2.log"], "{}\n{}\n")
    _touched(tmp_path / "root", ["logs/c/day-5.log"])
    # A restarted stream has only the offsets; an interrupted version is not one.
    reader = _reader(tmp_path)
    (tmp_path / "versions" / "000000000009.parquet.new").write_text("torn")
    second = reader.latestOffset()
    assert _names(reader, first, second)[0] == ["logs/b/day-2.log", "logs/c/day-5.log"]
    reader.commit(second)
    assert _names(reader, first, second)[0] == ["logs/b/day-2.log", "logs/c/day-5.log"]
    _touched(tmp_path / "root", ["logs/c/day-6.log"])
    third = reader.latestOffset()
    reader.commit(third)
    assert sorted(p.name for p in (tmp_path / "versions").glob("*.parquet")) == ["000000000002.parquet", "000000000003.parquet"]
