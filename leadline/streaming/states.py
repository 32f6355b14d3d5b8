"""Periodic sampling of state documents, with flushes that notice changes."""

from __future__ import annotations

import os
import time
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone
from typing import Any, Optional
from urllib.parse import urlsplit

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from leadline.config import OBSERVER_INTERVAL_SECONDS, observer_interval, prepare_session
from leadline.functions import json_text
from leadline.functions.verdict import error_name
from leadline.operators.ingest import dedup_new
from leadline.operators.states import STATE_FILE, STATE_SOURCE, to_state_rows
from leadline.schemas import BRONZE
from leadline.sinks.bronze import partition_date, stored_ids, write_bronze
from leadline.sources.documents import MAX_STATE_BYTES
from leadline.sources.files import root_uri

_SAMPLE = "source_file string, observed_at timestamp, document string"
_HOUR_MILLIS = 3_600_000
_WATCHED = ("at", "document", "lease_id", "phase")
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_ROWS_PER_CALL = 10_000  # of what is held, in one message to the JVM


class _Sample(InputPartition):
    def __init__(self, name: str, micros: int):
        self.name = name
        self.micros = micros


class _SampleReader(DataSourceStreamReader):
    """Each trigger is one sample of each document; offsets are sampling times."""

    def __init__(self, root: str, names: Sequence[str]):
        self.root = root
        self.names = names

    def initialOffset(self) -> dict:
        return {"at": 0}

    def latestOffset(self) -> dict:
        return {"at": time.time_ns() // 1000}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [_Sample(name, end["at"]) for name in self.names]

    def _stable(self, name: str) -> Optional[bytes]:
        """The content, unless the file is missing, linked, too large or changing."""
        if urlsplit(self.root).scheme not in ("", "file"):
            files, base = pafs.FileSystem.from_uri(self.root.replace("s3a://", "s3://", 1))
        else:
            files, base = pafs.LocalFileSystem(), urlsplit(self.root).path
            if os.path.islink(f"{base}/{name}"):
                return None
        path = f"{base}/{name}"
        before = files.get_file_info(path)
        if before.type != pafs.FileType.File or not 0 < before.size <= MAX_STATE_BYTES:
            return None
        try:
            with files.open_input_stream(path) as stream:
                content = stream.read()
        except OSError:
            return None
        after = files.get_file_info(path)
        same = (before.size, before.mtime_ns) == (after.size, after.mtime_ns)
        return content if same and len(content) == before.size else None

    def read(self, partition: _Sample) -> Iterator[tuple]:
        content = self._stable(partition.name)
        if content is not None and error_name(content) is None:
            moment = datetime.fromtimestamp(partition.micros / 1e6, timezone.utc)
            yield partition.name, moment, content.decode("utf-8")


class SampledStates(DataSource):
    """Options: ``root``, and ``names`` of documents separated by ``;``."""

    @classmethod
    def name(cls) -> str:
        return "sampled_states"

    def schema(self) -> str:
        return _SAMPLE

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _SampleReader(self.options["root"], self.options["names"].split(";"))


def sampled_states(
    spark: SparkSession, root: str, names: Sequence[str] = (STATE_FILE,)
) -> DataFrame:
    prepare_session(spark)
    spark.dataSource.register(SampledStates)
    return (
        spark.readStream.format("sampled_states")
        .option("root", root_uri(root))
        .option("names", ";".join(names))
        .load()
    )


class _FlushOnChange(StatefulProcessor):
    """Holds the samples of one document until its watched state changes.

    All held samples go out when (lease, phase) differs from what was last flushed,
    when an hour's worth is held, or when an hour has passed. What is held lives in
    the checkpoint, so a stop loses nothing.
    """

    def __init__(self, rows_per_hour: int):
        self.rows_per_hour = rows_per_hour

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.flushed = handle.getValueState("flushed", "lease_id string, phase string")
        self.held = handle.getListState(
            "held", "observed_at timestamp, document string"
        )
        self.count = handle.getValueState("count", "n int")

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        """Each call of a state is a round trip to the JVM, so the samples of a batch wait in
        lists: the states are read once, and told once what is left when the batch ends."""
        (name,) = key
        found, told = self.count.get(), self.flushed.get()
        before = held = found[0] if found else 0
        last = told = tuple(told) if told else None
        samples = [sample for frame in rows for sample in zip(*(frame[column].tolist() for column in _WATCHED))]
        samples.sort(key=lambda sample: sample[0])
        stored, released = before > 0, 0
        for place, (_, _, *watched) in enumerate(samples, 1):
            held += 1
            state = tuple(watched)
            if state != last or held >= self.rows_per_hour:
                last, held, released = state, 0, place
        if released:
            if stored:
                yield self._flush(name)
                self._drop_timers()
            yield _frame(name, samples[:released])
        waiting = samples[released:]
        if waiting and (released or not stored):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + _HOUR_MILLIS)
        for at in range(0, len(waiting), _ROWS_PER_CALL):
            self.held.appendList([(_moment(micros), text) for micros, text, *_ in waiting[at : at + _ROWS_PER_CALL]])
        if last != told:
            self.flushed.update(last)
        if held != before:
            self.count.update((held,))

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        (name,) = key
        yield self._flush(name)
        self.count.update((0,))

    def _drop_timers(self) -> None:
        """The hour starts anew with the next sample that is held."""
        for expiry in list(self.handle.listTimers()):
            self.handle.deleteTimer(expiry)

    def _flush(self, name: str) -> pd.DataFrame:
        held = _frame(name, [(_micros(observed_at), document) for observed_at, document in self.held.get()])
        self.held.clear()
        return held

    def close(self) -> None:
        pass


def _frame(name: str, samples: Sequence[tuple]) -> pd.DataFrame:
    """Samples as they go out; times are microseconds, which pandas keeps for every year."""
    return pd.DataFrame(
        {"source_file": name, "at": [sample[0] for sample in samples], "document": [sample[1] for sample in samples]}
    )


def _moment(micros: int) -> datetime:
    return _EPOCH + timedelta(microseconds=micros)


def _micros(moment: datetime) -> int:
    return (moment.astimezone(timezone.utc) - _EPOCH) // timedelta(microseconds=1)


def flush_on_change(samples: DataFrame, interval_seconds: float) -> DataFrame:
    """Samples, let through in groups by ``_FlushOnChange``; needs the RocksDB store."""
    document = F.col("document")
    keyed = samples.select(
        "source_file",
        F.unix_micros("observed_at").alias("at"),
        document,
        json_text(document, "$.lease_id").alias("lease_id"),
        json_text(document, "$.phase").alias("phase"),
    )
    passed = keyed.groupBy("source_file").transformWithStateInPandas(
        statefulProcessor=_FlushOnChange(max(1, round(3600 / interval_seconds))),
        outputStructType="source_file string, at long, document string",
        outputMode="Append",
        timeMode="ProcessingTime",
    )
    return passed.select("source_file", F.timestamp_micros("at").alias("observed_at"), "document")


def store_samples(samples: DataFrame, data: str, version: Optional[str]) -> None:
    """Store samples whose ids are not stored yet; a repeated batch adds nothing."""
    rows = to_state_rows(samples, F.col("observed_at"), version, source_file=F.col("source_file"))
    rows = rows.select(*BRONZE.names).persist()
    try:
        day = partition_date(F.col("event_time")).alias("day")
        days = [row["day"] for row in rows.select(day).distinct().collect()]
        if days:
            # The same ids lie in the same days.
            known = stored_ids(samples.sparkSession, data, [STATE_SOURCE], days)
            write_bronze(dedup_new(rows, known), data)
    finally:
        rows.unpersist()


def observe_states(
    spark: SparkSession,
    root: str,
    data: str,
    checkpoint: str,
    version: Optional[str] = None,
    interval_seconds: float = OBSERVER_INTERVAL_SECONDS,
    names: Sequence[str] = (STATE_FILE,),
    once: bool = False,
) -> StreamingQuery:
    """Sample state documents every interval (5 to 300 s) into the stored events.

    ``once`` takes a single sample and stops.
    """
    interval = observer_interval(interval_seconds)
    samples = sampled_states(spark, root, names)

    def store(batch: DataFrame, _batch_id: int) -> None:
        store_samples(batch, data, version)

    passed = samples if once else flush_on_change(samples, interval)
    trigger = {"availableNow": True} if once else {"processingTime": f"{interval:g} seconds"}
    return (
        passed.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
