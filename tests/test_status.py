"""Reference-list status: defaults, direct observations, staleness, completions, rejects."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leadline.operators.status import entity_status, observer_summary
from leadline.plans.public import watch_tables
from leadline.schemas import COMPLETIONS, empty
from leadline.sources.documents import read_catalog, read_observation

KEYS = [f"target-{n}" for n in range(20)]
SEEN = "2026-07-31T12:00:00+00:00"


def _as_of(hours):
    moment = dt.datetime(2026, 7, 31, 12) + dt.timedelta(hours=hours)
    return F.lit(moment).cast("timestamp")


def _write(path, document):
    path.write_text(json.dumps(document, indent=1), encoding="utf-8")
    return str(path)


@pytest.fixture
def catalog(spark, tmp_path):
    rows = [
        {"nm_key": key, "display_name": key.title(), "zone": "Z", "image_width": 10} for key in KEYS
    ]
    return read_catalog(spark, _write(tmp_path / "catalog.json", {"schema_version": 1, "nms": rows}))


def _observe(spark, tmp_path, rows, **root):
    document = {"schema_version": 1, "observed_at": SEEN, "nms": rows, **root}
    return read_observation(spark, _write(tmp_path / "observation.json", document))


def _by_key(df):
    return {r["nm_key"]: r for r in df.collect()}


def _completions(spark, *rows):
    return spark.createDataFrame(list(rows), COMPLETIONS) if rows else empty(spark, COMPLETIONS)


def test_unknown_without_an_observer(spark, catalog):
    rows = _by_key(entity_status(catalog, None, _completions(spark), _as_of(0)))
    assert set(rows) == set(KEYS)
    assert {r["status"] for r in rows.values()} == {"unknown"}
    assert {r["data_quality"] for r in rows.values()} == {"not_observed"}
    assert {r["placeholder_status"] for r in rows.values()} == {"unknown"}
    assert {r["recorded_defeat_count"] for r in rows.values()} == {0}
    summary = observer_summary(catalog, None, None, _as_of(0)).first().asDict()
    assert summary == {
        "observer_status": "not_configured", "observed_at": None, "map_started_at": None,
        "ruleset_git_sha": None, "tracked_nm_count": 20, "observed_nm_count": 0,
        "refresh_cadence": "hourly",
    }


def test_completions_do_not_imply_a_status(spark, catalog):
    done = _completions(
        spark, ("Target-3", "6", "2026-08-02 21:15:40.125-04"), ("Target-4", "-2", None),
        ("Elsewhere", "1", None), (None, "9", None),
    )
    rows = _by_key(entity_status(catalog, None, done, _as_of(0)))
    row = rows["target-3"]
    assert row["recorded_defeat_count"] == 6
    assert row["last_observed_kill_at"] == "2026-08-03T01:15:40.125000+00:00"
    assert (row["status"], row["data_quality"]) == ("unknown", "recorded_defeat_only")
    assert rows["target-4"]["recorded_defeat_count"] == 0
    assert rows["target-4"]["data_quality"] == "not_observed"


def test_repeated_completions_do_not_multiply_rows(spark, catalog):
    done = _completions(
        spark, ("Target-3", "2", "2026-08-01 00:00:00+00"), ("Target-3", "5", "2026-08-02 00:00:00+00"),
        ("Target-3", "9", None),
    )
    rows = entity_status(catalog, None, done, _as_of(0)).collect()
    assert len(rows) == 20
    assert {r["nm_key"]: r["recorded_defeat_count"] for r in rows}["target-3"] == 5


DIRECT = {
    "nm_key": "target-1", "status": "cooldown_blocked", "cooldown_remaining_seconds": 45,
    "is_spawned": False, "placeholder_status": "dead",
    "last_observed_kill_at": "2026-07-31T10:07:31+00:00", "effective_chance_percent": 35,
}


def test_fresh_observation(spark, catalog, tmp_path):
    root, rows = _observe(spark, tmp_path, [DIRECT], ruleset_git_sha="7c1e55d09ab84f23")
    done = _completions(spark, ("Target-1", "2", "2026-07-31 09:00:00+00"))
    found = _by_key(
        entity_status(catalog, rows, done, _as_of(0.5), F.lit(root.first()["observed_at"]))
    )
    row = found["target-1"]
    assert (row["status"], row["data_quality"]) == ("cooldown_blocked", "direct_map_observation")
    assert row["last_observed_status"] is None and row["observed_at"] == SEEN
    assert (row["placeholder_status"], row["is_spawned"]) == ("dead", False)
    # The recorded completion is older than the observed one.
    assert row["last_observed_kill_at"] == DIRECT["last_observed_kill_at"]
    assert row["recorded_defeat_count"] == 2
    assert found["target-2"]["observed_at"] is None
    summary = observer_summary(catalog, root, rows, _as_of(0.5)).first()
    assert (summary["observer_status"], summary["ruleset_git_sha"]) == ("fresh", "7c1e55d0")
    assert (summary["tracked_nm_count"], summary["observed_nm_count"]) == (20, 1)


@pytest.mark.parametrize("hours, stale", [(2, False), (2.001, True), (3, True), (-1, False)])
def test_staleness(spark, catalog, tmp_path, hours, stale):
    root, rows = _observe(spark, tmp_path, [{"nm_key": "target-5", "status": "cooldown_blocked"}])
    found = watch_tables(catalog, spark.createDataFrame([], "target_name string, event_time timestamp"),
                         (root, rows), _as_of(hours))
    row = _by_key(found["nm_status"])["target-5"]
    if stale:
        assert (row["status"], row["last_observed_status"]) == ("unknown", "cooldown_blocked")
        assert row["data_quality"] == "stale_direct_observation"
    else:
        assert (row["status"], row["last_observed_status"]) == ("cooldown_blocked", None)
    assert found["nm_observer"].first()["observer_status"] == ("stale" if stale else "fresh")
    assert row["placeholder_status"] == "unknown"


@pytest.mark.parametrize(
    "rows, root, message",
    [
        ([{"nm_key": "a", "status": "spawned", "raw_payload": {"x": 1}}], {}, "raw_payload"),
        ([{"nm_key": "a", "status": "spawned"}], {"extra": 1}, "extra"),
        ([{"nm_key": "a", "status": "spawned"}, {"nm_key": "a", "status": "unknown"}], {}, "duplicate"),
        ([{"nm_key": "a", "status": "asleep"}], {}, "invalid status"),
        ([{"nm_key": "", "status": "spawned"}], {}, "no key"),
        ([{"status": "spawned"}], {}, "no key"),
        ([3], {}, "must be objects"),
        ([], {"observed_at": "yesterday"}, "observed_at"),
        ([], {"nms": 5}, "list of rows"),
    ],
)
def test_rejected_observations(spark, tmp_path, rows, root, message):
    with pytest.raises(ValueError, match=message):
        _observe(spark, tmp_path, rows, **root)


def test_unknown_key_is_rejected(spark, catalog, tmp_path):
    seen = _observe(spark, tmp_path, [{"nm_key": "stranger", "status": "spawned"}])
    with pytest.raises(ValueError, match="stranger"):
        watch_tables(catalog, spark.createDataFrame([], "target_name string, event_time timestamp"),
                     seen, _as_of(0))


@pytest.mark.parametrize("keys", [KEYS[:19], [*KEYS[:19], KEYS[0]]])
def test_catalog_must_be_complete_and_unique(spark, tmp_path, keys):
    path = _write(tmp_path / "bad.json", {"nms": [{"nm_key": k} for k in keys]})
    with pytest.raises(ValueError, match="exactly 20"):
        read_catalog(spark, path)
