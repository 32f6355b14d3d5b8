"""Interval labels, deltas, rollups and the latest sample on literal rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadline.operators import consumer
from leadline.operators.velocity import counter_velocity, velocity_current, velocity_rollup

COUNTERS = {"exp": "exp_earned", "gil": "gil_earned"}
T0 = dt.datetime(2026, 7, 30, 10, 0, 0)
SCHEMA = (
    "event_id string, observed_at timestamp, lease_id string, elapsed bigint, "
    "exp_earned bigint, gil_earned bigint"
)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


ROWS = [
    ("b1", at(0), "base", 10, 1, 1),
    ("b2", at(60), "base", 70, 5, 1),
    ("b3", at(120), "base", 70, 5, 1),
    ("b4", at(120), "base", 80, 6, 1),
    ("b5", at(180), "base", 80, 7, 1),
    ("b6", at(240), "base", 90, 2, 1),
    ("b7", at(240 + 4500), "base", 100, 3, 1),
    ("b8", at(240 + 4500 + 4501), "base", 110, 4, 1),
    ("m1", at(0), "miss", 1, None, 1),
    ("m2", at(60), "miss", 2, 2, 1),
    ("n1", at(0), None, 1, 1, 1),
    ("n2", at(60), None, 2, 2, 2),
]
LABELS = {
    "b1": "baseline_only",
    "b2": "observed_delta",
    "b3": "idle_interval",
    "b4": "invalid_interval",
    "b5": "inconsistent_counter",
    "b6": "counter_reset",
    "b7": "observed_delta",
    "b8": "observation_gap",
    "m1": "unavailable",
    "m2": "observed_delta",
    "n1": "unavailable",
    "n2": "unavailable",
}


@pytest.fixture(params=[2, 100_000])
def velocity(spark, request):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return counter_velocity(
        df, "lease_id", "observed_at", "event_id", "elapsed", COUNTERS, "lease",
        rows_per_slice=request.param,
    )


def test_labels(velocity):
    found = {r["event_id"]: r["metric_quality"] for r in velocity.collect()}
    # A missing earlier counter makes the delta unknown: no condition holds, so the
    # last label applies, with a NULL delta.
    assert found == LABELS


def test_deltas_and_rates(velocity):
    rows = {r["event_id"]: r for r in velocity.collect()}
    good = rows["b2"]
    assert (good["active_seconds"], good["exp_earned_delta"], good["gil_earned_delta"]) == (60, 4, 0)
    assert good["exp_per_active_hour"] == 240.0
    assert good["lease_exp_per_active_hour"] == 5 * 3600.0 / 70
    assert rows["b6"]["exp_earned_delta"] is None and rows["b6"]["lease_exp_earned"] == 2
    assert rows["m2"]["exp_earned_delta"] is None
    assert rows["b4"]["observation_gap_seconds"] == 0


def test_rollup(velocity):
    as_of = F.lit("2026-07-31 00:00:00").cast("timestamp")
    found = velocity_rollup(velocity, "observed_at", COUNTERS, as_of).collect()
    rows = {(r["period_grain"], r["period_start"]): r for r in found}
    assert [r["period_grain"] for r in found] == ["hour", "hour", "day", "week"]
    day = rows[("day", dt.datetime(2026, 7, 30))]
    assert (day["active_seconds"], day["exp_earned"], day["observed_intervals"]) == (71, 5, 3)
    assert day["exp_per_active_hour"] == 5 * 3600.0 / 71
    assert day["is_complete"] and day["period_end"] == dt.datetime(2026, 7, 31)
    week = rows[("week", dt.datetime(2026, 7, 27))]
    assert not week["is_complete"] and week["period_end"] == dt.datetime(2026, 8, 3)
    assert consumer.current_period(velocity_rollup(velocity, "observed_at", COUNTERS, as_of), "week").count() == 1


def test_old_hours_are_dropped_but_days_stay(velocity):
    as_of = F.lit("2026-10-28 10:30:00").cast("timestamp")
    found = velocity_rollup(velocity, "observed_at", COUNTERS, as_of).collect()
    assert [(r["period_grain"], r["period_start"].hour) for r in found] == [
        ("hour", 11), ("day", 0), ("week", 0),
    ]


def test_days_follow_the_session_zone_across_a_clock_change(spark, request):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "select 'x' metric_quality, timestamp '2026-03-08 06:30:00Z' observed_at, "
            "60L active_seconds, 1L exp_earned_delta, 1L gil_earned_delta"
        ).withColumn("metric_quality", F.lit("observed_delta"))
        as_of = F.lit("2026-03-20 00:00:00").cast("timestamp")
        day = velocity_rollup(df, "observed_at", COUNTERS, as_of).filter(
            "period_grain = 'day'"
        )
        seconds = day.select(
            F.unix_seconds("period_end") - F.unix_seconds("period_start")
        ).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == 82_800


def test_current(velocity):
    row = velocity_current(velocity, "observed_at", "event_id", ["observed_at", "lease_exp_earned"]).first()
    assert row["lease_exp_earned"] == 4
