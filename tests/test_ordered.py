"""Sequences cut into slices give the result of the uncut window."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from leadline.operators.ordered import (
    changes,
    in_slices,
    last_known,
    last_known_small,
    latest_per_key,
    latest_row,
    previous_rows,
)

START = dt.datetime(2026, 1, 1)


def _rows(seed: int, n: int = 400):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        key = pick.choice(["hot"] * 6 + ["a", "b", None])
        at = None if pick.random() < 0.03 else START + dt.timedelta(seconds=pick.randrange(200) ** 2)
        rows.append((i, key, at, pick.choice([None, "x", "y", "z"])))
    return rows


def _nulls_last(value):
    return (value is None, value if value is not None else START)


def _ordered(rows):
    return sorted(rows, key=lambda r: (_nulls_last(r[2]), r[0]))


@pytest.mark.parametrize("rows_per_slice", [10, 37, 100_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_previous_rows(spark, rows_per_slice, seed):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, "id int, key string, at timestamp, v string")
    found = previous_rows(
        df, ["key"], "at", "id", {"previous_id": "id", "previous_v": "v"}, rows_per_slice
    ).collect()
    expected = {}
    for key in {r[1] for r in rows}:
        before = (None, None)
        for row in _ordered([r for r in rows if r[1] == key]):
            expected[row[0]] = before
            before = (row[0], row[3])
    assert len(found) == len(rows)
    assert {r["id"]: (r["previous_id"], r["previous_v"]) for r in found} == expected


@pytest.mark.parametrize("rows_per_slice", [10, 100_000])
@pytest.mark.parametrize("keyed", [True, False])
def test_last_known(spark, rows_per_slice, keyed):
    left, right = _rows(3), [r for r in _rows(4, 150)]
    schema = "id int, key string, at timestamp, v string"
    l = spark.createDataFrame(left, schema)
    r = spark.createDataFrame(right, schema).select(
        "key", F.col("at").alias("seen_at"), F.col("id").alias("rid"), F.col("v").alias("rv")
    )
    found = last_known(
        l, r, "at", "seen_at", {"rid": "rid", "rv": "rv"},
        by=["key"] if keyed else [], tie="rid", rows_per_slice=rows_per_slice,
    ).collect()
    assert len(found) == len(left)
    for row in found:
        known = [
            x for x in right
            if row["at"] is not None and x[2] is not None and x[2] <= row["at"]
            and (not keyed or x[1] == row["key"])
        ]
        best = max(known, key=lambda x: (x[2], x[0]), default=(None, None, None, None))
        assert (row["rid"], row["rv"]) == (best[0], best[3])


def test_small_dimension_agrees_with_window(spark):
    left = spark.createDataFrame(_rows(5), "id int, key string, at timestamp, v string")
    commits = [(f"c{i}", r[2]) for i, r in enumerate(_rows(6, 40))]
    right = spark.createDataFrame(commits, "sha string, seen_at timestamp")
    small = last_known_small(left, right, "at", "seen_at", "sha", "sha")
    plan = small._jdf.queryExecution().executedPlan().toString()
    large = last_known(left, right, "at", "seen_at", {"sha": "sha"}, tie="sha")
    assert "BroadcastHashJoin" in plan
    assert {(r["id"], r["sha"]) for r in small.collect()} == {
        (r["id"], r["sha"]) for r in large.collect()
    }
    nothing = last_known_small(left, right.limit(0), "at", "seen_at", "sha", "sha")
    assert nothing.filter("sha IS NOT NULL").isEmpty()


def test_changes_latest(spark):
    rows = [(1, "a", START, "x"), (2, "a", START + dt.timedelta(1), "x"),
            (3, "a", START + dt.timedelta(2), None), (4, "a", START + dt.timedelta(3), None),
            (5, "b", START, "x")]
    df = spark.createDataFrame(rows, "id int, key string, at timestamp, v string")
    assert sorted(r["id"] for r in changes(df, ["key"], "at", "id", ["v"]).collect()) == [1, 3, 5]
    assert {r["id"] for r in latest_per_key(df, ["key"], "at", "id").collect()} == {4, 5}
    assert latest_row(df, "at", "id").first()["id"] == 4


@pytest.mark.parametrize("rows_per_slice", [5, 100_000])
def test_null_ties_are_the_least(spark, rows_per_slice):
    right = spark.createDataFrame(
        [("k", START, "x", "with"), ("k", START, None, "without"), ("n", START, None, "b"), ("n", START, None, "a")],
        "key string, since timestamp, tie string, v string",
    )
    rows = [(i, "kn"[i % 2], START + dt.timedelta(hours=i)) for i in range(40)] + [(90, "k", None)]
    left = spark.createDataFrame(rows, "id int, key string, at timestamp")
    found = last_known(left, right, "at", "since", {"v": "v"}, ["key"], "tie", rows_per_slice).collect()
    assert len(found) == 41
    for row in found:
        assert row["v"] == (None if row["at"] is None else {"k": "with", "n": "b"}[row["key"]])


@pytest.mark.parametrize("rows_per_slice", [2, 100_000])
def test_rows_without_a_time_are_not_all_first_rows(spark, rows_per_slice):
    rows = [(1, "k", START, "v"), (2, "k", None, "v"), (3, "k", None, "v"), (4, "k", None, "v"), (5, "k", None, "w")]
    df = spark.createDataFrame(rows, "id int, key string, at timestamp, v string")
    found = changes(df, ["key"], "at", "id", ["v"], rows_per_slice).collect()
    assert sorted(r["id"] for r in found) == [1, 5]


@pytest.mark.parametrize("shape", ["outlier", "burst", "untimed", "text_ties"])
def test_slices_are_even(spark, shape):
    wanted, rows = 100, []
    for i in range(4000):
        at = START + dt.timedelta(seconds=i)
        if shape == "outlier" and i == 0:
            at = dt.datetime(1970, 1, 1)
        if shape == "burst" and i > 400:
            at = START + dt.timedelta(days=9, microseconds=i)
        if shape in ("untimed", "text_ties"):
            at = None
        rows.append((i, f"{i * 7919 % 4001:06d}", "k", at))
    df = spark.createDataFrame(rows, "id int, name string, key string, at timestamp")
    tie = "name" if shape == "text_ties" else "id"
    order = [F.col("at").asc_nulls_last(), F.col(tie).asc_nulls_last()]
    sliced, rest = in_slices(df, ["key"], order, wanted)
    sizes = [r["n"] for r in sliced.groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 4000 and max(sizes) <= wanted and rest.isEmpty()


def test_a_key_of_a_thousand_slices(spark):
    """Ranges of several slices, keys that share a slice, and small keys beside the large one."""
    rows = spark.range(60_000).select(
        F.col("id"),
        F.when(F.col("id") % 6 < 5, "hot").when(F.col("id") % 600 == 5, F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        F.timestamp_seconds(F.col("id") * 7919 % 60_013).alias("at"),
        (F.col("id") % 11).alias("v"),
    )
    whole = previous_rows(rows, ["key"], "at", "id", {"before": "id"}, 10**6)
    cut = previous_rows(rows, ["key"], "at", "id", {"before": "id"}, 50)
    assert whole.count() == 60_000 and whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty()
    known = rows.where("id % 5 = 1").select("key", F.col("at").alias("since"), F.col("v").alias("tie"), F.col("id").alias("found"))
    options = {"ts": "at", "right_ts": "since", "values": {"found": "found"}, "by": ["key"], "tie": "tie"}
    whole, cut = (last_known(rows, known, **options, rows_per_slice=n) for n in (10**6, 50))
    assert whole.count() == 60_000 and whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty()
