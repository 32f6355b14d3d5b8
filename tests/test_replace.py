"""Replacement of the partitions that changed."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from leadline.sinks.tables import replace_partitions

SCHEMA = "day string, v string, n double"


def _files(path):
    return {os.path.join(at, name) for at, _, names in os.walk(path) for name in names if name.startswith("part-")}


def _stored(spark, path):
    return sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).select("day", "v", "n").collect()), key=str)


def test_only_changed_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [("d1", "a", 1.0), ("d1", "a", 1.0), ("d2", None, 2.0), ("a/b c=%", "x", None), (None, "y", 3.0)]

    def run(some):
        plan = replace_partitions(spark.createDataFrame(some, SCHEMA), path, ["day"])
        assert _stored(spark, path) == sorted(some, key=str)
        return {row["day"]: row["action"] for row in plan.collect()}

    assert set(run(rows).values()) == {"written"}
    before = _files(path)
    assert set(run(list(reversed(rows))).values()) == {"kept"} and _files(path) == before
    # One row fewer, a value that moved to another column, a new day, and two that go.
    changed = [("d1", "a", 1.0), ("d2", "2.0", None), ("d3", "n", 0.0)]
    assert run(changed) == {"d1": "written", "d2": "written", "d3": "written", "a/b c=%": "deleted", None: "deleted"}
    assert not {name for name in _files(path) & before if "day=d1" in name}


def test_a_failed_write_leaves_the_table_readable(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [("d1", "a", 1.0), ("d2", "b", 2.0)]
    replace_partitions(spark.createDataFrame(rows, SCHEMA), path, ["day"])
    broken = spark.createDataFrame([("d1", "z", 9.0), ("d2", "z", 8.0)], SCHEMA)
    before = _files(path)
    failing = broken.withColumn("v", F.when(F.col("day") == "d2", F.raise_error(F.lit("no disk"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no disk"):
        replace_partitions(failing, path, ["day"])
    assert _stored(spark, path) == rows and _files(path) == before
