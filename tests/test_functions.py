"""Typing, time and identity rules, one case for each known difference of dialects."""

from __future__ import annotations

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from leadline.functions import (
    age_seconds,
    canonical_json,
    count_or_zero,
    event_digest,
    first_by,
    iso_text,
    json_text,
    last_by,
    parse_iso,
    parse_with_short_offset,
    per_hour,
    ratio,
    seconds_between,
    to_boolean,
    to_double,
    to_int,
    to_long,
    type_json,
    typed_json,
)
from leadline.functions.verdict import error_name, json_object_error

UTC = dt.timezone.utc


def column_of(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row["r"] for row in df.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


def test_text_to_whole_numbers(spark):
    texts = ["7", " 7 ", "1.5", "-1.5", "1e3", "x", "nan", "", None, "9.3e18", "99999999999"]
    assert column_of(spark, texts, "string", to_long) == [
        7, 7, 2, -2, 1000, None, None, None, None, None, 99999999999,
    ]
    assert column_of(spark, ["3", "2.5", "99999999999"], "string", to_int) == [3, 3, None]


def test_text_to_double_and_boolean(spark):
    assert column_of(spark, ["1.5", "x", None], "string", to_double) == [1.5, None, None]
    assert column_of(spark, ["true", "f", "1", "69", None], "string", to_boolean) == [
        True, False, True, None, None,
    ]


def test_count_or_zero(spark):
    assert column_of(spark, ["4", "-3", "x", None], "string", count_or_zero) == [4, 0, 0, 0]


def test_json_text(spark):
    documents = ['{"a":null}', "{}", '{"a":1.50}', '{"a":{"b": [1, 2]}}', '{"a":1,"a":2}']
    found = column_of(spark, documents, "string", lambda c: json_text(c, "$.a"))
    assert found[:3] == [None, None, "1.5"]
    assert json.loads(found[3]) == {"b": [1, 2]}
    assert found[4] == "1"


def test_parsing_once_gives_the_same_texts(spark):
    documents = [
        '{"a":1.50,"b":"x","c":{"y":1,"x":[2, 3]},"d":null,"e":1e3,"f":true}',
        '{"a":NaN,"b":"x"}',
        '{"a":1,"a":2,"b":" [x"}',
        '{"b":"{x","c":[{"z":1,"y":2}]}',
        '{"b":"\u00e9\\n","a":123456789012345678901234567890}',
        "{}",
    ]
    paths = {name: (f"$.{name}", "string") for name in "abcdefgh"}
    df = spark.createDataFrame([(d,) for d in documents], "document string")
    once = type_json(df, "document", paths, ["document"]).collect()
    each = df.select("document", *typed_json(F.col("document"), paths)).collect()
    assert once == each


def test_iso_times(spark):
    texts = [
        "2026-07-30T00:00:00Z",
        "2026-07-30T02:00:00+02:00",
        "2026-07-30T00:00:00",
        "2026-07-30",
        "2026-07-30 00:00:00.000001",
        "2026",
        "nonsense",
        "2026-13-40T00:00:00Z",
        None,
    ]
    midnight = dt.datetime(2026, 7, 30)
    assert column_of(spark, texts, "string", parse_iso) == [
        midnight, midnight, midnight, midnight,
        midnight + dt.timedelta(microseconds=1), None, None, None, None,
    ]


def test_naive_times_are_utc_whatever_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = column_of(
            spark,
            ["2026-07-30T00:00:00", "2026-07-30"],
            "string",
            lambda c: F.unix_seconds(parse_iso(c)),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    expected = int(dt.datetime(2026, 7, 30, tzinfo=UTC).timestamp())
    assert seconds == [expected, expected]


def test_short_offsets(spark):
    texts = ["2026-07-31 09:49:07.663-04", "2026-07-31T09:49:07-04:00", "2026-07-31", "x"]
    found = column_of(spark, texts, "string", parse_with_short_offset)
    assert found == [
        dt.datetime(2026, 7, 31, 13, 49, 7, 663000), dt.datetime(2026, 7, 31, 13, 49, 7), None, None,
    ]
    assert column_of(spark, texts[:2], "string", lambda c: iso_text(parse_with_short_offset(c))) == [
        "2026-07-31T13:49:07.663000+00:00", "2026-07-31T13:49:07+00:00",
    ]


def test_second_boundaries_and_age(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2026, 1, 1, 0, 0, 0, 900000), dt.datetime(2026, 1, 1, 0, 0, 2, 100000))],
        "a timestamp, b timestamp",
    )
    row = df.select(
        seconds_between(F.col("a"), F.col("b")).alias("s"),
        age_seconds(F.col("b"), F.col("a")).alias("age"),
        age_seconds(F.col("a"), F.col("b")).alias("ahead"),
    ).first()
    assert (row["s"], row["age"], row["ahead"]) == (2, pytest.approx(1.2), 0.0)


def test_rates_keep_their_digits(spark):
    df = spark.createDataFrame([(5, 7), (5, 0)], "a bigint, b bigint")
    found = df.select(
        per_hour(F.col("a"), F.col("b")).alias("h"), ratio(F.col("a"), F.col("b")).alias("r")
    ).collect()
    assert found[0]["h"] == 5 * 3600.0 / 7 and found[0]["r"] == 5 / 7
    assert found[1]["h"] is None and found[1]["r"] is None


def test_arg_min_max_skip_missing_values_and_break_ties(spark):
    df = spark.createDataFrame(
        [(1, 1, None), (2, 2, "b"), (2, 3, "c"), (9, 4, None), (None, 5, "z")],
        "t int, id int, v string",
    )
    row = df.agg(
        first_by(F.col("v"), F.col("t"), F.col("id")).alias("first"),
        last_by(F.col("v"), F.col("t"), F.col("id")).alias("last"),
    ).first()
    assert (row["first"], row["last"]) == ("b", "c")


def test_event_digest_matches_plain_sha256(spark):
    df = spark.createDataFrame([("a/é.log", 12, bytearray(b'{"x":1}\n'))], "p string, n long, r binary")
    found = df.select(event_digest(F.col("p"), F.col("n"), F.col("r"))).first()[0]
    plain = hashlib.sha256("a/é.log".encode() + b"\x00" + b"12" + b"\x00" + b'{"x":1}\n')
    assert found == plain.hexdigest()
    other = df.select(event_digest(F.col("p"), F.col("n") + 1, F.col("r"))).first()[0]
    assert other != found


def test_canonical_json(spark):
    df = spark.createDataFrame([(1, None)], "b int, a string")
    text = df.select(canonical_json({"b": F.col("b"), "a": F.col("a")})).first()[0]
    assert text == '{"a":null,"b":1}'


CASES = [
    (b'{"a":1}\n', None),
    (b'{"a":1}\r\n', None),
    (b' {"a": NaN} ', None),
    (b'{"a":1,"a":2}', None),
    (b"{bad\n", "JSONDecodeError"),
    (b"\n", "JSONDecodeError"),
    (b"[1]\n", "ValueError"),
    (b"3", "ValueError"),
    (b'{"a":1} tail', "JSONDecodeError"),
    (b'{"a":"\xff"}', "UnicodeDecodeError"),
]


def test_verdict_on_lines(spark):
    assert [error_name(raw) for raw, _ in CASES] == [error for _, error in CASES]
    found = column_of(spark, [bytearray(raw) for raw, _ in CASES], "binary", json_object_error)
    assert found == [error for _, error in CASES]
