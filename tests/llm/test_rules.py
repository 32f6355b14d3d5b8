"""License rules against a plain reading of the same rules."""

from __future__ import annotations

import random
import re

import pytest

from leadline.llm import license_rules
from leadline.llm.license_rules import BASE, all_rules, scan_licenses

SCHEMA = "doc_id long, text string, words string, id string, labels int"
UPPER = str.maketrans(license_rules._UPPER, license_rules._LOWER)


def _read(text):
    """What scan_licenses should say, one rule and one place at a time."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    joined = f" {' '.join(words)} "
    places = []
    for number, rule in enumerate(all_rules()):
        for match in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", joined):
            start = joined[: match.start()].count(" ") - 1
            places.append((start, -(start + match[0].count(" ") + 1), number, rule.label, rule.confidence))
    base = [place for place in places if place[2] < len(BASE)]
    kept = []
    for place in sorted(places):
        if kept and place[1] >= kept[-1][1]:
            continue
        if kept and place[0] < -kept[-1][1]:
            if place[2] < kept[-1][2]:
                kept[-1] = place
            continue
        kept.append(place)
    starts = [place[0] for place in base]
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({place[3] for place in base})),
        ",".join(sorted({place[3] for place in [*base, *kept]})),
        max((place[4] for place in [*base, *kept]), default=0.0),
        [(place[0], -place[1], place[3], place[4]) for place in kept],
    )


def _count(text, phrase):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    wanted = phrase.split()
    return sum(words[k : k + len(wanted)] == wanted for k in range(len(words)))


TEXTS = [
    None, "", " ... ", "no words of that kind here", "MIT", "Under the MIT License.", "under the mit licenses",
    "Licensed under the Apache License, Version 2.0 (the License)", "apache-license/version_2", "CC BY-NC, cc by nc 4.0",
    "cc by nc cc by nc", "cc  by\nnc-sa 4.0", "SPDX-License-Identifier: GPL-3.0-or-later", "the GNU GPL v3 license",
    "released under the terms of the BSD 3-clause license", "All rights reserved. Copyright (c) 2019", "É under the MIT license é",
    "Kelvin under the MIT license", "subject to the ISC licence", "opensource.org/licenses/Zlib", "x11 MIT license",
    "licensed under the terms of the mit license apache license version 2 license", "under the public domain license in the public domain",
    "copyleft " * 300, "word " * 20_000 + "under the MIT license " * 40,
]


def _mixed(seed):
    rng = random.Random(seed)
    parts = [w for rule in rng.sample(all_rules(), 40) for w in re.sub(r"\(\?:|[()?|]|\[.*?\]", " ", rule.pattern).split()]
    parts += ["under", "the", "license", "cc", "by", "nc", "mit", "2", "version", "apache", "gpl", "3", "word"] * 6
    return ["".join(f"{w.title()}{rng.choice(' ,-/')}" for w in rng.choices(parts, k=rng.randint(3, 80))) for _ in range(40)]


def test_rules_are_many_and_gated_by_their_words():
    rules = all_rules()
    assert len(rules) > 300 and len({(rule.label, rule.pattern) for rule in rules}) > 300
    for rule in rules:
        re.compile(rule.pattern)
        example = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", rule.pattern)
        while "(" in example:
            example = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", example)
        example = re.sub(r"\[(.)[^]]*\](?:\{\d\})?|(\w)\?", r"\1\2", example)
        example = " ".join(example.split())
        if re.fullmatch(rule.pattern, example):
            assert rule.keyword in example, rule
            assert any(word in example for word in license_rules.GATE) or re.search("cc.by", example), rule


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_scan(spark, seed):
    texts = [*TEXTS, *TEXTS[5:7]] if seed == 0 else _mixed(seed)
    frame = spark.createDataFrame([(i, text, "w", "i", 1) for i, text in enumerate(texts)], SCHEMA)
    rows = scan_licenses(frame).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        assert tuple(row)[1:8] == _read(text)[:7], text
        assert [tuple(d) for d in row.detections] == _read(text)[7]
        assert row.n_base == sum(_count(text, phrase) for phrase, _ in BASE)


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([], SCHEMA)
    plan = scan_licenses(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("LogicalRDD", ""))
