"""Conversation repair against enumeration of all edits, and its handling of odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from leadline.llm import turn_repair
from leadline.llm.turn_repair import cheapest, damage, edited, repair_conversations, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string, Turn_2 string, audit string"


def _enumerated(codes: str) -> tuple[int, str]:
    """Cheapest and least audit among all with at most two inserts at each place."""
    best = None
    for edits in product("DKR", repeat=len(codes)):
        for inserts in product(range(3), repeat=len(codes) + 1):
            roles, cost, audit, legal = "", 0, "", True
            for i in range(len(codes) + 1):
                for _ in range(inserts[i]):
                    roles += "a" if roles[-1:] == "u" else "u"
                    cost, audit = cost + 5, audit + "I"
                if i == len(codes):
                    break
                code, edit = codes[i], edits[i]
                audit += edit
                if edit == "D":
                    cost += 2
                    continue
                legal &= code != "!"
                roles += code.lower() if edit == "K" else "a" if roles[-1:] == "u" else "u"
                cost += (5 if code.isupper() else 0) + (edit == "R")
            if legal and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_cheapest_against_all_audits(length):
    for codes in product("suaxSUAX!", repeat=length):
        codes = "".join(codes)
        assert cheapest(codes, 0, (0, 3), True) == _enumerated(codes), codes


def test_cheapest_against_all_audits_of_longer_rows():
    rng = random.Random(3)
    for _ in range(25):
        codes = "".join(rng.choices("suaxUA!", k=4))
        assert cheapest(codes, 0, (0, 3), True) == _enumerated(codes), codes


def test_segments_give_the_same_repair(monkeypatch):
    """A conversation read in short segments equals the one read whole."""
    rng = random.Random(5)
    for round_ in range(30):
        rows = [
            (t, rng.choice([0, 0, 0, 1, 2, 3]), rng.choice(["system", "user", "assistant", "", "tool"]), f"words {t}")
            for t in range(rng.randint(1, 60))
        ]
        found = []
        for size in (10**6, 1 + round_ % 7):
            monkeypatch.setattr(turn_repair, "SEGMENT_ROWS", size)
            conversation = turn_repair._Conversation()
            for row in rows:
                conversation.add(*row)
            found.append(conversation.finish())
        assert found[0] == found[1]


def _expected(rows):
    """Plain reading of the rules for the rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        if not bare:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("fine" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    codes = ""
    for (_, role, _), fault in zip(rows, faults):
        code = role[:1] if role[:1] in ("s", "u", "a") else "x"
        codes += "!" if fault in ("blank", "duplicate") else code.upper() if fault == "truncated" else code
    cost, audit = _enumerated(codes)
    lines = [f"{r}:{t}" for _, r, t in edited(audit, 0, [(r, t) for _, r, t in rows])]
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(pair not in ("su", "ua", "au") for pair in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


ROWS = [
    (1, 0, "system", "Be short."), (1, 1, "user", "Why?"), (1, 2, "assistant", "Because"), (1, 9, "user", "Why?"),
    (2, 0, "user", "Hm."), (2, 0, "user", "Hm."), (2, None, "assistant", "First."),
    (None, 0, "user", None), (None, None, None, "No role."),
    (3, 0, "", "Empty role."), (3, 1, "assistant", " \t "),
    (4, None, "user", None), (4, None, "user", "Twice?"),
    (5, 0, "user", "a. " * 50_000), (5, 1, "assistant", "b" * 200_000),
]


def test_faults_and_repair(spark):
    frame = spark.createDataFrame([(*row, "other", "clash") for row in ROWS], SCHEMA)
    found = {r.conv_id: r.asDict() for r in repair_conversations(frame).collect()}
    assert len(found) == len({row[0] for row in ROWS})
    for ident, row in found.items():
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in ROWS if c == ident]
        assert row == {"conv_id": ident, **_expected(own)}


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(12) for t in range(5)] + [(None, None, None, None)]
    frame = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)
    found = [tuple(r) for r in damage(frame).collect()]
    wanted = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        wanted += [(c, t, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    key = lambda row: tuple(map(str, row))
    assert sorted(found, key=key) == sorted(wanted, key=key)
    assert {row[4] for row in found} == {True, False}


def test_conversations_that_vanish_and_empty_tables(spark):
    frame = spark.createDataFrame([(7, 0, "user", "Gone.", "x", "y")], SCHEMA)
    row = repair_conversations(frame, gone=F.lit(True)).first()
    assert row.conv_id == 7 and row.audit == "" and row.cost == row.gaps == 0
    assert row.repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert repair_conversations(damage(frame.limit(0)), gone=F.col("gone")).collect() == []


def test_repaired_turns(spark):
    frame = spark.createDataFrame([(*row, "other", "clash") for row in ROWS], SCHEMA)
    repaired = repair_conversations(frame)
    turns = repaired_turns(frame, repaired).collect()
    for row in repaired.collect():
        own = sorted((r for r in turns if r.conv_id == row.conv_id), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own)))
        text = "\n".join(f"{r.role}:{r.text}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == row.repaired_sha256
        assert [r.edit for r in own] == [e for e in row.audit if e != "D"]
        assert all((r.turn is None) for r in own if r.edit == "I")
