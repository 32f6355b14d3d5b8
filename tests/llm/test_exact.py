"""Cuckoo index and exact groups."""

from __future__ import annotations

import hashlib
import random
import re

from leadline.llm.cuckoo import (
    CuckooShard,
    build_index,
    exact_groups,
    index_entries,
    keep_first,
    update_index,
)


def _digest(number):
    return hashlib.sha256(str(number).encode()).digest()


def test_shard_grows_finds_and_deletes():
    shard = CuckooShard(buckets=1)
    rng = random.Random(3)
    held = {}
    for _ in range(4000):
        key, ident = rng.randint(0, 1500), rng.randint(0, 10**6)
        if rng.random() < 0.3:
            assert shard.delete(_digest(key), 1) == (key in held)
            if key in held:
                held[key][1] -= 1
                if not held[key][1]:
                    del held[key]
        else:
            shard.insert(_digest(key), ident, 1)
            old = held.setdefault(key, [ident, 0])
            held[key] = [min(old[0], ident), old[1] + 1]
    assert {d: (i, n) for d, i, n in shard.entries()} == {_digest(k): tuple(v) for k, v in held.items()}
    assert all(shard.find(_digest(k)) >= 0 for k in held) and shard.find(_digest("no")) < 0
    assert CuckooShard.from_row(shard.to_table(0).to_pylist()[0]).entries() == shard.entries()


def test_equal_fingerprints_are_told_apart():
    one = bytes(8) + b"\1\2" + bytes(6) + b"a" * 16
    two = bytes(8) + b"\1\2" + bytes(6) + b"b" * 16
    shard = CuckooShard(4)
    shard.insert(one, 7, 1)
    assert shard.find(two) < 0
    shard.insert(two, 3, 1)
    assert sorted(entry[1] for entry in shard.entries()) == [3, 7]


def test_more_equal_places_than_slots_still_fit():
    # All of these have one fingerprint and one bucket at any size below 2 ** 16.
    keys = [bytes(8) + b"\1\2" + bytes(4) + i.to_bytes(2, "little") + bytes([i]) * 16 for i in range(8)]
    shard = CuckooShard(2)
    for i, key in enumerate(keys):
        shard.insert(key, i, 1)
    assert len(shard.entries()) == 8


def test_index_insert_and_delete(spark):
    rows = spark.createDataFrame([(bytearray(_digest(i % 50)), i, 1) for i in range(200)], "digest binary, id long, n long")
    index = build_index(rows, 3)
    found = {bytes(r.digest): (r.keep_id, r.group_size) for r in index_entries(index).collect()}
    assert found == {_digest(i): (i, 4) for i in range(50)}
    changes = [(bytearray(_digest(i)), 0, -4) for i in range(10)] + [(bytearray(_digest("new")), 9, 2)]
    changed = update_index(index, spark.createDataFrame(changes, "digest binary, id long, n long"), rows.where("id % 50 >= 10"), 3)
    found = {bytes(r.digest): (r.keep_id, r.group_size) for r in index_entries(changed).collect()}
    assert found == {_digest(i): (i, 4) for i in range(10, 50)} | {_digest("new"): (9, 2)}


def test_deleting_the_least_id_leaves_a_live_one(spark):
    kinds = "digest binary, id long, n long"
    rows = [(bytearray(_digest(i % 4)), i, 1) for i in range(12)] + [(bytearray(_digest("hot")), i, 1) for i in range(100, 3000)]
    index = build_index(spark.createDataFrame(rows, kinds), 2)
    gone = {0, 1, 5, 9, 100, 101}
    changes = spark.createDataFrame([(d, i, -1) for d, i, _ in rows if i in gone] + [(bytearray(_digest(2)), 50, 1)], kinds)
    live = [row for row in rows if row[1] not in gone] + [(bytearray(_digest(2)), 50, 1)]
    changed = update_index(index, changes, spark.createDataFrame(live, kinds), 2)
    found = {bytes(r.digest): (r.keep_id, r.group_size) for r in index_entries(changed).collect()}
    assert found == {_digest(0): (4, 2), _digest(2): (2, 4), _digest(3): (3, 3), _digest("hot"): (102, 2898)}


SCHEMA = "doc_id long, text string, digest string, key string, n int"
TEXTS = [(3, "a  b"), (1, "a\tb"), (2, "a b "), (4, None), (5, ""), (6, " "), (None, "a b"), (7, "q"), (7, "q"), (8, "é " * 5000)]


def _frame(spark):
    return spark.createDataFrame([(i, t, "d", "k", 0) for i, t in TEXTS], SCHEMA)


def test_groups(spark):
    groups = {}
    for i, text in TEXTS:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    want = []
    for text, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        used = False
        for i in ids:
            kept = i == least and not used
            used |= kept
            want.append((i, least, len(ids), kept, hashlib.sha256(text.encode()).digest()))
    found = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in exact_groups(_frame(spark)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_kept_rows(spark):
    found = keep_first(_frame(spark))
    assert found.columns == ["doc_id", "text", "digest", "key", "n"]
    assert sorted(r.doc_id for r in found.collect()) == [1, 2, 4, 6, 7, 8]
    nothing = spark.createDataFrame([], SCHEMA)
    assert keep_first(nothing).collect() == [] and exact_groups(nothing).collect() == []
