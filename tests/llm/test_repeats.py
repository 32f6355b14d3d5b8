"""Repeated passages and strings against brute force, over many blocks."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest


from leadline.llm.prefix_free import remove_repeated_strings
from leadline.llm.recompression import remove_repeated_passages

SCHEMA = "doc_id long, text string, block string, id string, kept string"


def _frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, text, "x", "y", "z") for i, text in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def _texts(seed):
    """Texts that share passages, runs, periods, copies and near copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["the"] * 30
    shared = [" ".join(rng.choices(words, k=rng.randint(5, 60))) for _ in range(6)]
    found = ["", None, " ", "the " * 80, "ab" * 300, "ab" * 150, "é" * 150, "the the"]
    for _ in range(40):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 50))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(shared))
        if rng.random() < 0.3:
            parts.append(rng.choice(shared))
        found.append(rng.choice([" ", "\n", "\t \x0b"]).join(parts))
    copy = found[20].split(" ")
    copy[len(copy) // 2] = "changed"
    return [*found, found[15], found[15], " ".join(copy), found[30] + " tail"]


def _passages(texts, ids, width):
    first = {}
    lists = [(text or "").encode().split() for text in texts]
    for i, words in sorted(zip(ids, lists, strict=True)):
        for k in range(len(words) - width + 1):
            first.setdefault(tuple(words[k : k + width]), i)
    result = []
    for i, words in zip(ids, lists, strict=True):
        gone = set()
        for k in range(len(words) - width + 1):
            if first[tuple(words[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = b" ".join(word for k, word in enumerate(words) if k not in gone).decode()
        result.append((i, len(words), len(gone), kept))
    return sorted(result)


@pytest.mark.parametrize("width", [2, 5, 13, 40])
@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_passages(spark, width, block_bytes):
    texts = _texts(width)
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    found = remove_repeated_passages(_frame(spark, texts, ids), width=width, block_bytes=block_bytes).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == _passages(texts, ids, width)
    for row in found:
        assert sum(span.end - span.start for span in row.spans) == row.n_removed


def _strings(texts, width):
    data = [(text or "").encode() for text in texts]
    places = Counter(text[k : k + width] for text in data for k in range(len(text) - width + 1))
    result = []
    for i, text in enumerate(data):
        gone = bytearray(len(text))
        for k in range(len(text) - width + 1):
            if places[text[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        kept = bytes(byte for byte, out in zip(text, gone, strict=True) if not out)
        spans = sum(1 for k, out in enumerate(gone) if out and (k == 0 or not gone[k - 1]))
        result.append((i, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return result


@pytest.mark.parametrize("width, gram", [(20, 8), (60, 16), (200, 32)])
@pytest.mark.parametrize("block_bytes", [500, 1 << 20])
def test_strings(spark, width, gram, block_bytes):
    texts = _texts(width)
    frame = _frame(spark, texts)
    found = remove_repeated_strings(frame, width=width, gram=gram, block_bytes=block_bytes).collect()
    got = sorted(
        (r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found
    )
    assert got == _strings(texts, width)


def test_nothing_and_null_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert remove_repeated_passages(empty).collect() == []
    assert remove_repeated_strings(empty).collect() == []
    text = " ".join(f"v{i}" for i in range(60))
    frame = _frame(spark, [text, text, None], [5, None, None])
    found = sorted(remove_repeated_passages(frame).collect(), key=lambda r: (r.doc_id is None, r.n_words))
    assert [(r.doc_id, r.n_removed) for r in found] == [(5, 0), (None, 0), (None, 60)]
    rows = remove_repeated_strings(frame).collect()
    assert Counter(r.n_removed for r in rows) == {len(text): 2, 0: 1}



def test_one_row_with_a_very_long_text(spark):
    words = [f"x{i % 977}y{i}" for i in range(60_000)]
    frame = _frame(spark, [" ".join(words), " ".join(words[30_000:30_050])])
    found = {r.doc_id: r for r in remove_repeated_passages(frame, block_bytes=10_000).collect()}
    assert found[0].n_removed == 0 and found[1].n_removed == 50
