"""Source targets against resharing in turns; copies of documents."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from leadline.llm.mixing import mix_documents, mix_sizes, sizes_of, source_targets

SCHEMA = "doc_id long, text string, source string, rate string, of string, size int"


def _targets(sizes):
    """Share by weight; stop at twice the size; share the excess again until none is above."""
    order = sorted(sizes, key=lambda name: (name is None, name))
    weights = {name: (3, 1, 2)[i % 3] for i, name in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[name] for name in full)
        weight = sum(weights[name] for name in order if name not in full)
        shares = {name: 2 * sizes[name] if name in full else left * weights[name] / weight for name in order}
        above = {name for name in order if name not in full and shares[name] > 2 * sizes[name]}
        if not above:
            return shares
        full |= above


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 10_000, 90_000]) for i in range(rng.randint(1, 9))} | {None: 40, "é": 7}
    rows = [(name, size) for name, size in sizes.items()]
    found = source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    want = _targets(sizes)
    assert {r.source: r.source_size for r in found} == sizes
    for row in found:
        assert math.isclose(row.target, want[row.source], abs_tol=1e-9), row
        assert row.rate <= 2.0


def _documents(spark, rows):
    return spark.createDataFrame([(i, text, source, "r", "o", 3) for i, text, source in rows], SCHEMA)


def _rows():
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "b", "b", "c", None])) for i in range(3000)]
    return [*rows, (3000, None, "a"), (3001, "", "empty"), (None, "x y", "a"), (7, "w   w", "b")]


def test_sizes_and_copies(spark):
    rows = _rows()
    found = mix_sizes(sizes_of(_documents(spark, rows))).collect()
    assert len(found) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = _targets(sizes)

    def copies(row, shift):
        rate = row.target / row.source_size if row.source_size else 0.0
        key = f"mix:{'null' if row.doc_id is None else row.doc_id}"
        drawn = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52 + shift / 32
        return math.floor(rate) + (drawn - (drawn >= 1) < rate - math.floor(rate))

    off = {
        (source, n): abs(sum(r.size * copies(r, n) for r in found if r.source == source) - want[source])
        for source in want
        for n in range(32)
    }
    shift = {source: min(range(32), key=lambda n: (off[source, n], n)) for source in want}
    for row in found:
        assert row.copies == copies(row, shift[row.source])
        assert row.taken == row.size * row.copies <= 2 * row.size
        taken[row.source] += row.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.05 * target + 1


def test_sources_of_few_long_documents_come_near_their_targets(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.2) * 20)), f"s{i % 12}") for i in range(400)]
    found = mix_sizes(sizes_of(_documents(spark, rows))).collect()
    taken, target = defaultdict(int), {}
    for row in found:
        taken[row.source] += row.taken
        target[row.source] = row.target
    assert all(abs(taken[source] - target[source]) <= 0.05 * target[source] for source in target)


def test_documents_of_the_mix(spark):
    documents = _documents(spark, _rows())
    mixed = mix_documents(documents)
    assert mixed.columns == documents.columns
    sizes = mix_sizes(sizes_of(documents)).collect()
    want = Counter()
    for row in sizes:
        if row.copies:
            want[(row.doc_id, row.source)] += row.copies
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == want


def test_empty_tables_and_empty_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mix_documents(none).collect() == [] and mix_sizes(sizes_of(none)).collect() == []
    blank = _documents(spark, [(1, "", "a"), (2, None, None)])
    assert [(r.target, r.taken) for r in mix_sizes(sizes_of(blank)).collect()] == [(0.0, 0)] * 2
    assert mix_documents(blank).collect() == []
