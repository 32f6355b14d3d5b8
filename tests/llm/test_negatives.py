"""Hard negatives against brute force, and how far the lists are read."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadline.llm.hard_negatives import Lists, mine_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, anchor_id string, score double"


def _taken(rows):
    for ident, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        yield ident, label, [max(-(1 << 24), min(1 << 24, math.floor(256 * float(np.float32(x))))) for x in vector]


def _expected(rows, every=5):
    rows = list(_taken(rows))
    order = lambda pair: (-pair[1], math.inf if pair[0] is None else pair[0])
    out = []
    for place, (ident, label, vector) in enumerate(rows):
        if ident is None or ident % every:
            continue
        scored = [
            (other[0], sum(a * b for a, b in zip(vector, other[2])), other[1]) for i, other in enumerate(rows) if i != place
        ]
        near = sorted(((i, s) for i, s, other in scored if other == label), key=order)[:5]
        for positive, top in near:
            far = [(i, s) for i, s, other in scored if other != label and 30 * top <= 100 * s <= 90 * top]
            out += [(ident, positive, rank, i, top, s) for rank, (i, s) in enumerate(sorted(far, key=order)[:10], 1)]
    return out


def _found(spark, rows, block_rows):
    frame = spark.createDataFrame([(*row, "clash", 0.0) for row in rows], SCHEMA)
    mined = mine_negatives(frame, F.col("vec_id") % 5 == 0, block_rows=block_rows)
    assert mined.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return [tuple(row) for row in mined.collect()]


def _same(found, expected):
    key = lambda row: tuple(-1 if x is None else x + 1 for x in row)
    assert sorted(found, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_against_brute_force(spark, block_rows):
    rng = random.Random(block_rows)
    rows = [(i, rng.randrange(3), [rng.gauss(0.2, 0.3) for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, i % 2, [0.25, 0.25, 0.0, 0.0]) for i in range(30)]  # ties
    rows += [(200, 1, [0.0, 0.0, 0.0, 0.0]), (205, 2, []), (206, 2, [0.5, 0.5])]
    rows += [(300, None, [1.0] * 4), (301, 1, None), (302, 1, [1.0, None, 0.0, 0.0])]
    rows += [(305, 1, [math.nan] * 4), (306, 1, [math.inf, 0.0, 0.0, 0.0]), (None, 1, [0.3] * 4), (None, 0, [0.3] * 4)]
    _same(_found(spark, rows, block_rows), _expected(rows))


def test_repeated_rows_count_as_rows(spark):
    rows = [(5, 0, [0.5, 0.1])] * 3 + [(6, 0, [0.5, 0.2])] * 2 + [(7, 1, [0.3, 0.1])] * 14 + [(8, 1, [0.29, 0.0])]
    _same(_found(spark, rows, 4), _expected(rows))


def test_huge_components_and_empty_table(spark):
    rows = [(0, 0, [1e30, -1e30]), (5, 0, [1e30, -1e30]), (1, 1, [1e30, 1.0]), (2, 1, [-1e30, 0.0])]
    _same(_found(spark, rows, 2), _expected(rows))
    assert _found(spark, [], 2) == []


def test_lists_stop_early_and_lose_nothing():
    """The threshold ends the search long before all rows are fetched where values are skewed."""
    rng = np.random.default_rng(0)
    vectors = (256 * rng.pareto(2.0, (4000, 3))).astype(np.int64)
    lists = Lists(np.arange(4000), np.zeros(4000, np.int64), np.ones(4000, np.int64), list(vectors))
    for anchor in (np.array([3, 1, 2]), np.array([3, -1, 2]), np.array([0, 5, 0]), np.array([0, 0, 0])):
        scores = vectors @ anchor
        top = np.lexsort((np.arange(4000), -scores))
        low, high = int(scores[top[300]]), int(scores[top[5]])
        rows, values, fetched = lists.best(anchor, lists.copies, [low, scores.min()], [high, scores.max()], 10)
        wanted = set(top[:10]) | set([i for i in top if low <= scores[i] <= high][:10])
        assert set(rows) == wanted and (values == scores[rows]).all()
        assert fetched < 2000 or not anchor.any()
