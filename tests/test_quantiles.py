"""Quantiles equal linear interpolation over all values, bracketed or not."""

from __future__ import annotations

import random

import numpy as np
import pytest

from leadline.operators.quantiles import exact_quantiles

PROBABILITIES = {"p50": 0.5, "p95": 0.95}


@pytest.mark.parametrize("accuracy", [50, 400, 100_000])
@pytest.mark.parametrize("shape", ["spread", "ties", "heavy"])
def test_exact_quantiles(spark, accuracy, shape):
    pick = random.Random(accuracy)
    draw = {
        "spread": lambda: pick.uniform(-1e6, 1e6),
        "ties": lambda: float(pick.randrange(4)),
        "heavy": lambda: 10 ** pick.uniform(-6, 9),
    }[shape]
    rows = [(pick.choice(["hot"] * 8 + ["a", None]), draw(), pick.choice([None, draw()]))
            for _ in range(3000)]
    rows += [("one", 5.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    found = exact_quantiles(df, ["g"], {"x": "x", "y": "y"}, PROBABILITIES, accuracy)
    by_group = {r["g"]: r for r in found.collect()}
    assert set(by_group) == {r[0] for r in rows}
    for group, row in by_group.items():
        for position, name in ((1, "x"), (2, "y")):
            values = [r[position] for r in rows if r[0] == group and r[position] is not None]
            for suffix, p in PROBABILITIES.items():
                got = row[f"{name}_{suffix}"]
                if not values:
                    assert got is None
                else:
                    assert got == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_groups_without_values_are_absent(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "g string, x double")
    found = exact_quantiles(df, ["g"], {"x": "x"}, {"p50": 0.5}).collect()
    assert [(r["g"], r["x_p50"]) for r in found] == [("b", 1.0)]
