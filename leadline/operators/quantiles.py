"""Exact interpolated quantiles for groups of any size.

The built-in exact ``percentile`` keeps every distinct value of a group in one
task. Here values are counted by (group, value), which combines before the
shuffle; a group above ``accuracy`` rows is first bracketed by an approximate
sketch, and only values inside the bracket keep their identity: all others are
counted into the gaps between brackets. Ranks, and so results, stay exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadline.operators.keys import join_null_safe, large_groups

ACCURACY = 100_000
_BRACKET_STEPS = 5


def _brackets(
    values: DataFrame, groups: list[str], probabilities: list[float], accuracy: int
) -> DataFrame | None:
    """Bounds around each wanted quantile for all large groups; None if there are none."""
    margin = _BRACKET_STEPS / accuracy
    cuts = [
        bound
        for p in probabilities
        for bound in (max(0.0, p - margin), min(1.0, p + margin))
    ]
    large = large_groups(values.select(*groups), groups, accuracy)
    if not large.count:
        return None
    sketched = (
        join_null_safe(values, large.sized(large.groups), groups, "inner")
        .groupBy(*groups)
        .agg(F.percentile_approx("_value", cuts, accuracy).alias("_cuts"))
    )
    return large.sized(sketched, more_bytes=8 * len(cuts))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    probabilities: Mapping[str, float],
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Quantiles of each measure by ``keys``; NULL values take no part.

    ``measures`` is ``{prefix: column}`` and ``probabilities`` ``{suffix: p}``; the
    result has ``<prefix>_<suffix>`` columns. Groups without any value are absent.
    """
    suffixes = sorted(probabilities, key=probabilities.get)
    wanted = [probabilities[suffix] for suffix in suffixes]
    groups = [*keys, "_measure"]
    pairs = F.array(
        *[
            F.struct(F.lit(prefix).alias("m"), F.col(column).cast("double").alias("v"))
            for prefix, column in measures.items()
        ]
    )
    values = (
        df.select(*keys, F.explode(pairs).alias("_pair"))
        .select(*keys, F.col("_pair.m").alias("_measure"), F.col("_pair.v").alias("_value"))
        .filter(F.col("_value").isNotNull())
    )
    brackets = _brackets(values, groups, wanted, accuracy)
    if brackets is None:
        bracketed = values.withColumn("_cuts", F.lit(None).cast("array<double>"))
    else:
        bracketed = join_null_safe(values, brackets, groups, "left")
    # A value outside every bracket is replaced by the upper bound of the bracket
    # below it (NULL below the first) and marked as a gap.
    inside = F.lit(False)
    below = F.lit(None).cast("double")
    for number in range(len(wanted)):
        low, high = F.col("_cuts")[2 * number], F.col("_cuts")[2 * number + 1]
        inside = inside | F.col("_value").between(low, high)
        below = F.when(F.col("_value") > high, high).otherwise(below)
    kept = F.col("_cuts").isNull() | inside
    counted = (
        bracketed.select(
            *groups,
            F.when(kept, F.col("_value")).otherwise(below).alias("_at"),
            (~kept).alias("_gap"),
        )
        .groupBy(*groups, "_at", "_gap")
        .agg(F.count("*").alias("_n"))
    )
    in_order = Window.partitionBy(*groups).orderBy(F.col("_at").asc_nulls_first(), "_gap")
    ranked = counted.withColumns(
        {
            "_upto": F.sum("_n").over(
                in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
            "_total": F.sum("_n").over(Window.partitionBy(*groups)),
        }
    )
    picks = []
    for suffix, p in zip(suffixes, wanted):
        position = F.lit(p) * (F.col("_total") - 1)
        for side, rank in (("low", F.floor(position) + 1), ("high", F.ceil(position) + 1)):
            here = (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)
            value = F.when(
                F.col("_gap"), F.raise_error(F.lit("quantile bracket missed its rank"))
            ).otherwise(F.col("_at"))
            picks.append(F.max(F.when(here, value)).alias(f"_{suffix}_{side}"))
    found = ranked.groupBy(*groups).agg(F.max("_total").alias("_total"), *picks)

    columns = []
    for suffix, p in zip(suffixes, wanted):
        position = F.lit(p) * (F.col("_total") - 1)
        low, high = F.col(f"_{suffix}_low"), F.col(f"_{suffix}_high")
        columns.append((low + (high - low) * (position - F.floor(position))).alias(suffix))
    by_measure = found.select(*groups, *columns)
    wide = [
        F.max(F.when(F.col("_measure") == prefix, F.col(suffix))).alias(f"{prefix}_{suffix}")
        for prefix in measures
        for suffix in suffixes
    ]
    return by_measure.groupBy(*keys).agg(*wide)
