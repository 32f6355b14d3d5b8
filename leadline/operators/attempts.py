"""Attempt performance: supervisor counts beside the outcomes of single attempts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.functions import count_where, ratio
from leadline.operators.keys import join_null_safe, reduce_with_label


def attempt_performance(
    events: DataFrame,
    attempts: DataFrame,
    proxy: DataFrame,
    day: str,
    key: str,
    version: str,
    provenance: str,
    place: str,
    place_value: Column,
    event_counts: Mapping[str, Column],
    attempt_count: str,
    outcome: str,
    outcomes: Mapping[str, str],
    success: str,
    success_rate: str,
    averages: Mapping[str, str],
    proxy_count: str,
) -> DataFrame:
    """Supervisor rows by (day, key, version) and attempt rows by (day, version).

    ``outcomes`` is ``{count name: outcome text}``, compared without case. ``proxy``
    rows are counted by (day, version) and the count stands on every row of that day
    and version (NULL versions match each other), so a rollup must take its maximum.
    """
    supervised = reduce_with_label(
        events,
        [day, key, version],
        provenance,
        {name: count_where(condition) for name, condition in event_counts.items()},
        {place: place_value},
    )
    text = F.lower(F.coalesce(outcome, F.lit("")))
    sums = {f"_sum_{name}": F.sum(column) for name, column in averages.items()}
    seen = {f"_seen_{name}": F.count(column) for name, column in averages.items()}
    tried = reduce_with_label(
        attempts,
        [day, version],
        provenance,
        {
            attempt_count: F.count("*"),
            **{name: count_where(text == wanted) for name, wanted in outcomes.items()},
            **sums,
            **seen,
        },
        {},
    ).withColumns(
        {name: ratio(F.col(f"_sum_{name}"), F.col(f"_seen_{name}")) for name in averages}
    )
    tried = tried.drop(*sums, *seen)
    counts = [*event_counts, attempt_count, *outcomes]
    combined = supervised.unionByName(tried, allowMissingColumns=True).fillna(0, counts)
    proxies = proxy.groupBy(day, version).agg(F.count("*").alias(proxy_count))
    # The day joins by plain equality, the version null-safely.
    joined = join_null_safe(combined, proxies.filter(F.col(day).isNotNull()), [day, version], "left")
    return joined.select(
        day,
        key,
        place,
        version,
        provenance,
        *counts,
        ratio(F.col(success), F.col(attempt_count)).alias(success_rate),
        *averages,
        F.coalesce(proxy_count, F.lit(0)).alias(proxy_count),
    )
