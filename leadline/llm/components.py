"""Connected components of a graph given as a table of edges, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGES = "a long, b long"
EDGES_PER_TASK = 200_000


def forest(pairs: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Nodes that are not the least of their component among these pairs, and the least."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (above := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[above]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    nodes = [node for node in parent if find(node) != node]
    return nodes, [find(node) for node in nodes]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of edges as stars around the least nodes it connects."""
    for batch in batches:
        nodes, roots = forest(list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)))
        yield pa.record_batch({"a": pa.array(nodes, pa.int64()), "b": pa.array(roots, pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (a long, b long); root is the least node.

    Batches of edges are first reduced to stars, which have fewer edges than nodes. Then each
    round hooks every node to its least neighbour, and edges between different roots form the
    next, smaller graph. Rounds grow with the logarithm of the nodes. A node of very many
    edges is reduced by partial aggregation and joined with one row. Every round is written
    to the checkpoint folder, in as few partitions as EDGES_PER_TASK allows: the last, small
    graphs need no shuffle.
    """
    work = edges.select("a", "b").where("a <> b").mapInArrow(_stars, EDGES).distinct().checkpoint()
    labels = None
    while number := work.count():
        work = work.coalesce(number // EDGES_PER_TASK + 1)
        both = work.unionByName(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy("a").agg(F.min("b").alias("b"))
        step = hooked.select(F.col("a").alias("node"), F.least("a", "b").alias("root")).checkpoint()
        labels = step if labels is None else _follow(labels, step).checkpoint()
        start = step.select(F.col("node").alias("a"), F.col("root").alias("c"))
        end = step.select(F.col("node").alias("b"), F.col("root").alias("d"))
        moved = work.join(start, "a").join(end, "b").where("c <> d").select(F.col("c").alias("a"), F.col("d").alias("b"))
        work = moved.mapInArrow(_stars, EDGES).distinct().checkpoint()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0) if labels is None else labels


def _follow(labels: DataFrame, step: DataFrame) -> DataFrame:
    further = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
    found = labels.join(further, "root", "left")
    return found.select("node", F.coalesce("next", "root").alias("root"))
