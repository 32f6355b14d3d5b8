"""Hard negatives of anchors by Fagin's threshold algorithm.

Rows lie in blocks. A block sorts its rows by each dimension. An anchor reads the list of a
dimension from its top where its own component is positive and from its bottom where it
is negative; each row that a list shows for the first time is fetched and scored as a whole, in
integers. The components last read, weighted by the anchor's, add up to a threshold that no
unseen row exceeds. A window of scores is done once the threshold falls strictly below its
kth best score (a tie may still have a lesser id), or below its lower end.

Anchors meet every block as a stream behind its rows, so a task holds one block. Two passes:
the best rows of the anchor's label, then for each of them the window of other labels. What
blocks find is merged by Spark, at most k rows for each window and block.

* Rows with a null label or vector, or a null or non-finite component, take no part. A null id
  is no anchor and comes behind all others in ties.
* Equal rows are counted and not repeated: each counts as a row of its own, also among an anchor's
  positives. Vectors of unequal length are compared on the components both have.
* Scaled components beyond ``MOST`` count as ``MOST``, which keeps scores in 64 bits.
* Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
MOST = 1 << 24
BLOCK_ROWS = 4096
MOST_PARTITIONS = 100_000
FIRST_STEP = 16
POSITIVES = 5
NEGATIVES = 10
LAST = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min
_EXACT = float(1 << 53)

# What names an anchor: its id and label, and a hash of its vector for rows that share both.
ANCHOR = ["anchor_id", "anchor_label", "anchor_tag"]


def prepare(rows: DataFrame, ident: str, label: Column, vector: str) -> DataFrame:
    """Rows that take part: ``vec_id``, ``label``, ``vec`` (scaled integers) and ``copies``."""

    def scaled(x: Column) -> Column:
        return F.least(F.greatest(F.floor(SCALE * x.cast("double")), F.lit(-MOST)), F.lit(MOST)).cast("int")

    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.where(label.isNotNull() & F.col(vector).isNotNull() & sound)
        .select(F.col(ident).cast("long").alias("vec_id"), label.alias("label"), F.transform(vector, scaled).alias("vec"))
        # Copies meet where they lie, before any exchange.
        .groupBy("vec_id", "label", "vec")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


class Lists:
    """A block of rows, and its rows in the order of each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray, vectors: list[np.ndarray]) -> None:
        self.ids, self.labels, self.copies = ids, labels, copies
        width = max((len(vector) for vector in vectors), default=0)
        self.rows = np.zeros((len(ids), width), np.int64)
        for row, vector in zip(self.rows, vectors, strict=True):
            row[: len(vector)] = vector
        self.floats = self.rows.astype(np.float64)
        self.largest = float(np.abs(self.floats).max(initial=0.0))
        self.order = np.argsort(self.rows.T, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(self.rows.T, self.order, axis=1)

    def score(self, rows: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
        """Random access: whole rows against the anchor. Floats where they hold the sums exactly."""
        if exact:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.rows[rows] @ anchor

    def best(self, anchor: np.ndarray, copies: np.ndarray, lows: list[int], highs: list[int], k: int) -> tuple:
        """Rows and scores of the first k in each window, and how many rows were fetched.

        ``copies`` says how often each row counts; those with none are never returned.
        """
        count = len(self.ids)
        anchor = anchor[: self.rows.shape[1]]
        wide = self.rows.shape[1] and len(anchor)
        exact = wide and len(anchor) * self.largest * float(np.abs(anchor).max()) < _EXACT
        dims = np.flatnonzero(anchor) if wide else np.zeros(0, np.int64)
        weights = anchor[dims]
        falling = weights > 0
        seen = np.zeros(count, bool)
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        waiting = list(range(len(lows)))
        depth, step, fetched = 0, FIRST_STEP, 0
        while waiting and fetched < count:
            if len(dims):
                upto = min(depth + step, count)
                reach = np.arange(depth, upto)
                places = np.where(falling[:, None], count - 1 - reach[None, :], reach[None, :])
                shown = np.zeros(count, bool)
                shown[self.order[dims[:, None], places]] = True
                fresh = np.flatnonzero(shown & ~seen)
                limit = int((self.sorted[dims, places[:, -1]] * weights).sum())
            else:
                # The zero anchor scores all rows alike, and every list is as good.
                upto, fresh, limit = count, np.arange(count), 0
            seen[fresh] = True
            fetched += len(fresh)
            depth, step = upto, step * 2
            scored = self.score(fresh, anchor, exact) if wide else np.zeros(len(fresh), np.int64)
            able = copies[fresh] > 0
            found.append(fresh[able])
            scores.append(scored[able])
            rows, values = np.concatenate(found), np.concatenate(scores)
            waiting = [w for w in waiting if limit >= lows[w] and not self._full(rows, values, copies, lows[w], highs[w], k, limit)]
        rows, values = np.concatenate(found), np.concatenate(scores)
        chosen = [self._first(rows, values, copies, low, high, k) for low, high in zip(lows, highs, strict=True)]
        at = np.unique(np.concatenate([np.zeros(0, np.int64), *chosen]))
        return rows[at], values[at], fetched

    def _full(self, rows, values, copies, low: int, high: int, k: int, limit: int) -> bool:
        """Whether k rows of this window score strictly above what an unseen one can."""
        inside = (values >= low) & (values <= high) & (values > limit)
        return int(np.minimum(copies[rows[inside]], k).sum()) >= k

    def _first(self, rows, values, copies, low: int, high: int, k: int) -> np.ndarray:
        inside = np.flatnonzero((values >= low) & (values <= high))
        inside = inside[np.lexsort((self.ids[rows[inside]], -values[inside]))]
        before = np.cumsum(np.minimum(copies[rows[inside]], k)) - np.minimum(copies[rows[inside]], k)
        return inside[before < k]


def _vectors(column: pa.ListArray) -> list[np.ndarray]:
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b].astype(np.int64) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


FOUND = "anchor_id long, anchor_label int, anchor_tag long, row_id long, score long, copies long"


def search(rows: DataFrame, anchors: DataFrame, blocks: int, same_label: bool, k: int) -> DataFrame:
    """For each anchor, a superset of its first k rows in each window; k a block at most.

    ``anchors`` has the columns of ``rows`` and the arrays ``lows`` and ``highs``.
    """
    spread = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vec"), F.lit(blocks)).cast("int"))
    every = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    stream = spread.withColumn("side", F.lit(0)).unionByName(every.withColumn("side", F.lit(1)), allowMissingColumns=True)
    parts = min(blocks, MOST_PARTITIONS)
    ordered = stream.select(
        "block", "side", "vec_id", "label", "copies", "vec", "lows", "highs", F.xxhash64("vec").alias("tag")
    )
    ordered = ordered.repartitionById(parts, F.col("block") % parts).sortWithinPartitions("block", "side", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, lists = None, [], None
        for batch in batches:
            numbers, sides = batch.column("block").to_numpy(), batch.column("side").to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(sides) != 0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
                part = batch.slice(start, stop - start)
                if stop == start:
                    continue
                if numbers[start] != block:
                    block, held, lists = numbers[start], [], None
                if sides[start] == 0:
                    held.append(part)
                    continue
                if lists is None:
                    table = pa.Table.from_batches(held, part.schema).combine_chunks() if held else part.slice(0, 0)
                    lists, held = _lists(table), []
                yield from _answers(lists, part, same_label, k)

    return ordered.mapInArrow(run, FOUND)


def _lists(table: pa.Table) -> Lists:
    vec = table.column("vec")
    parts = vec.chunks if isinstance(vec, pa.ChunkedArray) else [vec]
    return Lists(
        table.column("vec_id").fill_null(LAST).to_numpy(),
        table.column("label").to_numpy(),
        table.column("copies").to_numpy(),
        [vector for part in parts for vector in _vectors(part)],
    )


def _answers(lists: Lists, part: pa.RecordBatch, same_label: bool, k: int) -> Iterator[pa.RecordBatch]:
    if not len(lists.ids):
        return
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    columns = [part.column(name).to_pylist() for name in ("vec_id", "label", "tag", "lows", "highs")]
    for ident, label, tag, lows, highs, vector in zip(*columns, _vectors(part.column("vec")), strict=True):
        copies = np.where((lists.labels == label) == same_label, lists.copies, 0)
        if same_label:
            for own in np.flatnonzero((lists.ids == ident) & (lists.labels == label)):
                whole = np.zeros(lists.rows.shape[1], np.int64)
                whole[: len(vector)] = vector[: len(whole)]
                if len(vector) <= len(whole) and (lists.rows[own] == whole).all():
                    copies[own] -= 1
        rows, scores, _ = lists.best(vector, copies, lows, highs, k)
        for column, values in zip(out, (ident, label, tag), strict=False):
            column.append(np.full(len(rows), values, np.int64))
        out[3].append(lists.ids[rows])
        out[4].append(scores)
        out[5].append(copies[rows])
    arrays = [np.concatenate(values) for values in out]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = [name.split()[0] for name in FOUND.split(", ")]
    yield pa.record_batch(
        {
            name: pa.array(values.astype(kind.to_pandas_dtype()), kind, mask=values == LAST if name == "row_id" else None)
            for name, values, kind in zip(names, arrays, kinds, strict=True)
        }
    )


def _repeated(found: DataFrame, most: int) -> DataFrame:
    """A row for each copy, as many as can count."""
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(most)).cast("int")))).drop("copies", "copy")


def _ranked(found: DataFrame, keys: list[str], most: int, rank: str) -> DataFrame:
    """The first rows of each key: higher scores, then lesser ids."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("row_id"))
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= most)


def mine_negatives(
    rows: DataFrame,
    chosen: Column,
    ident: str = "vec_id",
    label: Column | None = None,
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """For each anchor and positive, the hard negatives between 30 and 90 % of its score.

    ``chosen`` is a condition on ``vec_id`` that names the anchors. Returns anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.
    """
    label = F.col("label") if label is None else label
    blocks = max(1, -(-rows.count() // block_rows))
    taken = prepare(rows, ident, label.cast("int"), vector)
    anchors = taken.where(F.coalesce(chosen, F.lit(False)))
    whole = [F.array(F.lit(LEAST)).alias("lows"), F.array(F.lit(LAST)).alias("highs")]
    near = search(taken, anchors.select("*", *whole), blocks, True, positives)
    near = _ranked(_repeated(near, positives), ANCHOR, positives, "place")
    score = F.col("score")
    near = near.select(
        *ANCHOR, "place", F.col("row_id").alias("positive_id"), score.alias("positive_score")
    )
    low, high = F.expr("(3 * positive_score + 9) div 10"), F.expr("(9 * positive_score) div 10")
    windows = (
        near.where("positive_score >= 0")
        .groupBy(*ANCHOR)
        .agg(F.sort_array(F.collect_set(F.struct(low.alias("low"), high.alias("high")))).alias("windows"))
    )
    named = anchors.select(
        F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.xxhash64("vec").alias("anchor_tag"), "vec", "copies"
    )
    asked = named.join(windows, ANCHOR).select(
        F.col("anchor_id").alias("vec_id"),
        F.col("anchor_label").alias("label"),
        "vec",
        "copies",
        F.col("windows.low").alias("lows"),
        F.col("windows.high").alias("highs"),
    )
    far = _repeated(search(taken, asked, blocks, False, negatives), negatives)
    inside = (F.col("score") >= low) & (F.col("score") <= high)
    pairs = _ranked(near.join(far, ANCHOR).where(inside), [*ANCHOR, "place"], negatives, "rank")
    return (
        pairs.join(named.select(*ANCHOR, "copies"), ANCHOR)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("row_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
