"""Benchmark decontamination: which documents contain a test item.

An item is found in a document that holds at least ``least`` of the item's distinct
shingles. Items are partitioned by size. Each keeps its k minimum hashes, where k is one
more than the shingles that may be missing: a document with enough of the item cannot lack
all k of them, so the search misses nothing, however long the document. (Banding MinHash
signatures of whole documents would: beside a document of 20,000 words an item of 40 has a
Jaccard similarity of 0.002.) A document too small for a partition skips it, and the
largest minimum of a partition cuts most of the document's hashes before any lookup. Hits
are verified by exact containment of shingle sets.

Items are sent to all tasks in blocks of at most ITEM_WORDS words or one item, so a broadcast
has a bound; a larger benchmark takes more passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadline.llm.words import NOT_PLAIN, pieces, shingle_sets, shingles, words_of

SHINGLE = 5
LEAST_PERCENT = 80
ITEM_WORDS = 1_000_000
PAIRS = "doc_id long, item_id long, n_item long, n_shared long"

def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Least number of shared shingles: percent of the size, rounded up."""
    return -(-sizes * percent // 100)


class ItemIndex:
    """Sets of items, and their minimum hashes by size class."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, bounds: np.ndarray, percent: int) -> None:
        self.ids, self.values, self.bounds = ids, values, bounds
        sizes = np.diff(bounds)
        self.need = needed(sizes, percent)
        self.classes: list[tuple[int, np.uint64, np.ndarray, np.ndarray]] = []
        kind = np.frexp(sizes)[1]
        for number in np.unique(kind[sizes > 0]):
            members = np.flatnonzero(kind == number)
            take = sizes[members] - self.need[members] + 1
            # Each set is sorted, so its first hashes are its minimum ones.
            owner = np.repeat(members, take)
            skip = np.arange(len(owner)) - np.repeat(np.cumsum(take) - take, take)
            least = values[bounds[owner] + skip]
            order = np.argsort(least, kind="stable")
            self.classes.append((int(self.need[members].min()), least.max(), least[order], owner[order]))

    def search(self, texts: list[bytes], size: int) -> Iterator[tuple[int, int, int]]:
        """Document, item and shared shingles of every containment."""
        for start, stop in pieces(texts):
            for document, item, shared in self._search(texts[start:stop], size):
                yield start + document, item, shared

    def _search(self, texts: list[bytes], size: int) -> Iterator[tuple[int, int, int]]:
        hashes, owner = shingles(words_of(texts, lower=True, gap=NOT_PLAIN), size)
        if not len(hashes):
            return
        number = np.bincount(owner, minlength=len(texts))
        pairs = []
        for need, most, least, items in self.classes:
            at = np.flatnonzero((hashes <= most) & (number[owner] >= need))
            start = np.searchsorted(least, hashes[at], "left")
            found = np.searchsorted(least, hashes[at], "right") - start
            hit = np.flatnonzero(found)
            which = np.repeat(start[hit], found[hit])
            which += np.arange(len(which)) - np.repeat(np.cumsum(found[hit]) - found[hit], found[hit])
            pairs.append(np.stack([np.repeat(owner[at[hit]], found[hit]), items[which]], axis=1))
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        known, own = -1, hashes[:0]
        for document, item in np.unique(np.concatenate(pairs), axis=0) if pairs else ():
            if document != known:
                known, own = document, np.unique(hashes[first[document] : first[document + 1]])
            wanted = self.values[self.bounds[item] : self.bounds[item + 1]]
            shared = int(np.isin(wanted, own, assume_unique=True).sum())
            if shared >= self.need[item]:
                yield int(document), int(item), shared


def item_blocks(items: DataFrame, ident: str, text: str, size: int, percent: int) -> Iterator[ItemIndex]:
    """Indexes of bounded size that together hold all items."""
    rows = items.select(F.col(ident).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"))
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    blocks = total // (8 * ITEM_WORDS) + 1
    for block in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("id", "data"), F.lit(blocks)) == block).collect()
        words = words_of([bytes(row.data) for row in mine], lower=True, gap=NOT_PLAIN)
        values, bounds = shingle_sets(words, size)
        ids = np.array([-1 if row.id is None else row.id for row in mine], np.int64)
        yield ItemIndex(ids, values, bounds, percent)


def find_contained(
    documents: DataFrame,
    items: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    item_ident: str = "item_id",
    item_text: str = "text",
    size: int = SHINGLE,
    percent: int = LEAST_PERCENT,
) -> DataFrame:
    """Pairs doc_id, item_id, n_item, n_shared with n_shared at least percent of n_item.

    * Words are rows of letters, digits and characters beyond ASCII, A-Z in lower case. A
      text of fewer words than ``size`` is one shingle; one without words, or null, has none:
      such an item is found nowhere and such a document contains nothing.
    * Repeated rows give repeated pairs; a null document id stays null, a null item id is
      -1. Other columns are ignored. Empty tables give no pairs.
    """
    docs = documents.select(
        F.col(ident).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data")
    )
    result = None
    for index in item_blocks(items, item_ident, item_text, size, percent):
        sent = documents.sparkSession.sparkContext.broadcast((index.ids, index.values, index.bounds))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*sent.value, percent)
            for batch in batches:
                rows = list(index.search(batch.column("data").to_pylist(), size))
                item = np.array([row[1] for row in rows], np.int64)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array([row[0] for row in rows], pa.int64())),
                        "item_id": pa.array(index.ids[item]),
                        "n_item": pa.array(np.diff(index.bounds)[item]),
                        "n_shared": pa.array([row[2] for row in rows], pa.int64()),
                    }
                )

        found = docs.mapInArrow(search, PAIRS)
        result = found if result is None else result.unionByName(found)
    return result


def without_contained(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_ident: str = "item_id",
    item_text: str = "text",
    size: int = SHINGLE,
    percent: int = LEAST_PERCENT,
) -> DataFrame:
    """The rows of ``documents`` that contain no item, all columns kept, nothing shuffled."""
    place = [name.lower() for name in documents.columns].index(text.lower())
    kept = documents
    for index in item_blocks(items, item_ident, item_text, size, percent):
        sent = documents.sparkSession.sparkContext.broadcast((index.ids, index.values, index.bounds))

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*sent.value, percent)
            for batch in batches:
                texts = batch.column(place).to_pylist()
                stays = np.ones(len(texts), bool)
                stays[[row[0] for row in index.search([(t or "").encode() for t in texts], size)]] = False
                yield batch.filter(pa.array(stays))

        kept = kept.mapInArrow(clean, documents.schema)
    return kept
