"""Windows that repeat across documents, found through phrases and not window by window.

A parse (see ``recompression`` and ``prefix_free``) gives each window of ``width`` units an
*anchor*: something inside the window that depends on the window's content alone, so equal
windows have equal anchors at equal places. A *phrase* is a longest row of neighbouring
windows with one anchor, with all units those windows cover.

1. Blocks send each distinct (anchor, phrase) once to the bucket of the anchor. A phrase
   that occurs elsewhere settles all its windows; one whose anchor occurs nowhere else is
   settled too. No window hash has been sent so far.
2. What is left are phrases that share an anchor but not all of their content, such as the
   ends of a copied passage. One occurrence of each such phrase sends its window hashes.
3. Blocks mark the windows that repeat, then the units they cover.

The text is shuffled once: the three passes read the same exchange. A phrase is known by 128
bits (anchor and content), a window by 96 (half of its anchor, and content).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadline.llm import blocks as B
from leadline.llm.words import Rolling

WHOLE, EMIT = 1, 2

RESULT = "id long, n_units long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


@dataclass
class Parsed:
    """Units of several documents end to end, and their phrases."""

    bounds: np.ndarray  # where each document's units begin, and the end
    anchor: np.ndarray
    phrase: np.ndarray  # hash of all units of the phrase
    first: np.ndarray  # its first window
    count: np.ndarray  # its windows
    rolling: Rolling
    keep: Callable[[int, np.ndarray], bytes]  # document, units that stay


def phrases(
    bounds: np.ndarray,
    width: int,
    anchors: np.ndarray,
    places: np.ndarray,
    rolling: Rolling,
    keep: Callable[[int, np.ndarray], bytes],
) -> Parsed:
    """Gather windows into phrases: ``anchors`` and their ``places``, one for each window."""
    total = len(places)
    valid = np.ones(total, bool)
    # A window crosses a boundary if it starts in the width - 1 places before it.
    crossing = np.zeros(total + 1, np.int32)
    np.add.at(crossing, np.clip(bounds[1:-1] - width + 1, 0, total), 1)
    np.add.at(crossing, np.clip(bounds[1:-1], 0, total), -1)
    valid = np.cumsum(crossing[:-1]) == 0
    opens = valid.copy()
    if total:
        opens[1:] &= ~(valid[:-1] & (places[1:] == places[:-1]))
    first = np.flatnonzero(opens)
    closes = valid.copy()
    if total:
        closes[:-1] &= ~valid[1:] | opens[1:]
    last = np.flatnonzero(closes)
    return Parsed(
        bounds=bounds,
        anchor=anchors[first],
        phrase=rolling.between(first, last + width),
        first=first,
        count=last - first + 1,
        rolling=rolling,
        keep=keep,
    )


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys in sorted arrays."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    fresh = np.zeros(len(keys[0]), bool)
    fresh[0] = True
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(fresh)


def _spread(starts: np.ndarray, values: np.ndarray, total: int) -> np.ndarray:
    return np.repeat(values, np.diff(np.r_[starts, total]))


class Repeats:
    """``earlier``: a window repeats if a document of smaller id has it too; else if any
    other place has it."""

    def __init__(self, parse: Callable[[list[bytes]], Parsed], width: int, earlier: bool, buckets: int) -> None:
        self.parse, self.width, self.earlier, self.buckets = parse, width, earlier, buckets

    def _read(self, docs: pa.Table) -> tuple[np.ndarray, Parsed, np.ndarray]:
        ids, texts, _ = B.rows_of(docs)
        parsed = self.parse(texts)
        owner = np.searchsorted(parsed.bounds, parsed.first, "right") - 1
        return ids, parsed, ids[owner] if len(ids) else np.zeros(0, np.int64)

    def _classes(self, anchor: np.ndarray, content: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
        """Order of entries, starts of classes in it, and what each class tells of itself."""
        order = np.lexsort((doc, content, anchor))
        starts = _groups(anchor[order], content[order])
        tells = doc[order][starts] if self.earlier else np.diff(np.r_[starts, len(order)])
        return order, starts, tells

    def send_phrases(self, docs: pa.Table) -> pa.Table:
        _, parsed, doc = self._read(docs)
        order, starts, tells = self._classes(parsed.anchor, parsed.phrase, doc)
        first = order[starts]
        return B.pack(
            "bucket",
            docs.column("block")[0].as_py(),
            B.buckets_of(parsed.anchor[first], self.buckets),
            [parsed.anchor[first], parsed.phrase[first], tells],
        )

    def settle_phrases(self, sent: pa.Table) -> pa.Table:
        anchor, phrase, tells = B.joined(sent, 0, np.uint64), B.joined(sent, 1, np.uint64), B.joined(sent, 2)
        block, number = B.numbered(sent)
        order = np.lexsort((block, tells, phrase, anchor) if self.earlier else (block, phrase, anchor))
        anchor, phrase, tells = anchor[order], phrase[order], tells[order]
        total = len(order)
        classes = _groups(anchor, phrase)
        of_anchor = _groups(anchor[classes])
        several = np.diff(np.r_[of_anchor, len(classes)]) > 1
        if self.earlier:
            least = tells[classes]
            if total:
                several &= np.minimum.reduceat(least, of_anchor) < np.maximum.reduceat(least, of_anchor)
            value = _spread(classes, least, total)
            whole, teller = value < tells, value == tells
        else:
            value = np.zeros(total, np.int64)
            count = np.add.reduceat(tells, classes) if total else tells
            if total:
                several &= np.minimum.reduceat(count, of_anchor) == 1
            whole = _spread(classes, count, total) > 1
            teller = np.zeros(total, bool)
            teller[classes] = True
        emit = teller & _spread(classes, _spread(of_anchor, several, len(classes)), total)
        flags = (whole * WHOLE + emit * EMIT).astype(np.int64)
        told = np.flatnonzero(flags)
        return B.pack(
            "block",
            sent.column("bucket")[0].as_py(),
            block[order][told],
            [number[order][told], value[told], flags[told]],
        )

    def _told(self, parsed: Parsed, doc: np.ndarray, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Phrases settled as a whole, and those whose windows must be told apart."""
        told = told.filter(pa.compute.equal(told.column("kind"), 0))
        order, starts, tells = self._classes(parsed.anchor, parsed.phrase, doc)
        first = order[starts]
        sent = B.Sent(B.buckets_of(parsed.anchor[first], self.buckets))
        answered = sent.entries(told.column("bucket").to_pylist(), B.unpack(told, 0))
        flags, value = np.zeros(len(starts), np.int64), tells.copy()
        flags[answered] = B.joined(told, 2)
        value[answered] = B.joined(told, 1)
        total = len(order)
        of = np.empty(total, np.int64)
        of[order] = _spread(starts, np.arange(len(starts)), total)
        emits = (flags & EMIT) > 0
        if self.earlier:
            return value[of] < doc, np.flatnonzero(emits[of] & (value[of] == doc))
        return ((flags & WHOLE) > 0)[of], np.sort(first[emits])

    def _windows(self, parsed: Parsed, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, hashes and phrases of the windows of these phrases."""
        counts = parsed.count[chosen]
        of = np.repeat(chosen, counts)
        skip = np.repeat(np.cumsum(counts) - counts, counts)
        starts = parsed.first[of] + np.arange(len(of)) - skip
        return starts, parsed.rolling.between(starts, starts + self.width), of

    def send_windows(self, docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return B.pack("bucket", 0, np.zeros(0, np.int64), [np.zeros(0, np.int64)] * 3)
        _, parsed, doc = self._read(docs)
        _, hashes, of = self._windows(parsed, self._told(parsed, doc, told)[1])
        anchor = parsed.anchor[of]
        order, starts, tells = self._classes(anchor, hashes, doc[of])
        first = order[starts]
        return B.pack(
            "bucket",
            docs.column("block")[0].as_py(),
            B.buckets_of(hashes[first], self.buckets),
            [(anchor[first] >> np.uint64(32)).astype(np.int64), hashes[first], tells],
        )

    def settle_windows(self, sent: pa.Table) -> pa.Table:
        anchor, hashes, tells = B.joined(sent, 0), B.joined(sent, 1, np.uint64), B.joined(sent, 2)
        block, number = B.numbered(sent)
        order = np.lexsort((tells, hashes, anchor))
        tells, total = tells[order], len(order)
        classes = _groups(anchor[order], hashes[order])
        if self.earlier:
            repeated = _spread(classes, tells[classes], total) < tells
        else:
            count = np.add.reduceat(tells, classes) if total else tells
            repeated = _spread(classes, count, total) > 1
        told = np.flatnonzero(repeated)
        return B.pack("block", sent.column("bucket")[0].as_py(), block[order][told], [number[order][told]] * 3)

    def remove(self, docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table(
                {
                    "id": pa.array([], pa.int64()),
                    "n_units": pa.array([], pa.int64()),
                    "n_removed": pa.array([], pa.int64()),
                    "spans": pa.array([], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    "kept": pa.array([], pa.binary()),
                }
            )
        ids, parsed, doc = self._read(docs)
        whole, chosen = self._told(parsed, doc, told)
        total = int(parsed.bounds[-1])
        cover = np.zeros(total + 1, np.int32)
        np.add.at(cover, parsed.first[whole], 1)
        np.add.at(cover, (parsed.first + parsed.count - 1 + self.width)[whole], -1)
        starts, hashes, of = self._windows(parsed, chosen)
        order, groups, tells = self._classes(parsed.anchor[of], hashes, doc[of])
        first = order[groups]
        answers = told.filter(pa.compute.equal(told.column("kind"), 1))
        sent = B.Sent(B.buckets_of(hashes[first], self.buckets))
        repeated = np.zeros(len(groups), bool)
        repeated[sent.entries(answers.column("bucket").to_pylist(), B.unpack(answers, 0))] = True
        hit = np.empty(len(of), bool)
        hit[order] = _spread(groups, repeated, len(order))
        if self.earlier:
            # The bucket tells of smaller ids elsewhere; the least may be one of this block.
            least = np.empty(len(of), np.int64)
            least[order] = _spread(groups, tells, len(order))
            hit |= least < doc[of]
        np.add.at(cover, starts[hit], 1)
        np.add.at(cover, starts[hit] + self.width, -1)
        gone = np.cumsum(cover[:-1]) > 0
        units, removed, spans, kept = [], [], [], []
        for i in range(len(ids)):
            mine = gone[parsed.bounds[i] : parsed.bounds[i + 1]]
            units.append(len(mine))
            removed.append(int(np.count_nonzero(mine)))
            turns = np.flatnonzero(np.diff(np.r_[False, mine, False])) if removed[-1] else mine[:0]
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2], strict=True)])
            kept.append(parsed.keep(i, ~mine))
        return pa.table(
            {
                "id": B.id_column(ids),
                "n_units": pa.array(units, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()),
            }
        )


def remove_repeats(
    frame: DataFrame,
    ident: str,
    text: str,
    parse: Callable[[list[bytes]], Parsed],
    width: int,
    earlier: bool,
    block_bytes: int,
) -> DataFrame:
    """Columns of RESULT, one row for each input row."""
    blocks = B.count_blocks(frame, text, block_bytes)
    job = Repeats(parse, width, earlier, blocks)
    docs = B.in_blocks(frame, ident, text, blocks)
    told = (
        docs.groupBy("block")
        .applyInArrow(lambda table: job.send_phrases(table), B.packed_schema("bucket", 3))
        .groupBy("bucket")
        .applyInArrow(lambda table: job.settle_phrases(table), B.packed_schema("block", 3))
        .withColumn("kind", F.lit(0))
    )
    told_windows = (
        docs.groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInArrow(lambda docs, told: job.send_windows(docs, told), B.packed_schema("bucket", 3))
        .groupBy("bucket")
        .applyInArrow(lambda table: job.settle_windows(table), B.packed_schema("block", 3))
        .withColumn("kind", F.lit(1))
    )
    return (
        docs.groupBy("block")
        .cogroup(told.unionByName(told_windows).groupBy("block"))
        .applyInArrow(lambda docs, told: job.remove(docs, told), RESULT)
    )
