"""Substring dedup by recompression.

Every round renames the sequence of a document. Runs of one symbol become one symbol; then
each symbol is put on the left or the right by a coin taken from its name, and each left one
followed by a right one becomes a pair symbol. Names are hashes of what they stand for, so
all tasks give the same ones without a dictionary, and equal stretches of words get equal
symbols except near their ends. Every symbol knows which stretch of words decides it; the
highest-level symbol decided inside a window is the window's anchor, the window itself
where there is none. Anchors shared by documents reveal candidates and phrases, and window
hashes verify them (see ``repeats``).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadline.llm.repeats import Parsed, phrases, remove_repeats
from leadline.llm.words import Rolling, combine, mix, words_of

WINDOW_WORDS = 13
BLOCK_BYTES = 4 << 20
_INDEX_BITS = np.uint64(31)
_INDEX = np.uint64((1 << 31) - 1)


class Symbols:
    """One level: names, and the stretch of words [low, high) that decides each."""

    def __init__(self, name: np.ndarray, low: np.ndarray, high: np.ndarray, end: int) -> None:
        self.name, self.low, self.high, self.end = name, low, high, end

    def _before(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(at > 0, values[at - 1], -1)

    def _after(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        beyond = at + 1 >= len(values)
        return np.where(beyond, self.end + 1, values[np.where(beyond, 0, at + 1)])

    def runs(self) -> Symbols:
        """Rows of one symbol become one; both neighbours decide where a row ends."""
        if not len(self.name):
            return self
        first = np.flatnonzero(np.r_[True, self.name[1:] != self.name[:-1]])
        last = np.r_[first[1:], len(self.name)] - 1
        length = (last - first + 1).astype(np.uint64)
        name = np.where(length > 1, combine(self.name[first], length), self.name[first])
        return Symbols(name, self._before(self.low, first), self._after(self.high, last), self.end)

    def pairs(self, level: int) -> Symbols:
        """Left symbols join right ones; an unpaired one is decided by the neighbour it lacks."""
        if not len(self.name):
            return self
        right = (mix(self.name + np.uint64(level)) & np.uint64(1)).astype(bool)
        opens = np.zeros(len(right), bool)
        opens[:-1] = ~right[:-1] & right[1:]
        second = np.zeros(len(right), bool)
        second[1:] = opens[:-1]
        at = np.flatnonzero(~second)
        paired, is_right = opens[at], right[at]
        after = np.minimum(at + 1, len(right) - 1)
        name = np.where(paired, combine(self.name[at], self.name[after]), self.name[at])
        low = np.where(is_right, self._before(self.low, at), self.low[at])
        high = np.where(is_right, self.high[at], self._after(self.high, at))
        return Symbols(name, low, high, self.end)

    def best(self, width: int, windows: int) -> np.ndarray:
        """For each window the symbol of least hash among those decided in it, or -1."""
        starts = np.bincount(self.low + 1, minlength=self.end + 3)
        ends = np.bincount(self.high, minlength=self.end + 3)
        first = np.cumsum(starts)[:windows]  # symbols with low < window start
        last = np.cumsum(ends)[width : width + windows] - 1
        some = last >= first
        chosen = np.full(windows, -1, np.int64)
        at = np.flatnonzero(some)
        if not len(at):
            return chosen
        first, last = first[at], last[at]
        ranks = (mix(self.name) & ~_INDEX) | np.arange(len(self.name), dtype=np.uint64)
        table, span = [ranks], 1
        longest = int((last - first + 1).max())
        while span * 2 <= longest:
            row = table[-1].copy()
            row[:-span] = np.minimum(row[:-span], table[-1][span:])
            table.append(row)
            span *= 2
        stacked = np.concatenate(table)
        step = np.frexp(last - first + 1)[1] - 1
        base = step * len(ranks)
        low = stacked[base + first]
        high = stacked[base + last - (1 << step) + 1]
        chosen[at] = (np.minimum(low, high) & _INDEX).astype(np.int64)
        return chosen


def rounds_for(width: int) -> int:
    """Rounds after which a window still holds symbols that it decides."""
    return max(1, int(math.log2(max(2.0, width / 6))))


def parse_words(texts: list[bytes], width: int) -> Parsed:
    words = words_of(texts)
    total = len(words.name)
    windows = max(0, total - width + 1)
    rolling = Rolling(words.name)
    anchor = combine(rolling.windows(width), np.full(windows, width, np.uint64))
    places = -np.arange(1, windows + 1, dtype=np.int64)
    place = np.arange(total, dtype=np.int64)
    symbols = Symbols(words.name, place, place + 1, total)
    for level in range(1, rounds_for(width) + 1):
        symbols = symbols.runs().pairs(level)
        chosen = symbols.best(width, windows)
        at = np.flatnonzero(chosen >= 0)
        chosen = chosen[at]
        # All words that decide the symbol are part of the anchor: fewer chance meetings.
        around = rolling.between(symbols.low[chosen], symbols.high[chosen])
        anchor[at] = combine(combine(symbols.name[chosen], around), np.full(len(at), level, np.uint64))
        places[at] = chosen + (level << 40)

    def keep(document: int, stays: np.ndarray) -> bytes:
        if stays.all():
            return b" ".join(texts[document].split())
        return b" ".join([words.word(i) for i in words.bounds[document] + np.flatnonzero(stays)])

    return phrases(words.bounds, width, anchor, places, rolling, keep)


def remove_repeated_passages(
    documents: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    width: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Remove words covered by a window that also starts in a document of smaller id.

    Returns ``ident``, n_words, n_removed, spans (removed words [start, end)) and kept_text
    (remaining words joined by one space), one row for each input row.

    * Windows are judged on the input. Words are maximal rows of bytes other than space
      and 0x09-0x0D.
    * Null and empty texts have no words. A null id counts as larger than all others.
      Rows of one id are one document for the comparison of ids. Other columns are ignored.
    * An empty table gives an empty result.
    """

    def parse(texts: list[bytes]) -> Parsed:
        return parse_words(texts, width)

    found = remove_repeats(documents, ident, text, parse, width, True, block_bytes)
    return found.select(
        F.col("id").alias(ident),
        F.col("n_units").alias("n_words"),
        "n_removed",
        "spans",
        F.col("kept").cast("string").alias("kept_text"),
    )
