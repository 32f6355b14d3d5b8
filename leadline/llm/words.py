"""Words, their 64-bit names, and hashes of consecutive words, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Words as a Java or RE2 pattern. bytes.split() cuts at exactly the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

PIECE_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all."""
    values = (values ^ (values >> np.uint64(30))) * _MIX1
    values = (values ^ (values >> np.uint64(27))) * _MIX2
    return values ^ (values >> np.uint64(31))


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Name of an ordered pair."""
    return mix(left * _ODD + mix(right + _ODD))


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    if count:
        powers[0] = 1
    return np.multiply.accumulate(powers)


class Rolling:
    """Hashes of arbitrary stretches of a sequence of 64-bit values.

    The hash of a stretch depends on its values alone, not on where it stands.
    """

    def __init__(self, values: np.ndarray) -> None:
        sums = np.cumsum(values * _powers(_BASE, len(values)), dtype=np.uint64)
        self._sums = np.concatenate([np.zeros(1, np.uint64), sums])
        self._back = _powers(_BASE_INVERSE, len(values) + 1)

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._back[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all stretches of this width, from the first position on."""
        count = max(0, len(self._sums) - width)
        return mix((self._sums[width : width + count] - self._sums[:count]) * self._back[:count])


def edges(lengths: list[int]) -> np.ndarray:
    """Where documents of these lengths begin when they stand end to end, and the end."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])


# Bytes that end a word: the six of white space, or all but letters, digits and non-ASCII.
BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
NOT_PLAIN = np.array([c < 48 or 57 < c < 65 or 90 < c < 97 or 122 < c < 128 for c in range(256)])
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


@dataclass
class Words:
    """All words of several texts: names, places in ``data``, and where each text begins."""

    data: bytes
    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def word(self, index: int) -> bytes:
        return self.data[self.start[index] : self.end[index]]


def words_of(texts: list[bytes], lower: bool = False, gap: np.ndarray = BLANK) -> Words:
    """Cut texts into words without a step for each word. A name is a hash of the bytes.

    ``lower`` puts A-Z in lower case.
    """
    data = b" ".join([b"", *texts, b""])
    if lower:
        data = data.lower()
    bytes_ = np.frombuffer(data, np.uint8)
    blank = gap[bytes_]
    turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, end = turns[::2], turns[1::2]
    # Piece by piece, so that memory does not hold several numbers for each byte.
    cuts = np.unique(np.searchsorted(start, np.arange(0, len(data) + PIECE_BYTES, PIECE_BYTES)))
    names = [np.zeros(0, np.uint64)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        begin, stop = start[a], end[b - 1]
        rolling = Rolling(BYTE_VALUE[bytes_[begin:stop]])
        names.append(rolling.between(start[a:b] - begin, end[a:b] - begin))
    name = combine(np.concatenate(names), (end - start).astype(np.uint64))
    begins = edges([len(text) + 1 for text in texts])
    return Words(data, name, start, end, np.searchsorted(start, begins))


def pieces(texts: list[bytes], most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes or one text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and the text of each, in order.

    A text of fewer words than ``size`` has its whole sequence as its only shingle; one
    without words has none.
    """
    bounds = words.bounds
    rolling = Rolling(words.name)
    counts = np.diff(bounds)
    number = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    owner = np.repeat(np.arange(len(counts)), number)
    offset = np.arange(len(owner)) - np.repeat(edges(number)[:-1], number)
    starts = bounds[:-1][owner] + offset
    ends = np.minimum(starts + size, bounds[1:][owner])
    return combine(rolling.between(starts, ends), (ends - starts).astype(np.uint64)), owner


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each begins."""
    hashes, owner = shingles(words, size)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], edges(np.bincount(owner[fresh], minlength=len(words.bounds) - 1))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every stretch of this width, by doubling."""
    if len(values) < width:
        return values[:0]
    span, best = 1, values
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        rest = width - span
        best = np.minimum(best[:-rest], best[rest:])
    return best
