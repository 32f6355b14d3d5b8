"""Dedup of repeated byte strings by prefix-free parsing.

A rolling hash of ``gram`` bytes triggers a phrase wherever it is the least one of a window
of ``width`` bytes. A phrase is everything that the windows of one trigger cover, so
neighbouring phrases overlap by width - 1 bytes and every window lies in exactly one. The
distinct phrases are the dictionary, the sequence of phrases is the parse. Highly repetitive
text has a small dictionary: a phrase with two occurrences in the parse settles all its
windows at once.

Only dictionary phrases that share their trigger and differ elsewhere are compared suffix by
suffix. Of the order of suffixes just one thing is asked here: which have ``width`` bytes in
common. So the suffixes of the dictionary are sorted by (trigger, hash of their first
``width`` bytes), whose equal neighbours are the suffixes with a common prefix of that
length; positions in the parse carry the answer to all occurrences (see ``repeats``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadline.llm.repeats import Parsed, phrases, remove_repeats
from leadline.llm.words import BYTE_VALUE, Rolling, edges, sliding_min

WINDOW_BYTES = 200
GRAM_BYTES = 32
BLOCK_BYTES = 2 << 20
_PLACE = np.uint64((1 << 31) - 1)


def parse_bytes(texts: list[bytes], width: int, gram: int) -> Parsed:
    bounds = edges([len(text) for text in texts])
    rolling = Rolling(BYTE_VALUE[np.frombuffer(b"".join(texts), np.uint8)])
    grams = rolling.windows(gram)
    ranks = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    places = (sliding_min(ranks, width - gram + 1) & _PLACE).astype(np.int64)

    def keep(document: int, stays: np.ndarray) -> bytes:
        if stays.all():
            return texts[document]
        return np.frombuffer(texts[document], np.uint8)[stays].tobytes()

    return phrases(bounds, width, grams[places], places, rolling, keep)


def remove_repeated_strings(
    documents: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    width: int = WINDOW_BYTES,
    gram: int = GRAM_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Remove bytes covered by a string of ``width`` bytes that starts anywhere else too.

    Returns ``ident``, n_bytes, n_removed, spans (removed bytes [start, end), maximal) and
    kept (binary: a cut may fall inside a character), one row for each input row.

    * Strings are judged on the input, overlaps count, matches never cross rows.
    * Null and empty texts have no bytes; repeated rows are places of their own, whatever
      their id. A null id stays null. Other columns are ignored.
    * An empty table gives an empty result. A text must fit in a task's memory about a
      hundred times over.
    """
    gram = min(gram, width)

    def parse(texts: list[bytes]) -> Parsed:
        return parse_bytes(texts, width, gram)

    found = remove_repeats(documents, ident, text, parse, width, False, block_bytes)
    return found.select(F.col("id").alias(ident), F.col("n_units").alias("n_bytes"), "n_removed", "spans", "kept")
