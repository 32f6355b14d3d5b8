"""Document quality from a conditional random field over lines.

Each line has a label, good or bad. Features of a line (its length, its shares of symbols,
capitals, digits, repeated words and so on, in bins), the same features of the lines before
and after it, and the labels of neighbours decide. Labels of documents stand in for labels
of their lines in training. Forward-backward sums give each line's probability of being
good, and their mean weighted by length is the document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.llm.words import BYTE_VALUE, Rolling, combine, pieces, words_of

# Bound of the labelled sample that is fitted: documents, chosen by a hash of their id.
TRAIN_DOCUMENTS = 3000
STEPS = 150
RATE = 0.15
DECAY = 1e-3
THRESHOLD = 0.3
NONE = 7  # bin of a line that is not there
BINS = 8

_BYTES = np.arange(256)
_LETTER = (_BYTES >= 128) | ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122)
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_BLANK = np.isin(_BYTES, list(b" \t\n\x0b\x0c\r"))
_SIMPLE = np.isin(_BYTES, list(b".,;:'\"-?()"))
_SYMBOL = ~(_LETTER | _DIGIT | _BLANK | _SIMPLE)

# Upper ends of bins for each feature; the last bin is open.
EDGES = {
    "words": (1, 3, 8, 20, 60, 200),
    "letters": (0.3, 0.5, 0.65, 0.75, 0.8, 0.85),
    "capitals": (0.0, 0.02, 0.1, 0.3, 0.6, 0.9),
    "digits": (0.0, 0.01, 0.05, 0.15, 0.3, 0.6),
    "symbols": (0.0, 0.005, 0.02, 0.05, 0.1, 0.2),
    "simple": (0.0, 0.005, 0.015, 0.03, 0.06, 0.15),
    "symbol_ends": (0.0, 0.02, 0.1, 0.3, 0.6, 0.9),
    "same_as_last": (0.0, 0.01, 0.05, 0.15, 0.4, 0.8),
    "word_length": (2, 3, 4, 5, 6.5, 9),
    "repeats": (0.0, 0.1, 0.3, 0.5, 0.7, 0.9),
    "line_again": (0.5,),
    "stopped": (0.5,),
}


def _shares(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (sums[end] - sums[start]).astype(np.float64)


def lines_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of every line with words, its length in bytes, and where each text begins."""
    words = words_of(texts)
    data = np.frombuffer(words.data, np.uint8)
    begins = 1 + np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts])])
    cuts = np.unique(np.concatenate([begins, np.flatnonzero(data == 10) + 1]))
    start, end = cuts[:-1], cuts[1:] - 1
    first, last = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
    full = last > first
    start, end, first, last = start[full], end[full], first[full], last[full]
    bounds = np.searchsorted(start, begins)
    length = (end - start).astype(np.float64)
    count = (last - first).astype(np.float64)
    letters = _shares(_LETTER[data], start, end)
    final = data[words.end - 1]
    known = _shares(_SYMBOL[final], first, last)
    same = np.concatenate([[False], words.name[1:] == words.name[:-1]])
    text = np.searchsorted(bounds, np.arange(len(start)), "right").astype(np.uint64)
    line = combine(Rolling(BYTE_VALUE[data]).between(start, end), text)
    _, where, often = np.unique(line, return_inverse=True, return_counts=True)
    # Distinct words of a line: first occurrences of (line, word).
    owner = np.repeat(np.arange(len(start)), last - first)
    # Words outside full lines do not exist: every word lies in a line with words.
    pairs = np.lexsort((words.name, owner))
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[pairs][1:] != owner[pairs][:-1]) | (words.name[pairs][1:] != words.name[pairs][:-1])
    distinct = np.bincount(owner[pairs][fresh], minlength=len(start))
    values = {
        "words": count,
        "letters": letters / length,
        "capitals": _shares(_CAPITAL[data], start, end) / np.maximum(letters, 1),
        "digits": _shares(_DIGIT[data], start, end) / length,
        "symbols": _shares(_SYMBOL[data], start, end) / length,
        "simple": _shares(_SIMPLE[data], start, end) / length,
        "symbol_ends": known / count,
        "same_as_last": _shares(same, first, last) / count,
        "word_length": letters / count,
        "repeats": 1.0 - distinct / count,
        "line_again": (often[where] > 1).astype(np.float64),
        "stopped": np.isin(final[last - 1], list(b".?!")).astype(np.float64),
    }
    bins = np.stack([np.searchsorted(EDGES[name], values[name]) for name in EDGES], axis=1)
    return bins.astype(np.uint8), length, bounds


@dataclass
class Field:
    """Weights of bins (own, before, after), of label pairs (from bad and good), and a prior."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros((3, len(EDGES), BINS)))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    prior: float = 0.5


def _around(bins: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Bins of each line, of the line before it and of the line after it."""
    before, after = np.full_like(bins, NONE), np.full_like(bins, NONE)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    filled = bounds[:-1] < bounds[1:]
    before[bounds[:-1][filled]] = NONE
    after[bounds[1:][filled] - 1] = NONE
    return [bins, before, after]


def _scores(model: Field, around: list[np.ndarray]) -> np.ndarray:
    """How much more good than bad each line looks by its features."""
    total = np.zeros(len(around[0]))
    for place, bins in enumerate(around):
        for kind in range(bins.shape[1]):
            total += model.weights[place, kind][bins[:, kind]]
    return total


def forward_backward(scores: np.ndarray, bounds: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each line is good, and expected numbers of label pairs.

    All texts go forward together, the longest first, so each step is one operation on
    those that still have lines.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    start, left = bounds[:-1][order], sizes[order]
    lines = len(scores)
    good = np.zeros(lines)
    expected = np.zeros((2, 2))
    if not lines:
        return good, expected
    steps = int(left[0])
    alive = np.searchsorted(-left, -np.arange(steps), "left")  # texts with more than t lines
    move = np.exp(pairs)
    looks = np.stack([np.ones(lines), np.exp(np.clip(scores, -30, 30))], axis=1)
    ahead = np.empty((lines, 2))
    for t in range(steps):
        at = start[: alive[t]] + t
        state = looks[at] if t == 0 else (ahead[at - 1] @ move) * looks[at]
        ahead[at] = state / state.sum(axis=1, keepdims=True)
    behind = np.ones((lines, 2))
    for t in range(steps - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        state = (behind[at + 1] * looks[at + 1]) @ move.T
        behind[at] = state / state.sum(axis=1, keepdims=True)
    both = ahead * behind
    good = both[:, 1] / both.sum(axis=1)
    inner = np.ones(lines, bool)
    inner[bounds[:-1][sizes > 0]] = False
    at = np.flatnonzero(inner)
    joint = ahead[at - 1][:, :, None] * move[None] * (looks[at] * behind[at])[:, None, :]
    expected = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return good, expected


def fit(bins: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Field:
    """Maximise the likelihood of the labels by gradient steps with momentum and scaling."""
    model = Field(prior=float(labels.mean()) if len(labels) else 0.5)
    if not len(bins):
        return model
    around = _around(bins, bounds)
    sizes = np.diff(bounds)
    truth = np.repeat(labels.astype(np.float64), sizes)
    # Every document counts as much as its lines, long ones less than in proportion.
    weight = np.repeat(1.0 / np.sqrt(np.maximum(sizes, 1)), sizes)
    stays = np.maximum(sizes - 1, 0)
    seen = np.array([[stays[labels == 0].sum(), 0.0], [0.0, stays[labels == 1].sum()]])
    total = weight.sum()
    slopes = [np.zeros_like(model.weights), np.zeros_like(model.pairs)]
    scales = [np.zeros_like(model.weights), np.zeros_like(model.pairs)]
    for step in range(1, STEPS + 1):
        good, expected = forward_backward(_scores(model, around), bounds, model.pairs)
        off = (truth - good) * weight
        change = np.zeros_like(model.weights)
        for place, held in enumerate(around):
            for kind in range(held.shape[1]):
                change[place, kind] = np.bincount(held[:, kind], weights=off, minlength=BINS)
        changes = [change / total - DECAY * model.weights, (seen - expected) / len(truth) - 10 * DECAY * model.pairs]
        for k, (part, value) in enumerate(zip((model.weights, model.pairs), changes, strict=True)):
            slopes[k] = 0.9 * slopes[k] + 0.1 * value
            scales[k] = 0.99 * scales[k] + 0.01 * value * value
            part += RATE * (slopes[k] / (1 - 0.9**step)) / (np.sqrt(scales[k] / (1 - 0.99**step)) + 1e-8)
    return model


def score_texts(texts: list[bytes], model: Field) -> tuple[np.ndarray, list[np.ndarray]]:
    """Score of each text, and the probability that each of its lines is good."""
    parts = [_score_piece(texts[start:stop], model) for start, stop in pieces(texts)]
    return np.concatenate([np.zeros(0), *(part[0] for part in parts)]), [line for part in parts for line in part[1]]


def _score_piece(texts: list[bytes], model: Field) -> tuple[np.ndarray, list[np.ndarray]]:
    bins, length, bounds = lines_of(texts)
    good, _ = forward_backward(_scores(model, _around(bins, bounds)), bounds, model.pairs)
    sums = np.concatenate([[0.0], np.cumsum(good * length)])
    sizes = np.concatenate([[0.0], np.cumsum(length)])
    whole = sizes[bounds[1:]] - sizes[bounds[:-1]]
    score = np.where(whole > 0, (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(whole, 1), model.prior)
    return np.clip(score, 0.0, 1.0), [good[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def train(
    documents: DataFrame,
    labels: DataFrame,
    chosen: Column,
    ident: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most: int = TRAIN_DOCUMENTS,
) -> Field:
    """Fit on at most ``most`` labelled documents among those where ``chosen`` holds.

    ``chosen`` is a condition on the id. Rows without a label of 0 or 1 teach nothing; of
    repeated labels of one id the greatest counts.
    """
    known = labels.where(chosen & F.col(label).isin(0, 1)).groupBy(ident).agg(F.max(label).alias("good"))
    sample = known.orderBy(F.xxhash64(ident), ident).limit(most).select(F.col(ident).alias("key"), "good")
    # At most `most` rows of two numbers.
    rows = documents.join(F.broadcast(sample), F.col(ident) == F.col("key")).select(
        F.col("key"), "good", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, parts = batch.column("data").to_pylist(), []
            for start, stop in pieces(texts):
                bins, _, bounds = lines_of(texts[start:stop])
                parts += [bins[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.record_batch(
                {"key": batch.column("key"), "good": batch.column("good").cast(pa.int32()), "bins": pa.array(parts, pa.binary())}
            )

    found = rows.mapInArrow(cut, "key long, good int, bins binary").collect()
    found = sorted(found, key=lambda row: (row.key, bytes(row.bins)))
    parts = [np.frombuffer(bytes(row.bins), np.uint8).reshape(-1, len(EDGES)) for row in found]
    bins = np.concatenate([np.zeros((0, len(EDGES)), np.uint8), *parts])
    bounds = np.concatenate([[0], np.cumsum([len(part) for part in parts])]).astype(np.int64)
    return fit(bins, bounds, np.array([row.good for row in found]))


def _model(sent) -> Field:
    return Field(*sent.value)


def score_documents(documents: DataFrame, model: Field, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: ident, score, line_scores (lines with words, in order).

    * Null texts and texts without words have no lines; their score is the share of good
      documents in training. Nothing but the text decides. Repeated rows score alike; other
      columns are ignored. Texts are read in pieces, whole. An empty table gives no rows.
    """
    sent = documents.sparkSession.sparkContext.broadcast((model.weights, model.pairs, model.prior))
    rows = documents.select(
        F.col(ident).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data")
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(sent)
        for batch in batches:
            scores, lines = score_texts(batch.column("data").to_pylist(), own)
            yield pa.record_batch(
                {
                    "id": batch.column("id"),
                    "score": pa.array(scores, pa.float64()),
                    "line_scores": pa.array([line.tolist() for line in lines], pa.list_(pa.float64())),
                }
            )

    found = rows.mapInArrow(score, "id long, score double, line_scores array<double>")
    return found.select(F.col("id").alias(ident), "score", "line_scores")


def keep_good(documents: DataFrame, model: Field, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that score at least ``threshold``, all columns kept."""
    place = [name.lower() for name in documents.columns].index(text.lower())
    sent = documents.sparkSession.sparkContext.broadcast((model.weights, model.pairs, model.prior))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(sent)
        for batch in batches:
            texts = [(value or "").encode() for value in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(score_texts(texts, own)[0] >= threshold, pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
