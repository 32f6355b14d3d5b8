"""Language identification as a mixture.

Training adds up hashed byte trigrams by language. A document is cut into pieces of PIECE
trigrams; each piece has a likelihood under every language. Expectation-maximisation then
estimates the proportions of languages that best explain the pieces. The set of languages
grows greedily from the best single one: a language joins if the log-likelihood gains more
than PENALTY times the logarithm of the number of pieces. The largest proportion names the
document's language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.llm.words import pieces

GRAM_BITS = 15
PIECE = 48
STEPS = 10
PENALTY = 3.0
UNKNOWN = "und"
RESULT = "id long, lang_pred string, score double, languages array<string>, shares array<double>"


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of texts end to end, each text between spaces, and where each begins."""
    data = np.frombuffer(b"".join(b" " + text.lower() + b" " for text in texts), np.uint8).astype(np.uint32)
    value = (data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]) * np.uint32(2654435761)
    bounds = np.concatenate([[0], np.cumsum([len(text) + 2 for text in texts])])
    return (value >> np.uint32(32 - GRAM_BITS)).astype(np.int32), bounds


def count_grams(rows: DataFrame) -> DataFrame:
    """Rows (lang, gram, n) from rows (lang, data); each task adds up before it sends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data").to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(data)
            for lang, texts in by_lang.items():
                for start, stop in pieces(texts):
                    found = np.bincount(_codes(texts[start:stop])[0], minlength=1 << GRAM_BITS)
                    totals[lang] = totals.get(lang, 0) + found
        for lang, counts in totals.items():
            grams = np.flatnonzero(counts)
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * len(grams), pa.string()),
                    "gram": pa.array(grams, pa.int32()),
                    "n": pa.array(counts[grams], pa.int64()),
                }
            )

    return rows.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Languages in order and log-probabilities of grams; at most 2 ** GRAM_BITS each."""

    languages: list[str]
    table: np.ndarray


def train(documents: DataFrame, lang: str, text: str, chosen: Column) -> Model:
    """Learn from the rows where ``chosen`` holds and text and language are not null."""
    rows = documents.where(chosen & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("data"))
    counts = count_grams(rows).toPandas()
    languages = sorted(counts["lang"].unique())
    totals = np.full((len(languages), 1 << GRAM_BITS), 0.5)
    for i, name in enumerate(languages):
        own = counts[counts["lang"] == name]
        totals[i, own["gram"].to_numpy()] += own["n"].to_numpy()
    logs = np.log(totals) - np.log(totals.sum(axis=1, keepdims=True)) if languages else totals
    return Model(languages, np.ascontiguousarray(logs.T.astype(np.float32)))


def _expect(
    likely: np.ndarray, owner: np.ndarray, starts: np.ndarray, shares: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportions after some steps, log-likelihoods, and what a little of each would gain."""
    number = np.diff(np.r_[starts, len(owner)])[:, None]
    for _ in range(STEPS):
        parts = likely * shares[owner]
        parts /= parts.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(parts, starts) / number
    mixed = np.maximum((likely * shares[owner]).sum(axis=1), 1e-30)
    gain = np.add.reduceat(likely / mixed[:, None], starts) / number
    return shares, np.add.reduceat(np.log(mixed), starts), gain


def infer(texts: list[bytes], model: Model) -> np.ndarray:
    """Proportions of languages, one row for each text (all of them non-empty)."""
    codes, bounds = _codes(texts)
    sizes = np.diff(bounds)
    pieces = -(-sizes // PIECE)
    first = np.concatenate([[0], np.cumsum(pieces)])
    owner = np.repeat(np.arange(len(texts)), pieces)
    begins = bounds[:-1][owner] + (np.arange(len(owner)) - first[:-1][owner]) * PIECE
    logs = np.add.reduceat(np.vstack([model.table[codes], np.zeros((2, model.table.shape[1]), np.float32)]), begins)
    top = logs.max(axis=1, keepdims=True)
    likely = np.exp(logs - top).astype(np.float64)
    count, kinds = len(texts), likely.shape[1]
    single = np.add.reduceat(logs.astype(np.float64), first[:-1])
    best = single.argmax(axis=1)
    chosen = np.zeros((count, kinds), bool)
    chosen[np.arange(count), best] = True
    result = chosen.astype(np.float64)
    shift = np.add.reduceat(top[:, 0].astype(np.float64), first[:-1])
    value = single[np.arange(count), best] - shift
    mixed = np.maximum(likely[np.arange(len(owner)), best[owner]], 1e-30)
    gain = np.add.reduceat(likely / mixed[:, None], first[:-1]) / pieces[:, None]
    open_ = np.arange(count)
    for _ in range(kinds - 1):
        gain[chosen[open_]] = -1.0
        more = gain.argmax(axis=1)
        # Of less gain than one, a little of the language makes the document less likely.
        able = gain[np.arange(len(open_)), more] > 1.0
        open_, more = open_[able], more[able]
        if not len(open_):
            break
        trial = chosen[open_]
        trial[np.arange(len(open_)), more] = True
        rows = np.flatnonzero(np.isin(owner, open_)) if len(open_) < count else np.arange(len(owner))
        local = np.searchsorted(open_, owner[rows])
        starts = np.concatenate([[0], np.cumsum(pieces[open_])])[:-1]
        shares, new, gain = _expect(likely[rows], local, starts, trial / trial.sum(axis=1, keepdims=True))
        accepted = new - value[open_] > PENALTY * np.log1p(pieces[open_])
        open_, gain = open_[accepted], gain[accepted]
        chosen[open_], result[open_], value[open_] = trial[accepted], shares[accepted], new[accepted]
        if not len(open_):
            break
    return result


def identify(documents: DataFrame, model: Model, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: ident, lang_pred, score, languages and shares (largest first).

    * Null texts and texts without a letter are ``und`` with score 0; so is everything if
      nothing was learned. Score is the share of the predicted language.
    * Of equal shares the language that sorts first by code point is named first.
    * The result depends on the text alone. Repeated rows give repeated results; other columns
      are ignored. Texts are read in pieces, whole. An empty table gives no rows.
    """
    sent = documents.sparkSession.sparkContext.broadcast((model.languages, model.table))
    rows = documents.select(
        F.col(ident).cast("long").alias("id"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("able"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"),
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for whole in batches:
            everything = whole.column("data").to_pylist()
            for start, stop in pieces(everything):
                batch, texts = whole.slice(start, stop - start), everything[start:stop]
                able = [i for i, ok in enumerate(batch.column("able").to_pylist()) if ok and own.languages]
                shares = infer([texts[i] for i in able], own) if able else np.zeros((0, 1))
                names: list[str] = [UNKNOWN] * len(texts)
                scores = [0.0] * len(texts)
                languages: list[list[str]] = [[] for _ in texts]
                parts: list[list[float]] = [[] for _ in texts]
                for row, i in enumerate(able):
                    ranked = [k for k in np.argsort(-shares[row], kind="stable") if shares[row, k] > 0]
                    languages[i] = [own.languages[k] for k in ranked]
                    parts[i] = [float(min(1.0, shares[row, k])) for k in ranked]
                    names[i], scores[i] = languages[i][0], parts[i][0]
                yield pa.record_batch(
                    {
                        "id": batch.column("id"),
                        "lang_pred": pa.array(names, pa.string()),
                        "score": pa.array(scores, pa.float64()),
                        "languages": pa.array(languages, pa.list_(pa.string())),
                        "shares": pa.array(parts, pa.list_(pa.float64())),
                    }
                )

    found = rows.mapInArrow(predict, RESULT)
    return found.select(F.col("id").alias(ident), "lang_pred", "score", "languages", "shares")
