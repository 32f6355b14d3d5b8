"""Mixtures of languages, line quality and the language model."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadline.llm import crf_quality, gated_lm, language_mixture
from leadline.llm.words import words_of

SCHEMA = "doc_id long, text string, lang string, data string, id string, train string"


def _words(rng, letters, count):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(count))


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(4)
    letters = {"aa": "abcde", "bb": "efghij", "cc": "klmnoaé"}
    rows = [(i, _words(rng, letters[lang], 80), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    rows += [(100, None, "aa"), (101, "12 .. 7", "bb"), (102, "abba", None), (103, "", "aa")]
    mixed = " ".join([_words(rng, letters["aa"], 300), _words(rng, letters["bb"], 200)])
    rows += [(104, mixed, None), (105, _words(rng, letters["cc"], 20_000), None), (105, "", None)]
    return spark.createDataFrame([(i, t, g, "d", "i", "t") for i, t, g in rows], SCHEMA)


def test_mixture(spark, tongues):
    model = language_mixture.train(tongues, "lang", "text", F.col("doc_id") % 4 != 2)
    rows = language_mixture.identify(tongues, model).collect()
    found = {r.doc_id: r for r in rows if r.doc_id != 105}
    assert len(rows) == tongues.count()
    truth = {r.doc_id: r.lang for r in tongues.collect()}
    assert all(found[i].lang_pred == truth[i] for i in range(60))
    assert [(found[i].lang_pred, found[i].score) for i in (100, 101, 103)] == [("und", 0.0)] * 3
    assert found[104].languages == ["aa", "bb"] and abs(found[104].shares[0] - 0.55) < 0.1
    assert all(0 <= r.score <= 1 and abs(sum(r.shares) - (r.lang_pred != "und")) < 1e-6 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id == 105} == {"cc", "und"}


def test_mixture_without_training(spark, tongues):
    model = language_mixture.train(tongues, "lang", "text", F.lit(False))
    assert {r.lang_pred for r in language_mixture.identify(tongues, model).collect()} == {"und"}
    assert language_mixture.identify(tongues.limit(0), model).collect() == []


def test_forward_backward_against_all_labelings():
    rng = np.random.default_rng(1)
    sizes = [3, 1, 0, 5, 2]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    scores, pairs = rng.normal(size=bounds[-1]), rng.normal(size=(2, 2))
    good, expected = crf_quality.forward_backward(scores, bounds, pairs)
    joint = np.zeros((2, 2))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        total, mass, steps = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for labels in product([0, 1], repeat=int(b - a)):
            value = sum(scores[a + k] for k, label in enumerate(labels) if label)
            value += sum(pairs[x, y] for x, y in zip(labels[:-1], labels[1:], strict=True))
            total += math.exp(value)
            mass += math.exp(value) * np.array(labels)
            for x, y in zip(labels[:-1], labels[1:], strict=True):
                steps[x, y] += math.exp(value)
        if b > a:
            np.testing.assert_allclose(good[a:b], mass / total)
            joint += steps / total
    np.testing.assert_allclose(expected, joint)


def test_line_features():
    texts = [b"Good words here.\n\nSAME SAME ### 12", b"", b"x\nx", b"\n \n"]
    bins, length, bounds = crf_quality.lines_of(texts)
    assert bounds.tolist() == [0, 2, 2, 4, 4] and length.tolist() == [16, 16, 1, 1]
    at = list(crf_quality.EDGES).index("line_again")
    assert bins[:, at].tolist() == [0, 0, 1, 1]
    alone = [crf_quality.lines_of([text])[0] for text in texts]
    np.testing.assert_array_equal(bins, np.concatenate(alone))


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        lines = []
        for _ in range(rng.randint(1, 6)):
            words = _words(rng, "aeiourstln", rng.randint(4, 12)).split()
            lines.append(" ".join(words if good else [word + rng.choice(["###", "$$"]) for word in words]) + ".")
        rows.append((i, "\n".join(lines), None))
        labels.append((i, int(good)))
    rows += [(1000, None, None), (1001, "", None), (1002, "word " * 50_000, None)]
    labels += [(1, None), (2000, 1), (None, 0)]
    documents = spark.createDataFrame([(i, t, g, "d", "i", "t") for i, t, g in rows], SCHEMA)
    return documents, spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality(spark, judged):
    documents, labels = judged
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = crf_quality.train(documents, labels, ~held_out)
    rows = {r.doc_id: r for r in crf_quality.score_documents(documents, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((rows[i].score >= 0.3) == truth[i] for i in held) >= 0.98 * len(held)
    assert rows[1000].score == rows[1001].score == model.prior and rows[1000].line_scores == []
    assert all(0 <= r.score <= 1 for r in rows.values())
    kept = crf_quality.keep_good(documents, model)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.score >= 0.3}


def test_quality_of_nothing(spark, judged):
    documents, labels = judged
    model = crf_quality.train(documents, labels.limit(0), F.lit(True))
    assert {r.score for r in crf_quality.score_documents(documents, model).collect()} == {0.5}
    assert crf_quality.score_documents(documents.limit(0), model).collect() == []


def test_network_learns_what_it_sees():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, gated_lm.CLASSES, n).astype(np.uint8) for n in (5, 9, 1)]
    net = gated_lm.Net.fresh(np.full(gated_lm.CLASSES, 1 / gated_lm.CLASSES))
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    before = gated_lm.log_likelihood(net, np.concatenate(texts), bounds).sum()
    many = gated_lm.train_copy(net, texts * 20_000)
    assert gated_lm.log_likelihood(many, np.concatenate(texts), bounds).sum() > before + 5
    assert len(gated_lm.log_likelihood(net, np.zeros(0, np.uint8), np.array([0]))) == 0
    one = [gated_lm.log_likelihood(many, t, np.array([0, len(t)]))[0] for t in texts]
    np.testing.assert_allclose(gated_lm.log_likelihood(many, np.concatenate(texts), bounds), one, rtol=1e-5)


def _plain_forward(net, classes):
    """The network token by token, in plain arithmetic."""
    enter, back, leave, bias = (part.astype(float).tolist() for part in net.parts())
    units = gated_lm.UNITS
    state, came, total = [0.0] * units, 0, 0.0
    for now in classes:
        put = enter[came]
        at = lambda h, j: sum(h[i] * back[i][j] for i in range(units))
        keep = [1 / (1 + math.exp(-(put[j] + at(state, j)))) for j in range(units)]
        reset = [1 / (1 + math.exp(-(put[units + j] + at(state, units + j)))) for j in range(units)]
        mixed = [r * h for r, h in zip(reset, state)]
        new = [math.tanh(put[2 * units + j] + at(mixed, 2 * units + j)) for j in range(units)]
        state = [k * h + (1 - k) * n for k, h, n in zip(keep, state, new)]
        out = [sum(h * leave[i][j] for i, h in enumerate(state)) + bias[j] for j in range(gated_lm.CLASSES)]
        total += out[now] - math.log(sum(math.exp(x) for x in out))
        came = now
    return total / math.log(10)


def test_scores_against_a_plain_forward_pass(spark, monkeypatch):
    """Column score: classes by the counts, words inside their class, the network step by step."""
    rng = random.Random(12)
    vocabulary = [f"w{i}{c}" for i in range(30) for c in "abcd"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 30))).upper() + " Unseen" * (i % 2)) for i in range(40)]
    net = gated_lm.Net(np.random.default_rng(1).normal(0, 0.3, sum(a * (b[0] if b else 1) for a, *b in gated_lm.Net.SHAPES)).astype(np.float32))
    monkeypatch.setattr(gated_lm, "train", lambda sequences, counts: net)
    frame = spark.createDataFrame([(i, t, None, "d", "i", "t") for i, t in rows], SCHEMA)
    got = {r.doc_id: r.score for r in gated_lm.score_documents(frame, F.col("doc_id") % 7 != 2).collect()}
    counts = Counter(w for i, t in rows if i % 7 != 2 for w in t.lower().split())
    ends = sum(i % 7 != 2 for i, _ in rows)
    name = {w: int(words_of([w.encode()]).name[0]) for w in [*vocabulary, "unseen"]}
    signed = {w: n - (1 << 64) if n >> 63 else n for w, n in name.items()}
    top = sorted(counts, key=lambda w: (-counts[w], signed[w]))[: gated_lm.TOP]
    kind = {w: 1 + top.index(w) if w in top else 1 + gated_lm.TOP + w.encode()[-1] % gated_lm.ENDINGS for w in name}
    whole = Counter()
    for w, c in counts.items():
        whole[kind[w]] += c + 1
    for i, text in rows:
        words = text.lower().split()
        want = sum(math.log10((counts[w] + 1) / (whole[kind[w]] + (kind[w] > gated_lm.TOP or w not in top))) for w in words)
        want += math.log10((ends + 1) / (ends + 1)) + _plain_forward(net, [*(kind[w] for w in words), 0])
        assert abs(got[i] - want) < 1e-4 * max(1, abs(want))


def _base(rows, chosen):
    counts, ends = Counter(), 0
    for i, text in rows:
        if chosen(i):
            counts.update((text or "").encode().lower().split())
            ends += 1
    tokens, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    result = []
    for i, text in rows:
        words = (text or "").encode().lower().split()
        each = [*(counts[w] for w in words), ends]
        score = sum(math.log10((c + 1) / (tokens + distinct + 1)) for c in each)
        result.append((i, len(each), sum(c > 0 for c in each), tokens, round(score, 6)))
    return sorted(result, key=str)


@pytest.mark.parametrize("block_bytes", [2000, 1 << 24])
def test_language_model(spark, block_bytes):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        start = rng.randint(0, 3)
        words = [f"{'abcd'[(start + k) % 4]}{rng.randint(0, 9)}" for k in range(rng.randint(0, 60))]
        rows.append((i, " ".join(words)))
    rows += [(300, None), (301, ""), (302, "Odd words, unseen"), (2, "a1 a1"), (None, "a1 B2")]
    frame = spark.createDataFrame([(i, t, None, "d", "i", "t") for i, t in rows], SCHEMA)
    found = gated_lm.score_documents(frame, F.coalesce(F.col("doc_id") % 7 != 2, F.lit(True)), block_bytes=block_bytes)
    got = found.collect()
    want = _base(rows, lambda i: i is None or i % 7 != 2)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == want
    assert all(r.score < 0 for r in got)


def test_language_model_learns_order(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["one", "two", "three"] * rng.randint(20, 40)), None, "", "", "") for i in range(900)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = gated_lm.score_documents(frame, F.col("doc_id") % 7 != 2).toPandas()
    held = got[got.doc_id % 7 == 2]
    assert held.score.sum() > 0.9 * held.base_score.sum() and (held.score > held.base_score).all()


def test_language_model_learns_from_every_document(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["one", "two", "three"] * rng.randint(20, 40)), None, "", "", "") for i in range(900)]
    tenth = F.pmod(F.xxhash64("doc_id", F.lit("lm")), F.lit(10)) == 0
    frame = spark.createDataFrame(rows, SCHEMA).where(~tenth)
    got = gated_lm.score_documents(frame, F.col("doc_id") % 7 != 2).toPandas()
    held = got[got.doc_id % 7 == 2]
    assert held.score.sum() > 0.9 * held.base_score.sum()


def test_lanes_end_together_and_keep_all_tokens():
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(1, gated_lm.CLASSES, n), 0).astype(np.uint8) for n in [*rng.integers(0, 90, 500), 700]]
    tokens, begins, there = gated_lm._lanes(texts)
    got = tokens[there > 0]
    assert len(got) == sum(map(len, texts)) and begins.sum() == len(texts)
    assert (np.bincount(got) == np.bincount(np.concatenate(texts))).all()
    assert tokens.shape[1] == max(map(len, texts))


def test_language_model_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert gated_lm.score_documents(empty, F.lit(True)).collect() == []
    frame = spark.createDataFrame([(1, "a b", None, "", "", "")], SCHEMA)
    row = gated_lm.score_documents(frame, F.lit(False)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def _small_lexicon():
    kinds = np.array([40, 31, 31, 31])
    sums = np.full(gated_lm.CLASSES, 100.0)
    return gated_lm.lexicon_of(np.array([9, 5, 7, 3], np.uint64), np.array([10, 20, 30, 19]), kinds, sums)


def test_slots_against_plain_arithmetic():
    """Class, then slot, token by token; slots of a class sum to one in any state."""
    rng, lexicon = np.random.default_rng(4), _small_lexicon()
    size = len(gated_lm.Net.fresh(np.full(gated_lm.CLASSES, 1 / gated_lm.CLASSES), lexicon).flat)
    net = gated_lm.Net(rng.normal(0, 0.5, size).astype(np.float32), lexicon)
    texts = [rng.integers(0, len(lexicon.kinds), n).astype(np.uint16) for n in (6, 0, 40, 1)]
    got = gated_lm.log_likelihood(net, np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
    _, back, leave, bias = (part.astype(float) for part in net.parts())
    units, leaves = gated_lm.UNITS, net.slot_parts()[1].astype(float)
    for found, text in zip(got, texts):
        state, came, want = np.zeros(units), 0, 0.0
        for now in text:
            put = net.parts()[0][lexicon.kinds[came]] + net.slot_parts()[0][came]
            keep, reset = (1 / (1 + np.exp(-(put[a : a + units] + state @ back[:, a : a + units]))) for a in (0, units))
            new = np.tanh(put[2 * units :] + (reset * state) @ back[:, 2 * units :])
            state, kind, came = keep * state + (1 - keep) * new, lexicon.kinds[now], now
            out, inside = state @ leave + bias, leaves @ state + lexicon.shares
            own = lexicon.kinds == kind
            want += out[kind] - np.log(np.exp(out).sum()) + inside[now] - np.log(np.exp(inside[own]).sum())
        assert abs(found - want) < 1e-4 * max(1, abs(want))


def test_slopes_of_slots_are_those_of_the_likelihood():
    rng, lexicon = np.random.default_rng(5), _small_lexicon()
    size = len(gated_lm.Net.fresh(np.full(gated_lm.CLASSES, 1 / gated_lm.CLASSES), lexicon).flat)
    net, lanes = gated_lm.Net(rng.normal(0, 0.5, size).astype(np.float32), lexicon), gated_lm.LANES
    states = rng.normal(0, 1, (3, gated_lm.UNITS, lanes)).astype(np.float32)
    now = rng.integers(0, len(lexicon.kinds), (3, lanes))
    flat, d_states = np.zeros_like(net.flat), np.zeros_like(states)
    gated_lm._train_slots(net, flat, states, d_states, now, np.ones((3, lanes), np.float32))

    def loss(change=0.0, moved=0.0):
        other = gated_lm.Net(net.flat + change, lexicon)
        rows = (states + moved).transpose(0, 2, 1).reshape(-1, gated_lm.UNITS)
        return -gated_lm.slot_likelihood(other, rows, now.ravel()).sum()

    step = rng.normal(0, 1e-3, size).astype(np.float32)
    assert abs(loss(step) - loss(-step) - 2 * flat @ step) < 0.02 * max(0.1, abs(2 * flat @ step))
    step = rng.normal(0, 1e-3, states.shape).astype(np.float32)
    assert abs(loss(0, step) - loss(0, -step) - 2 * (d_states * step).sum()) < 0.02 * max(0.1, abs(2 * (d_states * step).sum()))


def test_words_of_one_class_are_told_apart_by_what_came_before(spark):
    """Equal counts and endings; only the word before says which comes next."""
    rng = random.Random(6)
    fill = [f"f{i}z" for i in range(gated_lm.TOP)]
    pairs = [("alma", "ropa"), ("olda", "tima")]
    rows = []
    for i in range(600):
        words = []
        for _ in range(12):
            words += [*rng.choice(pairs), *rng.choices(fill, k=3)]
        rows.append((i, " ".join(words), None, "d", "i", "t"))
    rows += [(602, "alma ropa olda tima", None, "d", "i", "t"), (609, "alma tima olda ropa", None, "d", "i", "t")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in gated_lm.score_documents(frame, F.col("doc_id") < 600).where("doc_id >= 600").collect()}
    assert got[602].base_score == got[609].base_score and got[602].score > got[609].score + 0.5


def test_slopes_of_classes_are_those_of_the_likelihood():
    rng, lanes = np.random.default_rng(5), gated_lm.LANES
    size = len(gated_lm.Net.fresh(np.full(gated_lm.CLASSES, 1 / gated_lm.CLASSES)).flat)
    net = gated_lm.Net(rng.normal(0, 0.5, size).astype(np.float32))
    states = rng.uniform(-1, 1, (20, gated_lm.UNITS, lanes)).astype(np.float32)
    now = rng.integers(0, gated_lm.CLASSES, (20, lanes))
    flat = np.zeros_like(net.flat)
    d_states = gated_lm._train_classes(net, flat, states, now, np.ones((20, lanes), np.float32))

    def loss(change=0.0, moved=0.0):
        rows = (states + moved).transpose(0, 2, 1).reshape(-1, gated_lm.UNITS)
        return -gated_lm.class_likelihood(gated_lm.Net(net.flat + change), rows, now.ravel()).sum()

    step = rng.normal(0, 1e-3, size).astype(np.float32)
    assert abs(loss(step) - loss(-step) - 2 * flat @ step) < 0.02 * max(0.1, abs(2 * flat @ step))
    step = rng.normal(0, 1e-3, states.shape).astype(np.float32)
    assert abs(loss(0, step) - loss(0, -step) - 2 * (d_states * step).sum()) < 0.02 * max(0.1, abs(2 * (d_states * step).sum()))


@pytest.mark.filterwarnings("error")
def test_likelihood_of_large_weights_is_finite():
    """Exponentials of these would overflow; gates are far outside of what they can be, too."""
    rng, lexicon = np.random.default_rng(6), _small_lexicon()
    size = len(gated_lm.Net.fresh(np.full(gated_lm.CLASSES, 1 / gated_lm.CLASSES), lexicon).flat)
    net = gated_lm.Net(rng.normal(0, 80, size).astype(np.float32), lexicon)
    text = rng.integers(0, len(lexicon.kinds), 50).astype(np.uint16)
    got = gated_lm.log_likelihood(net, text, np.array([0, 50]))[0]
    _, back, leave, bias = (part.astype(float) for part in net.parts())
    units, leaves = gated_lm.UNITS, net.slot_parts()[1].astype(float)
    state, came, want = np.zeros(units), 0, 0.0
    for now in text:
        put = net.entering()[came].astype(float)
        keep, reset = (0.5 * np.tanh((put[a : a + units] + state @ back[:, a : a + units]) / 2) + 0.5 for a in (0, units))
        new = np.tanh(put[2 * units :] + (reset * state) @ back[:, 2 * units :])
        state, kind, came = keep * state + (1 - keep) * new, lexicon.kinds[now], now
        for out, own in ((state @ leave + bias, kind), ((leaves @ state + lexicon.shares)[lexicon.kinds == kind], now - lexicon.first[kind])):
            want += out[own] - out.max() - np.log(np.exp(out - out.max()).sum())
    assert np.isfinite(got) and abs(got - want) < 1e-3 * abs(want)


def test_batches_of_a_task_are_scored_together(spark, monkeypatch):
    """A long text goes its last steps alone; once for a task, not once for each batch."""
    monkeypatch.setattr(gated_lm, "log_likelihood", lambda net, tokens, bounds: np.full(len(bounds) - 1, float(len(bounds) - 1)))
    rows = [(i, "one two three", None, "", "", "") for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "10")
    try:
        got = gated_lm.score_documents(frame, F.lit(False)).collect()
    finally:
        spark.conf.set(setting, before)
    assert sorted(r.doc_id for r in got) == list(range(300))
    assert {round((r.score - got[0].score) * math.log(10)) for r in got} == {0} and {r.n_tokens for r in got} == {4}
    # No word is known: the share of the words is 1 and that of the end is 1.
    assert all(abs(r.score * math.log(10) - 300) < 1e-6 for r in got)
