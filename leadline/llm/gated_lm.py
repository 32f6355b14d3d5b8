"""Scores of whole documents by a gated recurrent language model.

Words are counted over all training documents (blocks send their distinct words to buckets,
which answer the counts). Every token belongs to a class: the end of a document, each of the
TOP most frequent words, and the other words by their last byte. A gated recurrent network
in numpy predicts the class of the next token, and then the slot inside the class: up to WORDS
next most frequent words have slots of their own in the class of their ending, predicted from
the state and read by the network as the word before. All other words of an ending share its
last slot: one has probability (c + 1) over the sum of theirs, with one further share for words
not seen in training. The recurrent state is carried from the first token of a document to its
end.

The network is trained by backpropagation through windows of WINDOW tokens, state carried
across windows, on all training documents. Tasks of TASK_TOKENS tokens train copies of the
network; after each round the copies are averaged, weighted by tokens, and the next round goes
on with other documents. Rounds and copies of a round both grow with the square root of the tasks,
so a larger corpus gives more steps as well as more copies. A corpus too small for LEAST_STEPS
steps is passed over more than once.

Words are cut twice: to count them, and to turn documents into sequences of slots, which are
stored. Training and scoring read those, two bytes a word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.config import delete_folder, shared_folder
from leadline.llm import blocks as B
from leadline.llm.words import edges, words_of

BLOCK_BYTES = 12 << 20
TOP = 30
ENDINGS = 16
CLASSES = 1 + TOP + ENDINGS
UNITS = 16
LANES = 256
WINDOW = 32
TASK_TOKENS = 2_000_000
LEAST_STEPS = 300
RATE = 0.02
WORDS = 768
_AT_ONCE = 1 << 14  # states that are held for the shares of classes and slots
_LOOKED_UP = 1 << 12  # states whose classes are looked up together, so that they stay in the cache
_TOGETHER = 1 << 10  # texts that advance together, for the same reason
_SCORED_BYTES = 4 << 20  # sequences that are scored together, at most one batch more
_LARGE = 60.0  # exponentials of less, and their sums, stay finite
_TURNED = np.float32([-1, -1, 1])  # gates are computed from their sums with the sign turned
FEWEST = 8  # occurrences in training that a word needs for a slot
SLOT_BYTES = 2
READ = "id long, train boolean, tokens binary, n_known long, base_score double, in_class double"

# Rows of a bucket's answer that are for no block: its most frequent words, its class sums.
TOP_ROW, SUM_ROW = -1, -2


@dataclass
class Net:
    """Weights of the network; ``flat`` holds them end to end.

    With ``lexicon`` the weights of its slots follow: for each, what it adds to the gates as
    the word before, and what the state adds to its share of its class.
    """

    flat: np.ndarray
    lexicon: Optional[Lexicon] = None

    SHAPES = ((CLASSES, 3 * UNITS), (UNITS, 3 * UNITS), (UNITS, CLASSES), (CLASSES,))

    @classmethod
    def fresh(cls, share_of_class: np.ndarray, lexicon: Optional[Lexicon] = None) -> Net:
        """Small weights from a fixed seed; the output starts at the shares of classes.

        Weights of slots start at nothing: each has its share of its class in any state.
        """
        rng = np.random.default_rng(7)
        parts = [rng.normal(0, 0.1, shape).astype(np.float32).ravel() for shape in cls.SHAPES[:3]]
        slots = [] if lexicon is None else [np.zeros(len(lexicon.shares) * (4 * UNITS), np.float32)]
        return cls(np.concatenate([*parts, np.log(share_of_class).astype(np.float32), *slots]), lexicon)

    def parts(self, flat: np.ndarray | None = None) -> list[np.ndarray]:
        flat = self.flat if flat is None else flat
        found, at = [], 0
        for shape in self.SHAPES:
            size = int(np.prod(shape))
            found.append(flat[at : at + size].reshape(shape))
            at += size
        return found


    def slot_parts(self, flat: Optional[np.ndarray] = None) -> tuple[np.ndarray, np.ndarray]:
        flat = self.flat if flat is None else flat
        rest = flat[sum(int(np.prod(shape)) for shape in self.SHAPES) :].reshape(len(self.lexicon.shares), 4 * UNITS)
        return rest[:, : 3 * UNITS], rest[:, 3 * UNITS :]

    def entering(self) -> np.ndarray:
        """What the token before adds to the gates, by slot or, without a lexicon, by class."""
        enter = self.parts()[0]
        return enter if self.lexicon is None else enter[self.lexicon.kinds] + self.slot_parts()[0]


@dataclass
class Lexicon:
    """Slots: tokens that the network tells apart, in the order of their classes.

    The end and each of the TOP words is a class of one slot. A class of an ending has one for
    each of its words among the WORDS next most frequent, and a last one for all its others,
    which share it by their counts.
    """

    names: np.ndarray  # of the words that have a slot of their own inside an ending, sorted
    places: np.ndarray  # their slots
    kinds: np.ndarray  # class of each slot
    first: np.ndarray  # first slot of each class, and the number of slots
    shares: np.ndarray  # logarithm of each slot's share of its class, from counts
    others: np.ndarray  # of each class: sum of c + 1 of words without a slot, and 1 for unseen ones

    def slots(self, names: np.ndarray, kind: np.ndarray) -> np.ndarray:
        found = self.first[kind + 1] - 1
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            found = np.where(self.names[at] == names, self.places[at], found)
        return found


def lexicon_of(names: np.ndarray, counts: np.ndarray, kind: np.ndarray, sums: np.ndarray) -> Lexicon:
    """Slots of these words, given their classes, and the sums of c + 1 of all classes."""
    order = np.lexsort((names, kind))
    names, counts, kind = names[order], counts[order] + 1.0, kind[order]
    own = np.bincount(kind, minlength=CLASSES)
    first = np.concatenate([[0], np.cumsum(own + 1)])
    places = np.arange(len(names)) + kind
    others = sums - np.bincount(kind, weights=counts, minlength=CLASSES)
    shares = np.empty(first[-1])
    shares[places] = np.log(counts / sums[kind])
    shares[first[1:] - 1] = np.log(others / sums)
    by_name = np.argsort(names)
    return Lexicon(names[by_name], places[by_name], np.repeat(np.arange(CLASSES), own + 1), first, shares.astype(np.float32), others)


def _groups(lexicon: Lexicon, slots: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """Places of the slots of each class that has several, with the first slot and the end."""
    kinds = lexicon.kinds[slots].astype(np.uint8)
    order = np.argsort(kinds, kind="stable")
    edge = np.searchsorted(kinds[order], np.arange(CLASSES + 1))
    for kind in np.flatnonzero((np.diff(lexicon.first) > 1) & (np.diff(edge) > 0)):
        yield order[edge[kind] : edge[kind + 1]], int(lexicon.first[kind]), int(lexicon.first[kind + 1])


def _bounded(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no exponential can overflow. States lie between -1 and 1, so weights bound the rest."""
    return bool((np.abs(weights).sum(axis=0) + np.abs(bias)).max() <= _LARGE)


def _given(states: np.ndarray, weights: np.ndarray, bias: np.ndarray, bounded: bool) -> np.ndarray:
    """What the states give each choice; the largest of a row is taken off unless all are bounded."""
    out = states @ weights
    out += bias
    if not bounded:
        out -= out.max(axis=1, keepdims=True)
    return out


def _likelihood(given: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Natural logarithm of the share of each row's own choice. Overwrites ``given``."""
    picked = given[np.arange(len(own)), own]
    np.exp(given, out=given)
    return picked - np.log(given @ np.ones(given.shape[1], np.float32))


def _slopes(given: np.ndarray, own: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Shares less one for each row's own choice, times the weight of the row. Overwrites ``given``."""
    np.exp(given, out=given)
    given *= (weight / (given @ np.ones(given.shape[1], np.float32)))[:, None]
    given[np.arange(len(own)), own] -= weight
    return given


def slot_likelihood(net: Net, states: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Natural logarithm of the share of each slot in its class, given the states before."""
    found, leaves, shares = np.zeros(len(slots)), net.slot_parts()[1].T, net.lexicon.shares
    bounded = _bounded(leaves, shares)
    for places, begin, end in _groups(net.lexicon, slots):
        given = _given(states[places], leaves[:, begin:end], shares[begin:end], bounded)
        found[places] = _likelihood(given, slots[places] - begin)
    return found


def class_likelihood(net: Net, states: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Natural logarithm of the share of each class, given the states before."""
    found, (leave, bias) = np.empty(len(kinds)), net.parts()[2:]
    bounded = _bounded(leave, bias)
    for at in range(0, len(kinds), _LOOKED_UP):
        part = slice(at, at + _LOOKED_UP)
        found[part] = _likelihood(_given(states[part], leave, bias, bounded), kinds[part])
    return found


def log_likelihood(net: Net, tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each text's classes.

    Texts advance together, the longest first; a step covers those that have tokens left.
    With a lexicon the tokens are slots, and the probability is that of slots.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    result = np.empty(len(sizes))
    for at in range(0, len(order), _TOGETHER):
        own = order[at : at + _TOGETHER]
        result[own] = _advance(net, tokens, bounds[:-1][own], sizes[own])
    return result


def _advance(net: Net, tokens: np.ndarray, start: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities of texts that begin at ``start``, the longest first.

    Arrays are laid out (token, unit), tokens of a step side by side. The steps only move the
    states; classes and slots are looked up for many steps at once.
    """
    back, enter, lexicon = net.parts()[1], net.entering(), net.lexicon
    third = [slice(a, a + UNITS) for a in range(0, 3 * UNITS, UNITS)]
    table = [np.ascontiguousarray(enter[:, part]) * by for part, by in zip(third, _TURNED, strict=True)]
    turn = [np.ascontiguousarray(back[:, part]) * by for part, by in zip(third, _TURNED, strict=True)]
    steps = int(left[0])
    alive = np.searchsorted(-left, -np.arange(steps), "left")
    ends = np.cumsum(alive)
    state = np.zeros((len(left), UNITS), np.float32)
    total = np.zeros(len(left))
    first = 0
    while first < steps:
        done = ends[first] - alive[first]
        last = max(first + 1, int(np.searchsorted(ends, done + _AT_ONCE, "right")))
        step = np.repeat(np.arange(first, last), alive[first:last])
        edge = np.append(ends[first:last] - alive[first:last], ends[last - 1]) - done
        row = np.arange(edge[-1]) - edge[step - first]
        place = start[row] + step
        now = tokens[place]
        came = tokens[place - (step > 0)]
        came[step == 0] = 0
        puts = [part.take(came, axis=0) for part in table]
        states = np.empty((len(now), UNITS), np.float32)
        with np.errstate(over="ignore"):
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                h, new = state[: b - a], states[a:b]
                keep, reset = (_opened(h @ turn[i], puts[i][a:b]) for i in (0, 1))
                reset *= h
                np.matmul(reset, turn[2], out=new)
                new += puts[2][a:b]
                np.tanh(new, out=new)
                h = h - new
                h *= keep
                new += h
                state = new
        found = class_likelihood(net, states, now if lexicon is None else lexicon.kinds[now])
        if lexicon is not None:
            found += slot_likelihood(net, states, now)
        total += np.bincount(row, weights=found, minlength=len(total))
        first = last
    return total


def _opened(x: np.ndarray, put: np.ndarray) -> np.ndarray:
    """A gate, in place: 1 / (1 + exp(-y)), of a sum that is already -y.

    An exponential takes half the time of numpy's tangent.
    """
    x += put
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _lanes(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts laid end to end in LANES rows: tokens, where a text begins, where there is one.

    The longest choose their lane first, so that lanes end together; inside a lane the texts
    keep their order.
    """
    owner = np.zeros(len(texts), np.int64)
    length = np.zeros(LANES, np.int64)
    for place in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        lane = owner[place] = int(length.argmin())
        length[lane] += len(texts[place])
    filled = [[texts[i] for i in np.flatnonzero(owner == lane)] for lane in range(LANES)]
    width = int(length.max()) if len(texts) else 0
    tokens = np.zeros((LANES, width), texts[0].dtype if texts else np.uint8)
    begins = np.zeros((LANES, width), bool)
    there = np.zeros((LANES, width), np.float32)
    for lane, own in enumerate(filled):
        at = 0
        for text in own:
            tokens[lane, at : at + len(text)] = text
            begins[lane, at] = True
            at += len(text)
        there[lane, :at] = 1.0
    return tokens, begins, there


def even_pieces(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The texts, long ones cut into pieces, so that all lanes end together.

    A lane that goes on alone would train on one text only.
    """
    most = max(WINDOW, sum(map(len, texts)) // LANES)
    return [text[at : at + most] for text in texts for at in range(0, len(text), most)]


def train_copy(net: Net, texts: list[np.ndarray], passes: int = 1) -> Net:
    """The network after passes over these token sequences.

    Arrays are laid out (step, unit or class, lane), so that gates are contiguous slices and
    what needs no order of steps is done once for a window.
    """
    net = Net(net.flat.copy(), net.lexicon)
    _, back, leave, bias = net.parts()
    lexicon = net.lexicon
    tokens, begins, there = _lanes(texts)
    state = np.zeros((UNITS, LANES), np.float32)
    slope, scale = np.zeros_like(net.flat), np.zeros_like(net.flat)
    two, turned = 2 * UNITS, np.repeat(_TURNED, UNITS)
    for number, at in enumerate(list(range(0, tokens.shape[1], WINDOW)) * passes, 1):
        now = tokens[:, at : at + WINDOW].T
        begin = begins[:, at : at + WINDOW].T
        mask = there[:, at : at + WINDOW].T
        came = np.concatenate([tokens[:, at - 1 : at].T if at else np.zeros((1, LANES), tokens.dtype), now[:-1]])
        came = np.where(begin, 0, came)
        steps = len(now)
        some, stays = begin.any(axis=1), (~begin).astype(np.float32)
        enter = net.entering() * turned
        put = np.ascontiguousarray(enter.take(came, axis=0).transpose(0, 2, 1))
        to_gates, to_new = np.split(np.ascontiguousarray((back * turned).T), [two])
        before, mixed, new, states = (np.empty((steps, UNITS, LANES), np.float32) for _ in range(4))
        gates = np.empty((steps, two, LANES), np.float32)
        with np.errstate(over="ignore"):
            for t in range(steps):
                h, gate = before[t], gates[t]
                h[:] = state
                if some[t]:
                    h *= stays[t]
                np.matmul(to_gates, h, out=gate)
                _opened(gate, put[t, :two])
                np.multiply(gate[UNITS:], h, out=mixed[t])
                np.matmul(to_new, mixed[t], out=new[t])
                new[t] += put[t, two:]
                np.tanh(new[t], out=new[t])
                state = states[t]
                np.subtract(h, new[t], out=state)
                state *= gate[:UNITS]
                state += new[t]
        flat = np.zeros_like(net.flat)
        d_enter, d_back, d_leave, d_bias = net.parts(flat)
        weight = mask / max(1.0, float(mask.sum()))
        d_states = _train_classes(net, flat, states, now if lexicon is None else lexicon.kinds[now], weight)
        if lexicon is not None:
            _train_slots(net, flat, states, d_states, now, weight)
        from_gates, from_new = np.ascontiguousarray(back[:, :two]), np.ascontiguousarray(back[:, two:])
        later = np.zeros((UNITS, LANES), np.float32)
        d_put = np.empty((steps, 3 * UNITS, LANES), np.float32)
        for t in range(steps - 1, -1, -1):
            d, own, keep, reset = d_states[t], d_put[t], gates[t, :UNITS], gates[t, UNITS:]
            d += later
            of_new = (1 - keep) * d
            np.multiply(of_new, 1 - new[t] * new[t], out=own[two:])
            d_mixed = from_new @ own[two:]
            np.multiply((before[t] - new[t]) * keep, of_new, out=own[:UNITS])
            np.multiply((1 - reset) * mixed[t], d_mixed, out=own[UNITS:two])
            np.matmul(from_gates, own[:two], out=later)
            d *= keep
            later += d
            d_mixed *= reset
            later += d_mixed
            if some[t]:
                later *= stays[t]
        d_back[:, :two] += np.matmul(d_put[:, :two], before.transpose(0, 2, 1)).sum(axis=0).T
        d_back[:, two:] += np.matmul(d_put[:, two:], mixed.transpose(0, 2, 1)).sum(axis=0).T
        met = came.ravel().astype(np.int64)
        added = np.zeros((3 * UNITS, len(enter)), np.float32)
        for unit in range(3 * UNITS):
            np.add.at(added[unit], met, d_put[:, unit].ravel())
        if lexicon is None:
            d_enter += added.T
        else:
            net.slot_parts(flat)[0][:] = added.T
            d_enter += np.add.reduceat(added, lexicon.first[:-1], axis=1).T
        slope *= 0.9
        slope += np.float32(0.1) * flat
        scale *= 0.99
        flat *= flat
        flat *= 0.01
        scale += flat
        step = np.sqrt(scale / np.float32(1 - 0.99**number))
        step += 1e-6
        np.divide(slope, step, out=step)
        step *= RATE / (1 - 0.9**number)
        net.flat -= step
    return net


def _train_classes(net: Net, flat: np.ndarray, states: np.ndarray, now: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Adds the slopes of classes to ``flat``; returns those of the states."""
    (leave, bias), (d_leave, d_bias) = net.parts()[2:], net.parts(flat)[2:]
    bounded = _bounded(leave, bias)
    kinds, weights = now.ravel(), weight.ravel()
    rows = states.transpose(0, 2, 1).reshape(-1, UNITS)
    d_rows = np.empty_like(rows)
    for at in range(0, len(rows), _LOOKED_UP):
        part = slice(at, at + _LOOKED_UP)
        out = _slopes(_given(rows[part], leave, bias, bounded), kinds[part], weights[part])
        d_leave += (out.T @ rows[part]).T
        d_bias += np.ones(len(out), np.float32) @ out
        np.matmul(out, leave.T, out=d_rows[part])
    return np.ascontiguousarray(d_rows.reshape(len(states), LANES, UNITS).transpose(0, 2, 1))


def _train_slots(net: Net, flat: np.ndarray, states: np.ndarray, d_states: np.ndarray, now: np.ndarray, weight: np.ndarray) -> None:
    """Adds the slopes of slots in their classes to ``flat`` and to those of the states."""
    leaves, d_leaves, shares = net.slot_parts()[1], net.slot_parts(flat)[1], net.lexicon.shares
    bounded = _bounded(leaves.T, shares)
    slots, weights = now.ravel(), weight.ravel()
    rows = states.transpose(0, 2, 1).reshape(-1, UNITS)
    d_rows = np.zeros_like(rows)
    for places, begin, end in _groups(net.lexicon, slots):
        own = rows[places]
        given = _given(own, leaves[begin:end].T, shares[begin:end], bounded)
        out = _slopes(given, slots[places] - begin, weights[places])
        d_leaves[begin:end] += out.T @ own
        d_rows[places] = out @ leaves[begin:end]
    d_states += d_rows.reshape(len(states), LANES, UNITS).transpose(0, 2, 1)


@dataclass
class Counts:
    """What the corpus says: training tokens, distinct ones, ends, classes."""

    tokens: int
    distinct: int
    ends: int
    top: np.ndarray  # names of the most frequent words, in the order of their classes
    shares: np.ndarray  # of each class among training tokens
    lexicon: Lexicon


def _texts(docs: pa.Table) -> tuple[np.ndarray, np.ndarray, object]:
    ids, texts, table = B.rows_of(docs)
    return ids, table.column("train").to_numpy(), words_of(texts, lower=True)


def _distinct(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names in order, each word's place among them, and their endings."""
    coded = pa.array(words.name).dictionary_encode()
    names, codes = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(names)
    places = np.empty(len(names), np.int64)
    places[order] = np.arange(len(names))
    where, ending = places[codes], np.empty(len(names), np.int64)
    ending[where] = np.frombuffer(words.data, np.uint8)[words.end - 1] % ENDINGS
    return names[order], where, ending


class Scoring:
    def __init__(self, buckets: int) -> None:
        self.buckets = buckets

    def send_words(self, docs: pa.Table) -> pa.Table:
        _, train, words = _texts(docs)
        names, where, ending = _distinct(words)
        teaches = np.repeat(train, np.diff(words.bounds))
        counts = np.bincount(where[teaches], minlength=len(names))
        return B.pack(
            "bucket", docs.column("block")[0].as_py(), B.buckets_of(names, self.buckets), [names, counts, ending]
        )

    def count(self, sent: pa.Table) -> pa.Table:
        names, counts, ending = B.joined(sent, 0, np.uint64), B.joined(sent, 1), B.joined(sent, 2)
        block, _ = B.numbered(sent)
        bucket = sent.column("bucket")[0].as_py()
        known, first, where = np.unique(names, return_index=True, return_inverse=True)
        total = np.bincount(where, weights=counts, minlength=len(known)).astype(np.int64)
        answers = B.pack("block", bucket, block, [total[where], *[np.zeros(len(block), np.uint8)] * 2])
        kind = ending[first]
        top = np.lexsort((known.view(np.int64), -total))[: TOP + WORDS]  # as Spark orders them
        most = B.pack("block", bucket, np.full(len(top), TOP_ROW), [known[top], total[top], kind[top]])
        seen = total > 0
        sums = np.bincount(kind, weights=total, minlength=ENDINGS).astype(np.int64)
        types = np.bincount(kind[seen], minlength=ENDINGS)
        added = B.pack("block", bucket, np.full(ENDINGS, SUM_ROW), [np.arange(ENDINGS), sums, types])
        return pa.concat_tables([answers, most, added])

    def read(self, docs: pa.Table, told: pa.Table, counts: Counts) -> pa.Table:
        """Slots of each document's tokens, and what does not depend on the network."""
        if not docs.num_rows:
            return pa.table({name: pa.array([], kind) for name, kind in _READ_TYPES})
        ids, train, words = _texts(docs)
        names, where, ending = _distinct(words)
        parts = B.unpack(told, 0)
        sent = B.Sent(B.buckets_of(names, self.buckets))
        seen = np.zeros(len(names), np.int64)
        entries = sent.entries(told.column("bucket").to_pylist(), [np.arange(len(p)) for p in parts])
        seen[entries] = np.concatenate([np.zeros(0, np.int64), *parts])
        kind = class_of(names, ending, counts.top)
        bounds = words.bounds
        log_word = np.log10(seen + 1.0)
        slots = counts.lexicon.slots(names, kind)
        # A word without a slot of its own has its share of its class's last one.
        last = slots == counts.lexicon.first[kind + 1] - 1
        in_class = np.where(last, log_word - np.log10(counts.lexicon.others[kind]), 0.0)
        tokens = slots.astype(np.uint16)[where]
        base = _by_text(log_word[where], bounds) + np.log10(counts.ends + 1.0)
        base -= (np.diff(bounds) + 1) * np.log10(counts.tokens + counts.distinct + 1.0)
        known = _by_text((seen > 0)[where].astype(np.float64), bounds) + (counts.ends > 0)
        columns = [
            B.id_column(ids),
            pa.array(train),
            pa.array([tokens[a:b].tobytes() + b"\0\0" for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
            pa.array(known.astype(np.int64)),
            pa.array(base),
            pa.array(_by_text(in_class[where], bounds)),
        ]
        return pa.table(dict(zip([name for name, _ in _READ_TYPES], columns, strict=True)))


_READ_TYPES = [
    ("id", pa.int64()),
    ("train", pa.bool_()),
    ("tokens", pa.binary()),
    ("n_known", pa.int64()),
    ("base_score", pa.float64()),
    ("in_class", pa.float64()),
]


def _by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return np.bincount(owner, weights=values, minlength=len(bounds) - 1)


def class_of(names: np.ndarray, ending: np.ndarray, top: np.ndarray) -> np.ndarray:
    """0 is the end of a text, then the frequent words, then endings."""
    kind = 1 + TOP + ending
    if len(top):
        order = np.argsort(top)
        at = np.minimum(np.searchsorted(top[order], names), len(top) - 1)
        hit = top[order][at] == names
        kind = np.where(hit, 1 + order[at], kind)
    return kind


def gather(answers: DataFrame, ends: int) -> Counts:
    """Totals over all buckets; the driver gets TOP and WORDS words and ENDINGS sums."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for row in range(table.num_rows):
                one = table.slice(row, 1)
                kind = one.column("block")[0].as_py()
                keys = B.joined(one, 0, np.uint64).view(np.int64) if kind == TOP_ROW else B.joined(one, 0)
                yield pa.record_batch(
                    {
                        "kind": pa.array([kind] * len(keys), pa.int32()),
                        "key": pa.array(keys, pa.int64()),
                        "n": pa.array(B.joined(one, 1), pa.int64()),
                        "other": pa.array(B.joined(one, 2), pa.int64()),
                    }
                )

    found = answers.where(F.col("block") < 0).mapInArrow(rows, "kind int, key long, n long, other long")
    top = found.where((F.col("kind") == TOP_ROW) & (F.col("n") > 0)).orderBy(F.desc("n"), "key").limit(TOP + WORDS).collect()
    added = found.where(F.col("kind") == SUM_ROW).groupBy("key").agg(F.sum("n").alias("n"), F.sum("other").alias("types"))
    number, types = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for row in added.collect():
        number[row.key], types[row.key] = row.n, row.types
    tokens, distinct = int(number.sum()) + ends, int(types.sum()) + (ends > 0)
    top, told_apart = top[:TOP], [row for row in top[TOP:] if row.n >= FEWEST]
    names = np.array([row.key for row in top], np.int64).view(np.uint64)
    of_class, sums = np.zeros(CLASSES), np.ones(CLASSES)
    of_class[0], sums[0] = ends, ends + 1
    for place, row in enumerate(top):
        number[row.other] -= row.n
        types[row.other] -= 1
        of_class[1 + place], sums[1 + place] = row.n, row.n + 1
    of_class[1 + TOP :] = number
    sums[1 + TOP :] = number + types + 1
    lexicon = lexicon_of(
        np.array([row.key for row in told_apart], np.int64).view(np.uint64),
        np.array([row.n for row in told_apart], np.float64),
        np.array([1 + TOP + row.other for row in told_apart], np.int64),
        sums,
    )
    return Counts(tokens, distinct, ends, names, (of_class + 1) / (of_class + 1).sum(), lexicon)


def train(sequences: DataFrame, counts: Counts) -> Net:
    """Rounds of training on all of ``sequences`` (tokens binary); the driver gets averages.

    Sequences are dealt out one by one, so no id or repeated text fills a task.
    """
    net = Net.fresh(counts.shares, counts.lexicon)
    size = (sequences.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0) // SLOT_BYTES
    if not size:
        return net
    tasks = size // TASK_TOKENS + 1
    rounds = math.isqrt(tasks - 1) + 1
    copies = -(-tasks // rounds)
    passes = max(1, -(-LEAST_STEPS * LANES * WINDOW // size))
    spark = sequences.sparkSession
    spread = sequences.select("tokens").repartition(rounds * copies).select("tokens", F.spark_partition_id().alias("task"))
    folder = shared_folder(spark, "lm-rounds")
    spread.withColumn("round", F.col("task") % rounds).write.partitionBy("round").parquet(folder)
    spread = spark.read.parquet(folder)
    for number in range(rounds):
        flat = net.flat

        def copy(batches: Iterator[pa.RecordBatch], flat: np.ndarray = flat) -> Iterator[pa.RecordBatch]:
            held: dict[int, list[bytes]] = {}
            for batch in batches:
                for task, blob in zip(batch.column("task").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                    held.setdefault(task, []).append(blob)
            for task in sorted(held):
                texts = [np.frombuffer(blob, np.uint16) for blob in sorted(held[task])]
                trained = train_copy(Net(flat, counts.lexicon), even_pieces(texts), passes).flat
                weight = float(sum(map(len, texts)))
                yield pa.record_batch(
                    {
                        "place": pa.array(np.arange(len(trained)), pa.int32()),
                        "task": pa.array(np.full(len(trained), task), pa.int32()),
                        "value": pa.array(trained.astype(np.float64) * weight),
                        "weight": pa.array(np.full(len(trained), weight)),
                    }
                )

        chosen = spread.where(F.col("round") == number).select("tokens", "task").repartitionById(copies, F.floor(F.col("task") / rounds).cast("int"))
        trained = chosen.mapInArrow(copy, "place int, task int, value double, weight double")
        # Added in the order of tasks, so that reruns agree to the last digit.
        listed = trained.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("task", "value", "weight"))).alias("all"))

        def added(name: str) -> Column:
            return F.aggregate("all", F.lit(0.0), lambda total, one: total + one[name])

        flat = np.zeros_like(net.flat)
        for row in listed.select("place", (added("value") / added("weight")).alias("value")).collect():
            flat[row.place] = row.value
        net = Net(flat, counts.lexicon)
    delete_folder(spark, folder)
    return net


def score_documents(
    documents: DataFrame,
    chosen: Column,
    ident: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row for each row: ident, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from rows where ``chosen`` holds. base_score is the log10 probability
    of independent words with one added to each count, score that of the network.

    * A null or empty text is one token, its end. A text of any length is read to its end.
    * Repeated rows teach and are scored as often as they stand. Other columns are ignored.
      With nothing to learn from, every word is unknown. An empty table gives no rows.
    """
    blocks = B.count_blocks(documents, text, block_bytes)
    job = Scoring(blocks)
    docs = B.in_blocks(documents, ident, text, blocks, chosen.alias("train"))
    answers = (
        docs.groupBy("block")
        .applyInArrow(lambda table: job.send_words(table), B.packed_schema("bucket", 3))
        .groupBy("bucket")
        .applyInArrow(lambda table: job.count(table), B.packed_schema("block", 3))
        .checkpoint()
    )
    counts = gather(answers, documents.where(chosen).count())
    sequences = (
        docs.groupBy("block")
        .cogroup(answers.where(F.col("block") >= 0).groupBy("block"))
        .applyInArrow(lambda docs, told: job.read(docs, told, counts), READ)
        .checkpoint()
    )
    net = train(sequences.where("train"), counts)
    if net.lexicon is None:  # slots keep their shares of the counts
        net = Net(np.append(net.flat, np.zeros(len(counts.lexicon.shares) * 4 * UNITS, np.float32)), counts.lexicon)

    def score_together(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        blobs = batch.column("tokens").to_pylist()
        tokens, sizes = np.frombuffer(b"".join(blobs), np.uint16), [len(blob) // SLOT_BYTES for blob in blobs]
        slots = log_likelihood(net, tokens, edges(sizes)) / np.log(10.0)
        total = pa.array(batch.column("in_class").to_numpy() + slots)
        kept = {name: batch.column(name) for name in ("id", "n_known", "base_score")}
        return pa.record_batch({**kept, "n_tokens": pa.array(sizes, pa.int64()), "score": total})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            # A text much longer than the others goes its last steps alone, so few batches are better.
            if sum(one.nbytes for one in held) >= _SCORED_BYTES:
                yield score_together(held)
                held = []
        if held:
            yield score_together(held)

    found = sequences.select("id", "n_known", "base_score", "tokens", "in_class").mapInArrow(
        score, "id long, n_known long, base_score double, n_tokens long, score double"
    )
    return found.select(
        F.col("id").alias(ident),
        "n_tokens",
        "n_known",
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
