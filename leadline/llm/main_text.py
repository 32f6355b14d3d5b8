"""Main text of web pages as a maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. A word scores the probability that its block belongs to
an article, a tag scores below zero, by how often it stands outside articles; both are learned
from labelled pages. One linear scan finds the contiguous region with the largest sum. Blocks inside
that region which are more likely something else (an advert, a share bar, comments) are left out, the
rest is the text.

A block's probability is logistic in the elements around it, the words of their class, id and
role, the share of linked words, its length and its end. What the words say plays no part.

* Markup is read as browsers do where it matters for text: raw text of scripts and styles, comments,
  quoted attributes, implied ends of paragraphs and list items, cut-off tags.
* Character references are decoded in each stretch of text; white space (``\\x20\\x09-\\x0D``) inside
  a block becomes one space; a line break is white space; blocks are joined by an empty line.
* A null or empty page, or one without a word, has an empty text. Repeated pages give equal
  rows. Empty tables give empty results; columns beyond those named are not read.
* A page is read whole, in time linear in its length.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadline.llm.labelled_layouts import labelled_pages

STEPS = 400
RATE = 0.2
DECAY = 2e-4
TAG_SCALE = 0.05  # cost of a tag that stands outside articles only, in sure words
KEEP = 0.5
MOST_CONTEXTS = 100_000  # remembered at once; more are computed anew
IMPLIED_DEPTH = 64  # levels looked through for an element that ends by implication

STOPS = ".!?…:。！？"

_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARKUP = re.compile(
    r"<(script|style|textarea|title|xmp|iframe|noembed|noframes)\b(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+>.*?(?:</\1\b[^>]*+>|\Z)"
    r"|<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-z][^\s/>]*+)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_NAMING = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option"
    " p pre search section select summary svg table tbody td template tfoot th thead tr ul video".split()
)
# An element whose start ends an open one of these, unless one of the others lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "a": ({"a"}, BLOCK),
}
# Starts that do not end an open paragraph, though they begin a block.
_INSIDE_P = frozenset("button caption noscript select option svg template tbody td tfoot th thead tr video".split())
_WITHIN = frozenset({"article", "main"})


@dataclass
class Block:
    """A stretch of text between block tags: what surrounds it and the tags ahead of it."""

    text: str
    words: int
    context: frozenset[str]
    linked: int
    tags: list[str]

    def looks(self) -> list[str]:
        """Features of the text itself."""
        size = "few" if self.words <= 3 else "some" if self.words <= 10 else "many" if self.words <= 40 else "long"
        linked = "none" if not self.linked else "part" if 2 * self.linked < self.words else "most"
        found = [f"size:{size}", f"linked:{linked}", "stop" if self.text[-1] in STOPS else "no stop"]
        return [*found, "copyright"] if "©" in self.text else found

    def features(self) -> list[str]:
        return [*self.context, *self.looks()]


def _inner(context: frozenset[str], name: str, naming: tuple[tuple[str, str], ...]) -> frozenset[str]:
    """What surrounds the content of an element."""
    own = {f"tag:{name}"}
    if name in ("header", "footer") and any(f"tag:{outer}" in context for outer in _WITHIN):
        own = {f"tag:{name}-within"}
    for attribute, value in naming:
        if attribute == "hidden" or attribute == "aria-hidden" and value == "true":
            own.add("hidden")
        elif attribute == "style":
            if "display:none" in value.replace(" ", ""):
                own.add("hidden")
        elif attribute != "aria-hidden":
            own.update(f"word:{word}" for word in _TOKEN.findall(value))
    return context | own if name in BLOCK or len(own) > 1 else context


def _naming(attributes: str) -> tuple[tuple[str, str], ...]:
    if not attributes or attributes.isspace():
        return ()
    found = _NAMING.findall(attributes)
    return tuple((name.lower(), value.strip("\"'").lower()) for name, value in found)


class Contexts(dict):
    """What surrounds the content of elements, by what surrounds them and how they are named.

    Pages of one site share it; a task keeps one.
    """

    def inner(self, outer: frozenset[str], name: str, attributes: str) -> frozenset[str]:
        key = outer, name, _naming(attributes)
        if key not in self:
            if len(self) >= MOST_CONTEXTS:
                self.clear()
            self[key] = _inner(*key)
        return self[key]


class _Reader:
    """Cuts one page into blocks."""

    def __init__(self, contexts: Contexts) -> None:
        self.contexts = contexts
        self.stack: list[tuple[str, frozenset[str]]] = [("", frozenset())]
        self.open: dict[str, int] = {}
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.tags: list[str] = []

    def read(self, page: str) -> list[Block]:
        at = 0
        for found in _MARKUP.finditer(page):
            self.text(page[at : found.start()])
            at = found.end()
            if found[3]:
                name = found[3].lower()
                if not found[0].endswith(">"):
                    break  # the page ends inside a tag
                self.tag(name, bool(found[2]), found[4])
            elif found[1] and found[1].lower() in ("textarea", "iframe"):
                self.flush()
        self.text(page[at:])
        self.flush()
        return self.blocks

    def text(self, raw: str) -> None:
        if not raw:
            return
        words = entities.unescape(raw) if "&" in raw else raw
        self.parts.append(words)
        if self.open.get("a"):
            self.linked += len(_WORD.findall(words))

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip(" ")
        self.parts.clear()
        if text:
            words = text.count(" ") + 1
            self.blocks.append(Block(text, words, self.stack[-1][1], min(self.linked, words), self.tags))
            self.tags = []
        self.linked = 0

    def tag(self, name: str, closing: bool, attributes: str) -> None:
        if name == "br":
            self.parts.append(" ")
        elif name in BLOCK:
            self.flush()
        if closing:
            self.close(name)
        else:
            if name in ENDS:
                self.imply(*ENDS[name])
            if name in BLOCK and name not in _INSIDE_P and self.open.get("p"):
                self.imply({"p"}, {"button", "td", "th", "caption"})
            if name not in VOID and not attributes.rstrip().endswith("/") or name in BLOCK and name not in VOID:
                self.stack.append((name, self.contexts.inner(self.stack[-1][1], name, attributes)))
                self.open[name] = self.open.get(name, 0) + 1
        self.tags.append(name)

    def close(self, name: str) -> None:
        """End the innermost element of this name; an inline one ends none of the blocks in it."""
        if not self.open.get(name):
            return
        if name not in BLOCK:
            for outer, _ in reversed(self.stack[-IMPLIED_DEPTH:]):
                if outer == name:
                    break
                if outer in BLOCK:
                    return
            else:
                return
        self.drop_to(name)

    def imply(self, names: set[str], fences: set[str] | frozenset[str]) -> None:
        for outer, _ in reversed(self.stack[-IMPLIED_DEPTH:]):
            if outer in names:
                self.drop_to(outer)
                return
            if outer in fences:
                return

    def drop_to(self, name: str) -> None:
        while True:
            outer, _ = self.stack.pop()
            self.open[outer] -= 1
            if outer == name:
                return


def blocks_of(page: str, contexts: Contexts | None = None) -> list[Block]:
    """The blocks of a page that hold words, in order."""
    return _Reader(Contexts() if contexts is None else contexts).read(page)


@dataclass
class Weights:
    """Log-odds of features, and the cost of each tag."""

    features: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    tags: dict[str, float] = field(default_factory=dict)

    _around: dict[frozenset[str], float] = field(default_factory=dict)

    def likely(self, block: Block) -> float:
        """Probability that a block is content; the share of its surroundings is remembered."""
        around = self._around.get(block.context)
        if around is None:
            if len(self._around) >= MOST_CONTEXTS:
                self._around.clear()
            around = self.bias + sum(self.features.get(name, 0.0) for name in block.context)
            self._around[block.context] = around
        total = around + sum(self.features.get(name, 0.0) for name in block.looks())
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, total))))


def fit(pages: Iterable[tuple[str, Callable[[str], bool]]]) -> Weights:
    """Learn from pages and which of their blocks are content.

    Features by gradient steps on the logistic likelihood; the cost of a tag is its share of
    uses outside content.
    """
    found, truth = [], []
    uses: dict[str, list[int]] = {}
    for page, is_content in pages:
        for block in blocks_of(page):
            content = bool(is_content(block.text))
            found.append(block.features())
            truth.append(content)
            for tag in block.tags:
                uses.setdefault(tag, [0, 0])[content] += 1
    if not found:
        return Weights()
    names = sorted({name for features in found for name in features})
    place = {name: i for i, name in enumerate(names)}
    held = np.zeros((len(found), len(names)))
    for row, features in zip(held, found, strict=True):
        row[[place[name] for name in features]] = 1.0
    wanted = np.array(truth, np.float64)
    weights, bias = np.zeros(len(names)), 0.0
    slope, scale = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, STEPS + 1):
        off = (wanted - 1.0 / (1.0 + np.exp(-(held @ weights + bias)))) / len(wanted)
        change = np.append(held.T @ off - DECAY * weights, off.sum())
        slope = 0.9 * slope + 0.1 * change
        scale = 0.99 * scale + 0.01 * change * change
        move = RATE * (slope / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights + move[:-1], bias + move[-1]
    costs = {tag: TAG_SCALE * (out + 1) / (out + inside + 2) for tag, (out, inside) in uses.items()}
    return Weights(dict(zip(names, weights.tolist(), strict=True)), float(bias), costs)


def standard_weights() -> Weights:
    """Weights from the labelled layouts."""
    if not _standard:
        _standard.append(fit(labelled_pages()))
    return _standard[0]


_standard: list[Weights] = []


def train(labelled: DataFrame, page: str = "html", content: str = "content", most: int = 2000) -> Weights:
    """Weights from a table of pages and their article texts (blocks joined by empty lines).

    At most ``most`` pages are fitted, chosen by a hash; the labelled layouts are added.
    """
    chosen = labelled.where(F.col(page).isNotNull()).orderBy(F.xxhash64(page), page).limit(most)
    rows = chosen.select(page, F.coalesce(F.col(content), F.lit(""))).collect()
    own = [(row[0], set(row[1].split("\n\n")).__contains__) for row in rows]
    return fit([*labelled_pages(), *own])


def region_of(gains: list[float], costs: list[float]) -> tuple[int, int]:
    """The contiguous run of blocks with the largest sum of gains, less the costs between them.

    Of equal sums the first and then the longest one. ``costs[i]`` stands ahead of block i.
    """
    best, first, last = 0.0, 0, 0
    total, start = 0.0, 0
    for i, gain in enumerate(gains):
        total -= costs[i]
        if total <= 0.0:
            total, start = 0.0, i
        total += gain
        if total > best or total == best and start == first:
            best, first, last = total, start, i + 1
    return first, last


def main_blocks(page: str, weights: Weights, contexts: Contexts | None = None) -> list[str]:
    """The blocks of a page's main text."""
    blocks = blocks_of(page, contexts)
    likely = [weights.likely(block) for block in blocks]
    gains = [chance * block.words for chance, block in zip(likely, blocks, strict=True)]
    costs = [sum(weights.tags.get(tag, TAG_SCALE / 2) for tag in block.tags) for block in blocks]
    first, last = region_of(gains, costs)
    return [blocks[i].text for i in range(first, last) if likely[i] >= KEEP]


def extract_text(pages: DataFrame, page: str, *keep: Column | str, weights: Weights | None = None) -> DataFrame:
    """Main text of each page: the columns ``keep``, then ``text``, ``n_blocks`` and ``n_chars``."""
    weights = standard_weights() if weights is None else weights
    kept = pages.select(*keep).schema
    names = [*kept.names, "text", "n_blocks", "n_chars"]
    rows = pages.select(*keep, F.coalesce(F.col(page), F.lit("")).alias("_page"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = Contexts()
        for batch in batches:
            found = [main_blocks(value, weights, contexts) for value in batch.column(batch.num_columns - 1).to_pylist()]
            texts = ["\n\n".join(blocks) for blocks in found]
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [
                pa.array(texts, pa.string()),
                pa.array([len(blocks) for blocks in found], pa.int64()),
                pa.array([len(text) for text in texts], pa.int64()),
            ]
            yield pa.record_batch(arrays, names)

    fields = ", ".join(f"`{part.name}` {part.dataType.simpleString()}" for part in kept)
    return rows.mapInArrow(extract, f"{fields}, text string, n_blocks long, n_chars long")
