"""N-gram join and item search against brute force."""

from __future__ import annotations

import random
import re

import pytest

from leadline.llm import ngram_join
from leadline.llm.components import components
from leadline.llm.containment import find_contained, without_contained
from leadline.llm.ngram_join import keep_one_of_each, similar_components

SCHEMA = "doc_id long, text string, n string, key string, block int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, text, "n", "k", 1) for i, text in rows], SCHEMA)


def _rows(seed, families=8):
    """Families of near copies at several distances, copies, tiny texts, shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=30)
    texts = ["", None, " ", "one", "One", "one two", "one two", "a b c", "A B c", "a b c d"]
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.randint(5, 120))
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy = copy[: len(copy) * 9 // 10]
            texts.append(" ".join(copy))
    for _ in range(8):
        texts.append(" ".join([*passage, *rng.choices(vocabulary, k=rng.randint(0, 60))]))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


def _shingles(text, size):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def _components(rows, size, percent):
    sets = {i: _shingles(text, size) for i, text in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


@pytest.mark.parametrize("size, percent, block_bytes", [(4, 85, 600), (5, 80, 1 << 22), (1, 50, 900)])
def test_components_of_similar_sets(spark, size, percent, block_bytes):
    rows = _rows(size)
    found = similar_components(_frame(spark, rows), size=size, percent=percent, block_bytes=block_bytes).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == _components(rows, size, percent)


def test_large_parts_are_cut_into_slabs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL_SHINGLES", 60)
    rows = _rows(11, families=3)
    found = similar_components(_frame(spark, rows), size=3, percent=70, block_bytes=2000).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == _components(rows, 3, 70)


def test_one_of_each_stays(spark):
    rows = _rows(5)
    found = keep_one_of_each(_frame(spark, rows))
    assert found.columns == ["doc_id", "text", "n", "key", "block"]
    want = sorted(i for i, _, root in _components(rows, 5, 80) if i == root)
    assert sorted(r.doc_id for r in found.collect()) == want


def test_empty_table_and_null_ids(spark):
    assert similar_components(spark.createDataFrame([], SCHEMA)).collect() == []
    text = "a b c d e f"
    found = similar_components(_frame(spark, [(4, text), (None, text), (None, "x y z"), (9, text), (9, text)])).collect()
    assert sorted(((r.doc_id, r.component_id) for r in found), key=str) == [(4, 4), (9, 4), (9, 4), (None, 4), (None, None)]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, i) for i in range(100, 180)]
    rng = random.Random(2)
    name = {i: v for i, v in zip(range(1001), rng.sample(range(-5000, 5000), 1001), strict=True)}
    edges = [(name[a], name[b]) for a, b in chain + star] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low, hub = min(name[i] for i in range(61)), min(name[i] for i in [1000, *range(100, 180)])
    assert found == {name[i]: low for i in range(61)} | {name[i]: hub for i in [1000, *range(100, 180)]}


def _plain(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(
        str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]


def _sets(text, size):
    words = _plain(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


@pytest.mark.parametrize("size, percent", [(5, 80), (2, 50), (3, 100)])
def test_items_in_documents(spark, size, percent, monkeypatch):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "Das"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))) for i in range(25)]
    items += [(100, None), (101, "..."), (102, items[0][1]), (None, items[1][1])]
    docs = [(0, None), (1, ""), (2, items[3][1].upper()), (3, "w1")]
    for i in range(4, 40):
        words = rng.choices(vocabulary, k=rng.choice([3, 30, 2000]))
        own = rng.choice(items[:25])[1].split()
        for _ in range(rng.choice([0, 0, 1, 3])):
            own[rng.randrange(len(own))] = "gap"
        at = rng.randrange(len(words))
        docs.append((i, ", ".join(words[:at] + own + words[at:])))
    want = []
    for i, text in docs:
        for j, item in items:
            wanted = _sets(item, size)
            shared = len(wanted & _sets(text, size))
            if wanted and 100 * shared >= percent * len(wanted):
                want.append((i, -1 if j is None else j, len(wanted), shared))
    documents = _frame(spark, docs)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for most in (1_000_000, 10):  # one block of items, then many
        monkeypatch.setattr("leadline.llm.containment.ITEM_WORDS", most)
        found = find_contained(documents, benchmark, size=size, percent=percent).collect()
        assert sorted(tuple(r) for r in found) == sorted(want)
    clean = without_contained(documents, benchmark, size=size, percent=percent)
    assert clean.columns == documents.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted({i for i, _ in docs} - {row[0] for row in want})


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    documents = _frame(spark, [(1, "a b c d e f")])
    assert find_contained(documents, none).collect() == []
    assert without_contained(documents, none).count() == 1
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert find_contained(spark.createDataFrame([], SCHEMA), one).collect() == []
