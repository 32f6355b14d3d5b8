"""The pipeline against a plain reading of its stages, and the registered queries."""

from __future__ import annotations

import glob
import os
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from leadline.llm import crf_quality, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def _shingles(words):
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def _words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]


def _plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def _unlike(rows):
    """One row of each component of similar sets: the one of least id."""
    sets = {i: _shingles(_words(text)) for i, text in rows.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: text for i, text in rows.items() if find(i) == i}


def test_stages_against_a_plain_reading(spark, tmp_path):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    texts = {r.doc_id: r.text for r in documents.collect()}
    model = crf_quality.train(documents, labels, F.lit(True))
    scores, _ = crf_quality.score_texts([(texts[i] or "").encode() for i in texts], model)
    left = {i: texts[i] for i, score in zip(texts, scores, strict=True) if score >= crf_quality.THRESHOLD}
    wants = [set(left)]
    first = {}
    for i in sorted(left):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", left[i] or ""), i)
    left = {i: left[i] for i in first.values()}
    wants.append(set(left))
    left = _unlike(left)
    wants.append(set(left))
    items = [_shingles(_plain(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    own = {i: _shingles(_plain(text)) for i, text in left.items()}
    left = {i: t for i, t in left.items() if not any(s and 100 * len(s & own[i]) >= 80 * len(s) for s in items)}
    wants.append(set(left))

    docs = documents
    for (name, stage), want in zip(corpus_pipeline.STAGES, wants, strict=False):
        out = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == documents.columns
        assert {r.doc_id for r in docs.select("doc_id").collect()} == want, name
    mixed = Counter(r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect())
    assert set(mixed) <= set(left) and max(mixed.values()) <= 2
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()) == mixed


def test_stages_of_empty_tables(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents, FOLDER).collect() == []


def test_stages_keep_null_texts_and_further_columns(spark):
    rows = [(1, None, "en", None, 0, "a"), (2, "", "en", "s", 0, "b"), (None, "Some words of text.", "en", "s", 1, "c")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, block string"
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "block"]
    assert docs.count() == 2  # null and "" are one text


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found = contract.queries()[name](spark, FOLDER)
    cursor = connection.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    rows = [tuple(row[c] for c in columns) for row in found.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, cursor.fetchall()))


def test_every_operator_is_registered():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in names if name.startswith("op") and name[2].isdigit()}
    assert "pipeline" in names
