"""From raw documents to a training mix, in five stages.

Quality classifier, exact dedup, near-duplicate join, benchmark decontamination, source mix.
Each stage works on all that the one before it kept. A stage takes (spark, docs, folder) and
returns the columns of ``documents``; the last one returns a row for each copy in the mix.

A null text is an empty one; empty tables give empty results; repeated rows are reduced by
the dedup stages. Columns beyond those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadline.config import prepare_session, shared_folder
from leadline.llm import crf_quality
from leadline.llm.containment import without_contained
from leadline.llm.cuckoo import keep_first
from leadline.llm.mixing import mix_documents
from leadline.llm.ngram_join import keep_one_of_each


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the line classifier, fitted on ``labels``, rejects."""
    prepare_session(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return crf_quality.keep_good(docs, crf_quality.train(docs, labels, F.lit(True)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the least doc_id stays."""
    prepare_session(spark)
    return keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar five-word shingle sets stays."""
    prepare_session(spark)
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain an item of ``benchmark``."""
    prepare_session(spark)
    return without_contained(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emit each document as often as its source's target asks."""
    prepare_session(spark)
    return mix_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mix", source_mix),
]

# A fitted classifier cannot be written in SQL; tests compare with a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet for the next.

    A stage's input is deleted once its output is written, so one copy remains.
    """
    prepare_session(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
