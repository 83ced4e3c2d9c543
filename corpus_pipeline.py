"""A corpus made ready for training: low quality out, repeated lines out, one of each group of near copies,
benchmark passages out, then tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows it gets; the first four return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from shelfline.llm.common import importable, staged, table
from shelfline.llm.queries import BPE_FILE

NEAR_PERCENT = 80  # five words and a similarity of 0.8 or more; op4_near_dedup has a contract of its own


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, fitted on these rows' labels, rejects go."""
    importable(spark)
    return quality.clean(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line runs that repeat earlier text go, and rows that consist of nothing else."""
    return line_dedup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    importable(spark)
    return near_dedup.keep_one(docs, NEAR_PERCENT)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold an item of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of ids and decoded text, and the ids of each row."""
    importable(spark)
    return bpe.encode_documents(docs, BPE_FILE, with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("BPE encoding and decoding", tokens),
]

#: Trained scores and a tokenizer's merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
