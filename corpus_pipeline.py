"""From raw documents to packed training sequences, in stages that each work on what the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodeworks.llm.lines import dedup_lines
from lodeworks.llm.packing import pack
from lodeworks.llm.shingles import dedup_shingles
from lodeworks.llm.spans import dedup_spans
from lodeworks.llm.toxicity import reject_toxic, train_toxicity
from lodeworks.plans import files as fs

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that a model of the labelled ones finds toxic."""
    return reject_toxic(docs, train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that an earlier document holds; documents stay, if need be empty."""
    return dedup_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (by fingerprints and min-hashes, checked: five words, similarity 0.8) the document with the smallest doc_id stays."""
    return dedup_shingles(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages go that stand earlier already; documents stay, if need be empty."""
    return dedup_spans(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each with its place in a sequence."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup), ("substring_dedup", substring_dedup), ("packing", packing)
]

#: The classifier and the fingerprints have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    folder = fs.shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
