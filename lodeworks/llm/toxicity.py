"""Toxicity: cumulative-link regression of severity grades on sparse text features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import document_key, packed, unpacked
from lodeworks.llm.ordinal import Ordinal, Sparse, collected, fit, known_id, sample, scored, telling
from lodeworks.llm.registry import query, read
from lodeworks.llm.textfeatures import TextFeatures

WORDS = TextFeatures()


def severities(x: Sparse, toxic: np.ndarray, severe: int = 3) -> np.ndarray:
    """Grades of labelled rows: 0 clean; 1 toxic; 2 toxic with ``severe`` or more hostile words.

    Labels say toxic or not. Words whose mean differs between the two, and is over twice as
    high in toxic rows, are hostile; how many a toxic row holds grades it.
    """
    words, ratio = telling(x, toxic)
    hostile = x.only(words[ratio > 2])
    hits = np.bincount(hostile.row, np.expm1(hostile.value), x.n)
    return np.where(toxic == 0, 0, np.where(hits >= severe - 0.01, 2, 1))


def train_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000, severe: int = 3) -> Ordinal:
    """The model, fitted on at most ``sample_rows`` labelled documents (a hash of the id chooses them)."""
    label = F.when(F.col("toxic") > 0, 1).when(F.col("toxic") == 0, 0).alias("toxic")
    x, known = collected(sample(docs, labels, [label], sample_rows), WORDS.of)
    return fit(x, severities(x, known["toxic"], severe))


def toxicity_scores(docs: DataFrame, model: Ordinal, reject: float = 0.5) -> DataFrame:
    """Per row: doc_id, expected_severity, p_toxic, p_severe, toxic (p_toxic >= ``reject``).

    Null and empty texts have no features and get what the thresholds alone give. Every row
    is scored by its whole text; equal texts get equal scores; an empty table gives none.
    """
    found = scored(docs.select(*document_key()).select("doc", "body"), model, WORDS.scorer(model.weights))
    tail = lambda k: F.coalesce(F.get("tails", F.lit(k)), F.lit(0.0))
    return found.select(known_id().alias("doc_id"), F.col("expected").alias("expected_severity"), tail(0).alias("p_toxic"), tail(1).alias("p_severe"), (tail(0) >= reject).alias("toxic"))


def reject_toxic(docs: DataFrame, model: Ordinal, reject: float = 0.5) -> DataFrame:
    """The documents with p_toxic under ``reject``; all columns as they came."""
    found = scored(packed(docs).select("whole"), model, WORDS.scorer(model.weights))
    return unpacked(found.where(F.get("tails", F.lit(0)) < reject), docs.columns)


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return toxicity_scores(docs, train_toxicity(docs, read(spark, folder, "labels")))
