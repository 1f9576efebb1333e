"""Quality: cumulative-link regression on graded ratings gives the expected grade and the chance of each tail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import document_key, packed, unpacked
from lodeworks.llm.ordinal import Ordinal, collected, fit, known_id, sample, scored
from lodeworks.llm.registry import query, read
from lodeworks.llm.textfeatures import TextFeatures

STYLE = TextFeatures(style=True)


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 poor, 1 sound but toxic, 2 sound and clean. A missing ``toxic`` counts as 0."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") > 0, F.when(F.col("toxic") > 0, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))


def train_quality(docs: DataFrame, ratings: DataFrame, sample_rows: int = 8000) -> Ordinal:
    """The model, fitted on at most ``sample_rows`` rated documents (doc_id, grade from 0), chosen by a hash of the id."""
    x, known = collected(sample(docs, ratings, [F.col("grade").cast("int").alias("grade")], sample_rows), STYLE.of)
    return fit(x, known["grade"])


def quality_scores(docs: DataFrame, model: Ordinal, least: int = 1, keep: float = 0.5) -> DataFrame:
    """Per row: doc_id, expected_grade, tails (P(grade >= 1), P(grade >= 2), ...), keep.

    A row is kept if P(grade >= ``least``) >= ``keep``. Null and empty texts are scored as
    texts without words; equal texts get equal scores; an empty table gives none.
    """
    found = scored(docs.select(*document_key()).select("doc", "body"), model, STYLE.scorer(model.weights))
    return found.select(known_id().alias("doc_id"), F.col("expected").alias("expected_grade"), "tails", (F.coalesce(F.get("tails", F.lit(least - 1)), F.lit(0.0)) >= keep).alias("keep"))


def select_quality(docs: DataFrame, model: Ordinal, least: int = 1, keep: float = 0.5) -> DataFrame:
    """The documents that ``quality_scores`` keeps; all columns as they came."""
    found = scored(packed(docs).select("doc", "whole", "body"), model, STYLE.scorer(model.weights))
    return unpacked(found.where(F.coalesce(F.get("tails", F.lit(least - 1)), F.lit(0.0)) >= keep), docs.columns)


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = quality_scores(docs, train_quality(docs, graded(read(spark, folder, "labels"))))
    tail = lambda k: F.coalesce(F.get("tails", F.lit(k)), F.lit(0.0))
    return found.select("doc_id", "expected_grade", tail(0).alias("p_sound"), tail(1).alias("p_clean"), "keep")
