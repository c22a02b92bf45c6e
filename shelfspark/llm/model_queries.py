"""Queries of the operators that learn from labelled rows: language ID, quality, toxicity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfspark.llm import language_id, quality, toxicity
from shelfspark.llm.common import held_out, table
from shelfspark.llm.registry import query


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").filter(~held_out(F.col("doc_id")))
    scores = quality.quality_scores(table(spark, folder, "documents"), labels)
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").filter(~held_out(F.col("doc_id")))
    scores = toxicity.toxicity_scores(table(spark, folder, "documents"), labels)
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
