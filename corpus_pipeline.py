"""Documents to training sequences: language, exact copies, near copies, benchmark passages, packing.

Every stage works on all that the one before it kept. Its result is written as Parquet in the shared folder and read
again, so a lost executor costs at most a stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import decontaminate, exact_dedup, language_id, packing, simhash
from shelfspark.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The words of a fingerprint and the bits in which near copies may differ.
SHINGLE, RADIUS = 4, 4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told (no letters, or two codewords as near); learns from those not held out."""
    return language_id.known_language(docs, language_id.learn(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the row with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the row with the smallest id stays."""
    return simhash.keep_one(docs, words=SHINGLE, radius=RADIUS)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the bins they go into."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("decontamination", leaks),
    ("best_fit_packing", sequences),
]

#: The stages rest on a learnt model, connected groups, edit distances and packing, which SQL cannot express; tests compare
#: the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
