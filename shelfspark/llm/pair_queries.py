"""Queries of the operators that compare documents with each other or with a benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfspark.llm import decontaminate, simhash
from shelfspark.llm.common import table
from shelfspark.llm.registry import query


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
