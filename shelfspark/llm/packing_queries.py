"""The query of best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import packing
from shelfspark.llm.common import table
from shelfspark.llm.registry import query


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))
