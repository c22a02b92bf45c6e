"""Combining model outputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def mean_of_known(models: Sequence[str]) -> Column:
    """Mean of the forecasts that are there; NULL when none is."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(m), F.lit(0.0)) for m in models])
    known = reduce(lambda a, b: a + b, [F.col(m).isNotNull().cast("int") for m in models])
    return F.try_divide(total, known)


def join_forecasts(*forecasts: DataFrame, keys: Sequence[str] = ("sku_id", "date")) -> DataFrame:
    """Full outer join of model outputs: a model that failed for a SKU leaves NULLs, not gaps."""
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), forecasts)


def ensemble(forecasts: DataFrame, models: Sequence[str] = ("prophet", "xgb", "lgbm")) -> DataFrame:
    present = [m for m in models if m in forecasts.columns]
    return forecasts.withColumn("ensemble", mean_of_known(present))
