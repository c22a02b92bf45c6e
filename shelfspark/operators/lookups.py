"""The documented table lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def active_skus(dim: DataFrame, category: str | None = None, store: str | None = None) -> DataFrame:
    out = dim.where("is_active")
    if category is not None:
        out = out.where(F.col("category") == category)
    if store is not None:
        out = out.where(F.col("store_id") == store)
    return out


def predictions_from(predictions: DataFrame, date: str) -> DataFrame:
    return predictions.where(F.col("date") >= F.lit(date).cast("date")).orderBy(F.col("date").desc(), "sku_id", "run_id")


def runs_with_status(runs: DataFrame, status: str, limit: int | None = None) -> DataFrame:
    out = runs.where(F.col("status") == status).orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    return out if limit is None else out.limit(limit)


def best_by_model(metrics: DataFrame, model: str) -> DataFrame:
    return metrics.where(F.col("best_model") == model)


def promo_sales(history: DataFrame) -> DataFrame:
    return history.where(F.col("promo_flag") == 1)


def sales_history(
    history: DataFrame, sku: str | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """History rows by SKU and date; the filters reach the scan."""
    if sku is not None:
        history = history.where(F.col("sku_id") == sku.strip().upper())
    if start is not None:
        history = history.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        history = history.where(F.col("date") <= F.lit(end).cast("date"))
    return history.orderBy("sku_id", "date")


def recent_events(log: DataFrame, event_type: str, limit: int = 100) -> DataFrame:
    return log.where(F.col("event_type") == event_type).orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)


def events_of_severity(log: DataFrame, severity: str) -> DataFrame:
    return log.where(F.col("severity") == severity).orderBy(F.col("created_at").desc(), F.col("id").desc())


def expired_keys(keys: DataFrame, as_of: Column) -> DataFrame:
    return keys.where(F.col("expires_at") < as_of)


def locked_accounts(accounts: DataFrame, as_of: Column) -> DataFrame:
    """Accounts locked at ``as_of`` and the started minutes that remain."""
    seconds = F.unix_micros("locked_until") - F.unix_micros(as_of)
    minutes = F.floor(seconds / 60_000_000) + 1
    locked = accounts.where(F.col("locked_until").isNotNull() & (F.col("locked_until") > as_of))
    return locked.withColumn("remaining_minutes", minutes.cast("bigint"))
