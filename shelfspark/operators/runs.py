"""Forecast runs, their predictions and metrics, the SKU dimension, retention and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfspark.functions.metrics import METRIC_FUNCTIONS
from shelfspark.functions.scalars import as_col, normalize_sku
from shelfspark.functions.text import sku_text
from shelfspark.operators.ordered import top_rows
from shelfspark.operators.quality import duplicate_counts
from shelfspark.operators.summary import sku_day_rollup

# SKUs one batch request may name, days that runs with their predictions and jobs are kept.
BATCH_LIMIT, KEEP_DAYS, KEEP_JOB_DAYS = 100, 90, 30


class DuplicateKeys(ValueError):
    """A table that must be unique on its keys is not."""


# ---- run log ------------------------------------------------------------------------------------------------------


def run_state(events: DataFrame, order: Sequence[str] = ("at",)) -> DataFrame:
    """Current state of each run out of append-only records: its newest one. Combined before the shuffle."""
    rest = [c for c in events.columns if c != "run_id" and c not in order]
    newest = F.max_by(F.struct(*rest, *order), F.struct(*order)).alias("_s")
    return events.groupBy("run_id").agg(newest).select("run_id", "_s.*")


def run_log(records: DataFrame) -> DataFrame:
    """Runs out of the appended records of ``schema.RUN_RECORD``: start, end and outcome; equal records count once.

    Of records of one time an end comes after a start. One shuffle, combined before it.
    """
    ended = F.col("status") != "running"
    newest = F.max_by(F.struct("status", "error_message", "records_count"), F.struct("at", ended)).alias("_s")
    return records.groupBy("run_id").agg(
        F.max("horizon").alias("horizon"), F.max("model_type").alias("model_type"), newest,
        F.min(F.when(~ended, F.col("at"))).alias("started_at"), F.max(F.when(ended, F.col("at"))).alias("completed_at"),
    ).select("run_id", "horizon", "model_type", "_s.status", "started_at", "completed_at", "_s.error_message", "_s.records_count")


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest completed run, at most one row."""
    done = runs.where((F.col("status") == "completed") & F.col("completed_at").isNotNull())
    return done.orderBy(F.col("completed_at").desc(), F.col("run_id").desc()).limit(1)


def run_page(runs: DataFrame, skip: int = 0, limit: int = 10) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).offset(skip).limit(limit)


# ---- predictions --------------------------------------------------------------------------------------------------


def run_predictions(
    predictions: DataFrame,
    runs: DataFrame | None = None,
    run_id: int | None = None,
    sku: str | None = None,
    horizon: int | None = None,
    all_without_run: bool = False,
) -> DataFrame:
    """Rows of a run, by default the newest completed one; optionally one SKU and the first days of each.

    The run id enters as a scalar subquery, so a table partitioned by run reads one partition. Without a completed run
    the result is empty, or everything if ``all_without_run``.
    """
    if run_id is not None:
        chosen = predictions.where(F.col("run_id") == run_id)
    else:
        newest = latest_run(runs).agg(F.max("run_id")).scalar()
        match = F.col("run_id") == newest
        chosen = predictions.where(match | newest.isNull() if all_without_run else match)
    if sku is not None:
        chosen = chosen.where(F.col("sku_id") == normalize_sku(F.lit(sku)))
    if horizon is not None:
        chosen = top_rows(chosen, ["run_id", "sku_id"], [F.col("date")], horizon, rank="_rn").drop("_rn")
    return chosen


def batch_forecast(predictions: DataFrame, skus: Sequence[str], horizon: int = 14) -> DataFrame:
    """First days of up to 100 named SKUs. The list is part of the plan and is pushed into the scan."""
    wanted = _sku_list(skus)
    return top_rows(
        predictions.where(F.col("sku_id").isin(wanted)), ["sku_id"], [F.col("date")], horizon, rank="_rn"
    ).drop("_rn")


def batch_not_found(predictions: DataFrame, skus: Sequence[str]) -> DataFrame:
    wanted = _sku_list(skus)
    rows = predictions.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in wanted])).alias("sku_id"))
    return rows.join(predictions.where(F.col("sku_id").isin(wanted)).select("sku_id"), "sku_id", "left_anti")


def _sku_list(skus: Sequence[str]) -> list[str]:
    wanted = sorted({sku_text(s) for s in skus if s.strip()})
    if not wanted or len(wanted) > BATCH_LIMIT:
        raise ValueError(f"name 1 to {BATCH_LIMIT} SKUs")
    return wanted


def fill_actuals(predictions: DataFrame, sales: DataFrame) -> DataFrame:
    """Predictions with the units that were sold on their day, where known."""
    actual = sku_day_rollup(sales).select("sku_id", "date", F.col("units").alias("actual"))
    return predictions.drop("actual").join(actual, ["sku_id", "date"], "left")


def realised_error(filled: DataFrame, forecast: str = "ensemble") -> DataFrame:
    """Metrics of each run against the actual units."""
    return filled.groupBy("run_id").agg(
        F.count("actual").alias("known"),
        *[fn("actual", forecast).alias(name) for name, fn in METRIC_FUNCTIONS.items()],
    )


# ---- dimension ----------------------------------------------------------------------------------------------------


def join_dim(facts: DataFrame, dim: DataFrame, active_only: bool = False) -> DataFrame:
    """Facts of known SKUs with the dimension's columns. No hint: Spark broadcasts it only below its size limit."""
    side = dim.where("is_active") if active_only else dim
    return facts.join(side, "sku_id")


def new_skus(incoming: DataFrame, dim: DataFrame) -> DataFrame:
    keys = incoming.select(normalize_sku("sku_id").alias("sku_id")).where(F.col("sku_id").isNotNull()).distinct()
    return keys.join(dim.select("sku_id"), "sku_id", "left_anti")


def upsert_dim(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """The dimension plus a row for each SKU it lacks; a new SKU is active."""
    added = new_skus(incoming, dim).withColumn("is_active", F.lit(True))
    return dim.unionByName(added, allowMissingColumns=True)


def load_sales(sales: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Facts as rows of the history table, which is unique on (sku, date): stores are added up."""
    daily = sku_day_rollup(sales.withColumn("sku_id", normalize_sku("sku_id")))
    at = F.current_timestamp() if created_at is None else created_at
    return daily.select("sku_id", "date", "units", "revenue", "price", "promo_flag", at.alias("created_at"))


def load_predictions(forecast: DataFrame, run_id: int, created_at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if created_at is None else created_at
    return forecast.select(
        F.lit(run_id).cast("bigint").alias("run_id"), normalize_sku("sku_id").alias("sku_id"), "date",
        *[F.col(c).cast("double").alias(c) for c in ("prophet", "xgb", "lgbm", "ensemble", "p_low", "p_high")],
        F.lit(None).cast("double").alias("actual"), at.alias("created_at"),
    )


def load_metrics(evaluation: DataFrame, run_id: int, created_at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if created_at is None else created_at
    return evaluation.select(
        F.lit(run_id).cast("bigint").alias("run_id"), normalize_sku("sku_id").alias("sku_id"), "mape_prophet",
        "mape_xgboost", F.col("mape_ens").alias("mape_ensemble"), "mape_naive", "best_model", at.alias("created_at"),
    )


# ---- retention and keys -------------------------------------------------------------------------------------------


def expired(column: str, as_of: Column | str, days: int) -> Column:
    return F.col(column) < F.timestamp_add("DAY", F.lit(-days), as_col(as_of).cast("timestamp"))


def retained(df: DataFrame, column: str, as_of: Column | str, days: int = KEEP_DAYS) -> DataFrame:
    """Rows not older than ``days``; rows without a time are kept."""
    return df.where(~F.coalesce(expired(column, as_of, days), F.lit(False)))


def expired_counts(tables: dict[str, tuple[DataFrame, str]], as_of: Column | str, days: int = KEEP_DAYS) -> DataFrame:
    """How many rows of each table retention removes and keeps; one scan per table."""
    parts = []
    for name, (df, column) in tables.items():
        old = F.count_if(expired(column, as_of, days))
        parts.append(
            df.agg(old.alias("deleted"), (F.count("*") - old).alias("kept")).select(
                F.lit(name).alias("table_name"), "deleted", "kept"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cascade_delete(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows that survive the deletion of the given parents."""
    return children.join(deleted.select(key).distinct(), key, "left_anti")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Guard before a write: raise if a key occurs twice."""
    repeats = duplicate_counts(df.select(*keys), keys).first().key_duplicates
    if repeats:
        raise DuplicateKeys(f"{repeats} rows repeat {list(keys)}")
    return df
