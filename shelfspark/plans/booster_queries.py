"""Queries of the boosters in full size. They take minutes, most of it job latency of hundreds of trees."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from shelfspark.functions import scalars
from shelfspark.operators import backtest, boosters, forecast
from shelfspark.plans.forecast_queries import ADDITIVE_SQL, EVALUATION_SQL, FUTURE_SQL, GAPLESS_SQL, gapless
from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import SKU_SQL
from shelfspark.session import shared_folder
from shelfspark.sources import catalogue

#: Run last, as they fit models.
NAMES = ["forecast_gbt_small", "forecast_gbt_full", "feature_importance", "model_store", "forecast_all", "backtest_models"]


def model_folder(spark, sf):
    """One store of fitted models for each set of tables and session, so that queries on the same models fit them once."""
    tables = hashlib.sha256(sf.encode()).hexdigest()[:16]
    return f"{shared_folder(spark).rstrip('/')}/models-{spark.sparkContext.applicationId}-{tables}"


def _models(spark, sf, *names):
    table = boosters.training_table(gapless(spark, sf))
    return table, boosters.models_of(table, model_folder(spark, sf), names=names or ("xgb", "lgbm"))


def _days_ahead(df, name):
    return df.select("sku_id", "date", scalars.is_finite(name).alias("finite"))


AHEAD_SQL = "WITH " + GAPLESS_SQL + ", " + FUTURE_SQL + " SELECT sku_id, date, true AS finite FROM fut"


@query("forecast_gbt_small", AHEAD_SQL)
def forecast_gbt_small(spark, sf):
    """Every day of the horizon has a finite value; the values themselves depend on the tree library."""
    table, models = _models(spark, sf, "xgb")
    return _days_ahead(boosters.recursive_score(models["xgb"], boosters.trailing_state(table), 14, "xgb"), "xgb")


@query("forecast_gbt_full", AHEAD_SQL)
def forecast_gbt_full(spark, sf):
    table, models = _models(spark, sf, "lgbm")
    return _days_ahead(boosters.recursive_score(models["lgbm"], boosters.trailing_state(table), 14, "lgbm"), "lgbm")


IMPORTANCE_SQL = " UNION ALL ".join(f"SELECT '{f}' AS feature, true AS non_negative, 1.0::DOUBLE AS total" for f in boosters.FULL_FEATURES)


@query("feature_importance", IMPORTANCE_SQL)
def feature_importance(spark, sf):
    weights = boosters.importances(_models(spark, sf, "lgbm")[1]["lgbm"], boosters.FULL_FEATURES)
    rows = spark.createDataFrame(sorted(weights.items()), "feature string, importance double")
    return rows.select(
        "feature", (F.col("importance") >= 0).alias("non_negative"),
        F.round(F.lit(sum(weights.values())), 6).alias("total"),
    )


STORE_SQL = (
    "WITH " + GAPLESS_SQL + ", fitted AS (SELECT count(*) AS n FROM sku GROUP BY sku_id HAVING count(*) >= 30 AND sum(units) <> 0) "
    "SELECT model_type, '1' AS version, CASE WHEN model_type = 'prophet' THEN (SELECT sum(n) FROM fitted) ELSE (SELECT count(*) FROM sku) END::BIGINT "
    "AS trained_on_rows, trees, true AS is_active, true AS is_current, true AS same_scores "
    "FROM (VALUES ('xgb', 500), ('lgbm', 500), ('prophet', NULL)) t(model_type, trees)"
)


@query("model_store", STORE_SQL)
def model_store(spark, sf):
    """The registry rows of the stored models, and whether a model that is loaded again scores as before."""
    folder = model_folder(spark, sf)
    series = gapless(spark, sf)
    table, models = _models(spark, sf)
    again = boosters.models_of(table, folder)
    same = {}
    for name, model in models.items():
        both = model.transform(table).select("sku_id", "date", F.col("forecast").alias("a")).join(
            again[name].transform(table).select("sku_id", "date", F.col("forecast").alias("b")), ["sku_id", "date"]
        )
        same[name] = both.agg(F.coalesce(F.bool_and(F.col("a") == F.col("b")), F.lit(False))).scalar()
    forecast.stored_parameters(series, folder, "1")
    loaded = forecast.additive_predict(forecast.stored_parameters(series, folder, "1")).select("sku_id", "date", F.col("prophet").alias("a"))
    fresh = forecast.additive(series).select("sku_id", "date", F.col("prophet").alias("b"))
    close = F.abs(F.col("a") - F.col("b")) <= 1e-9 * (1 + F.abs(F.col("b")))
    same["prophet"] = loaded.join(fresh, ["sku_id", "date"], "full").agg(F.coalesce(F.bool_and(F.coalesce(close, F.lit(False))), F.lit(False))).scalar()
    rows = catalogue.registry(spark, folder).where("version = '1'")
    newest = catalogue.current(rows).select(F.col("model_type"), F.col("version"), F.lit(True).alias("is_current"))
    told = F.create_map(*[c for name, value in same.items() for c in (F.lit(name), value)])
    return rows.join(newest, ["model_type", "version"], "left").select(
        "model_type", "version", "trained_on_rows", F.get_json_object("hyperparameters", "$.trees").cast("int").alias("trees"),
        "is_active", F.coalesce("is_current", F.lit(False)).alias("is_current"), F.element_at(told, F.col("model_type")).alias("same_scores"),
    )


@query(
    "forecast_all",
    ADDITIVE_SQL.replace(SKU_SQL, GAPLESS_SQL)
    + "SELECT sku_id, date, round(prophet, 4) AS prophet, round(prophet - 1.959963984540054 * sigma, 4) AS p_low, "
    "round(prophet + 1.959963984540054 * sigma, 4) AS p_high, true AS finite, true AS is_mean FROM additive",
)
def forecast_all(spark, sf):
    """All SKUs with the additive part exactly, and whether the boosters are finite and the ensemble is their mean."""
    series = gapless(spark, sf)
    out = forecast.forecast_all(series, boosters.forecast(series, store=model_folder(spark, sf)))
    mean = (F.col("prophet") + F.col("xgb") + F.col("lgbm")) / 3
    flagged = out.withColumns({
        "finite": scalars.is_finite("xgb") & scalars.is_finite("lgbm"),
        "is_mean": F.abs(F.col("ensemble") - mean) < 1e-6 * (1 + F.abs(mean)),
    })
    return rounded(flagged.select("sku_id", "date", "prophet", "p_low", "p_high", "finite", "is_mean"))


@query(
    "backtest_models",
    EVALUATION_SQL.replace(SKU_SQL, GAPLESS_SQL) + "SELECT sku_id, n_folds, "
    + ", ".join(f"{m}_{p}" for p in ("prophet", "naive") for m in ("mae", "rmse", "mape", "smape"))
    + ", true AS finite, true AS has_best FROM evaluation",
)
def backtest_models(spark, sf):
    """Evaluation of all five models: the plain ones exactly, the boosters by their properties."""
    out = backtest.evaluation_table(boosters.backtest(gapless(spark, sf)))
    finite = F.lit(True)
    for model in ("xgboost", "lightgbm", "ens"):
        for m in ("mae", "rmse", "smape"):
            finite = finite & scalars.is_finite(f"{m}_{model}") & (F.col(f"{m}_{model}") >= 0)
    plain = [f"{m}_{p}" for p in ("prophet", "naive") for m in ("mae", "rmse", "mape", "smape")]
    return out.select("sku_id", "n_folds", *plain, finite.alias("finite"), F.col("best_model").isNotNull().alias("has_best"))
