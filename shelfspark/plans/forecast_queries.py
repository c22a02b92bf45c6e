"""Backtest, metric and forecast queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import scalars
from shelfspark.operators import backtest, ensemble, forecast, summary
from shelfspark.plans.prepare_queries import CLEAN_SQL, cleaned
from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import PREDICTIONS_SQL, SKU_SQL, predictions, sales_sku

# Cleaned units per SKU and day, without gaps, in the place of the plain daily sums.
GAPLESS_SQL = CLEAN_SQL + ", sku AS (SELECT date, sku_id, sum(units) AS units FROM capped GROUP BY date, sku_id)"

FOLD_SQL = "WITH " + SKU_SQL + """,
pos AS (SELECT *, count(*) OVER (PARTITION BY sku_id) AS n,
               row_number() OVER (PARTITION BY sku_id ORDER BY date DESC) - 1 AS back FROM sku),
nf AS (SELECT *, CASE WHEN n >= 56 THEN 3 WHEN n >= 90 THEN least(greatest(2, n // 14 - 1), 3) ELSE 0 END AS n_folds FROM pos),
fold AS (SELECT sku_id, date, units, CAST(n_folds AS INTEGER) AS n_folds, CAST(f AS INTEGER) AS fold,
                CASE WHEN back >= (f + 1) * 14 THEN 'train' WHEN back >= f * 14 THEN 'test' END AS role
         FROM nf, generate_series(0, 2) g(f) WHERE f < n_folds AND n - (f + 1) * 14 >= 30),
tt AS (SELECT *, CAST(date - min(date) OVER (PARTITION BY sku_id, fold) AS DOUBLE) AS t, isodow(date) - 1 AS dow
       FROM fold WHERE role IS NOT NULL),
ln AS (SELECT sku_id, fold, regr_slope(units, t) AS b, regr_intercept(units, t) AS a, max_by(units, date) AS naive,
              count(*) AS k, sum(units) AS s FROM tt WHERE role = 'train' GROUP BY 1, 2),
ef AS (SELECT sku_id, fold, dow, avg(units - a - b * t) AS e FROM tt JOIN ln USING (sku_id, fold)
       WHERE role = 'train' GROUP BY 1, 2, 3),
sc AS (SELECT tt.sku_id, tt.fold, tt.date, tt.units, tt.n_folds, naive,
              CASE WHEN k >= 30 AND s <> 0 THEN a + b * t + coalesce(e, 0) END AS prophet
       FROM tt JOIN ln USING (sku_id, fold) LEFT JOIN ef USING (sku_id, fold, dow) WHERE role = 'test')
"""


def folds(spark, sf):
    return backtest.fold_bounds(sales_sku(spark, sf))


def scored(spark, sf):
    """Naive and additive forecasts on every fold; the ensemble has the additive part only."""
    both = backtest.add_additive(backtest.add_naive(folds(spark, sf)))
    return backtest.score(both, {"naive": "naive", "prophet": "prophet"})


def evaluation(spark, sf):
    return backtest.evaluation_table(scored(spark, sf))


@query(
    "fold_bounds",
    FOLD_SQL + "SELECT sku_id, fold, role, max(n_folds) AS n_folds, count(*) AS n, min(date) AS first, max(date) AS last, "
    "sum(units) AS units FROM fold WHERE role IS NOT NULL GROUP BY 1, 2, 3",
)
def fold_bounds(spark, sf):
    return folds(spark, sf).groupBy("sku_id", "fold", "role").agg(
        F.max("n_folds").alias("n_folds"), F.count("*").alias("n"), F.min("date").alias("first"),
        F.max("date").alias("last"), F.sum("units").alias("units"),
    )


@query("folds", FOLD_SQL + "SELECT sku_id, date, fold, units FROM fold WHERE role = 'test'")
def test_rows(spark, sf):
    return folds(spark, sf).where(F.col("role") == "test").select("sku_id", "date", "fold", "units")


@query("backtest_naive", FOLD_SQL + "SELECT sku_id, fold, date, units, naive FROM sc")
def backtest_naive(spark, sf):
    out = backtest.add_naive(folds(spark, sf)).where(F.col("role") == "test")
    return out.select("sku_id", "fold", "date", "units", "naive")


@query("backtest_additive", FOLD_SQL + "SELECT sku_id, fold, date, units, round(prophet, 4) AS prophet FROM sc")
def backtest_additive(spark, sf):
    out = backtest.add_additive(folds(spark, sf)).where(F.col("role") == "test")
    return rounded(out.select("sku_id", "fold", "date", "units", "prophet"))


def _metric_sql(p: str) -> dict[str, str]:
    return {
        "mae": f"avg(abs(units - {p}))",
        "rmse": f"sqrt(avg((units - {p}) ** 2))",
        "mape": f"avg(abs((units - {p}) / units)) FILTER (units > 0) * 100",
        "smape": f"avg(abs(units - {p}) / CASE WHEN abs(units) + abs({p}) = 0 THEN 1 ELSE (abs(units) + abs({p})) / 2 END) * 100",
    }


@query("mae", FOLD_SQL + f"SELECT sku_id, round({_metric_sql('naive')['mae']}, 6) AS mae FROM sc GROUP BY 1")
def mae(spark, sf):
    return rounded(_errors(spark, sf).select("sku_id", "mae"), 6)


@query("rmse", FOLD_SQL + f"SELECT sku_id, round({_metric_sql('naive')['rmse']}, 6) AS rmse FROM sc GROUP BY 1")
def rmse(spark, sf):
    return rounded(_errors(spark, sf).select("sku_id", "rmse"), 6)


@query("mape", FOLD_SQL + f"SELECT sku_id, round({_metric_sql('naive')['mape']}, 6) AS mape FROM sc GROUP BY 1")
def mape(spark, sf):
    return rounded(_errors(spark, sf).select("sku_id", "mape"), 6)


@query("smape", FOLD_SQL + f"SELECT sku_id, round({_metric_sql('naive')['smape']}, 6) AS smape FROM sc GROUP BY 1")
def smape(spark, sf):
    return rounded(_errors(spark, sf).select("sku_id", "smape"), 6)


def _errors(spark, sf):
    return backtest.error_table(backtest_naive(spark, sf), ["sku_id"])


_PER_FOLD = ", ".join(f"{sql} AS {m}_{name}" for name in ("prophet", "naive") for m, sql in _metric_sql(name).items())
_MEANS = ", ".join(
    f"round_even(avg({m}_{name}), 2) AS {m}_{name}" for name in ("prophet", "naive") for m in _metric_sql(name)
)
EVALUATION_SQL = FOLD_SQL + f""",
pf AS (SELECT sku_id, fold, max(n_folds) AS n_folds, {_PER_FOLD} FROM sc GROUP BY 1, 2),
ev AS (SELECT sku_id, max(n_folds) AS n_folds, {_MEANS} FROM pf GROUP BY 1),
evaluation AS (SELECT *, mae_prophet AS mae_ens, rmse_prophet AS rmse_ens, mape_prophet AS mape_ens, smape_prophet AS smape_ens,
  CASE WHEN coalesce(mape_prophet, 999) <= coalesce(mape_naive, 999) THEN 'prophet' ELSE 'naive' END AS best_model FROM ev)
"""


@query(
    "evaluation_table",
    EVALUATION_SQL + "SELECT sku_id, n_folds, mae_prophet, rmse_prophet, mape_prophet, smape_prophet, mae_naive, rmse_naive, "
    "mape_naive, smape_naive, mae_ens, mape_ens, best_model FROM evaluation",
)
def evaluation_table(spark, sf):
    return evaluation(spark, sf).select(
        "sku_id", "n_folds", "mae_prophet", "rmse_prophet", "mape_prophet", "smape_prophet", "mae_naive", "rmse_naive",
        "mape_naive", "smape_naive", "mae_ens", "mape_ens", "best_model",
    )


@query("best_model", EVALUATION_SQL + "SELECT sku_id, best_model FROM evaluation")
def best_model(spark, sf):
    return evaluation(spark, sf).select("sku_id", "best_model")


MEANS_SQL = EVALUATION_SQL + ", mm AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, round(avg(mape_{m}), 4) AS mape, round(avg(mae_{m}), 4) AS mae, round(avg(rmse_{m}), 4) AS rmse FROM evaluation"
    for m in ("prophet", "naive", "ens")
) + "".join(f" UNION ALL SELECT '{m}', NULL, NULL, NULL" for m in ("xgboost", "lightgbm")) + ") "


@query("model_means", MEANS_SQL + "SELECT * FROM mm")
def model_means(spark, sf):
    return rounded(summary.model_means(evaluation(spark, sf)))


@query("model_wins", EVALUATION_SQL + "SELECT best_model, count(*) AS wins FROM evaluation GROUP BY 1")
def model_wins(spark, sf):
    return summary.model_wins(evaluation(spark, sf))


@query(
    "evaluation_summary",
    MEANS_SQL + "SELECT mm.*, (SELECT best_model FROM evaluation GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS most_wins FROM mm",
)
def evaluation_summary(spark, sf):
    table = evaluation(spark, sf)
    means = summary.model_means(table)
    return rounded(means.withColumn("most_wins", summary.most_wins(table).select("best_model").scalar()))


def _box_sql(metric: str, model: str) -> str:
    c = f"{metric}_{model}"
    return f"""SELECT '{metric}' AS metric, '{model}' AS model, count({c}) AS n, round(min({c}), 4) AS min, round(any_value(q1), 4) AS q25,
      round(any_value(q2), 4) AS median, round(any_value(q3), 4) AS q75, round(max({c}), 4) AS max,
      round(min({c}) FILTER ({c} >= 2.5 * q1 - 1.5 * q3), 4) AS whisker_low, round(max({c}) FILTER ({c} <= 2.5 * q3 - 1.5 * q1), 4) AS whisker_high,
      count(*) FILTER ({c} < 2.5 * q1 - 1.5 * q3 OR {c} > 2.5 * q3 - 1.5 * q1) AS outliers
      FROM evaluation, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM evaluation)"""


@query(
    "box_stats",
    EVALUATION_SQL + " UNION ALL ".join(_box_sql(m, n) for m in ("mape", "mae", "rmse") for n in ("prophet", "naive", "ens")),
)
def box_stats(spark, sf):
    return rounded(summary.box_stats(evaluation(spark, sf)))


@query(
    "sku_passport",
    EVALUATION_SQL + " UNION ALL ".join(
        f"SELECT sku_id, '{m}' AS model, mae_{m} AS mae, rmse_{m} AS rmse, mape_{m} AS mape, smape_{m} AS smape, "
        f"best_model = '{m}' AS is_best FROM evaluation WHERE sku_id = 'SKU007'"
        for m in ("prophet", "naive", "ens")
    ) + "".join(
        f" UNION ALL SELECT sku_id, '{m}', NULL, NULL, NULL, NULL, false FROM evaluation WHERE sku_id = 'SKU007'"
        for m in ("xgboost", "lightgbm")
    ),
)
def sku_passport(spark, sf):
    return summary.sku_passport(evaluation(spark, sf), "SKU007")


# ---- forecasts ----------------------------------------------------------------------------------------------------


@query(
    "last_value",
    "WITH " + SKU_SQL + " SELECT sku_id, max(date) AS last_date, max_by(units, date) AS last_units FROM sku GROUP BY 1",
)
def last_value(spark, sf):
    return forecast.last_value(sales_sku(spark, sf))


FUTURE_SQL = """fut AS (SELECT sku_id, CAST(max(date) + CAST(s AS INTEGER) AS DATE) AS date, max_by(units, sku.date) AS naive
  FROM sku, generate_series(1, 14) g(s) GROUP BY sku_id, s)"""


@query("forecast_naive", "WITH " + SKU_SQL + ", " + FUTURE_SQL + " SELECT sku_id, date, naive FROM fut")
def forecast_naive(spark, sf):
    return forecast.naive(sales_sku(spark, sf))


@query("day_offset", "WITH " + SKU_SQL + ", " + FUTURE_SQL + " SELECT sku_id, date FROM fut")
def day_offset(spark, sf):
    return forecast.future_days(forecast.last_value(sales_sku(spark, sf)), 14).select("sku_id", "date")


ADDITIVE_SQL = "WITH " + SKU_SQL + """,
h AS (SELECT *, min(date) OVER (PARTITION BY sku_id) AS d0, isodow(date) - 1 AS dow FROM sku),
p AS (SELECT sku_id, d0, max(date) AS d1, regr_slope(units, CAST(date - d0 AS DOUBLE)) AS b,
             regr_intercept(units, CAST(date - d0 AS DOUBLE)) AS a FROM h GROUP BY 1, 2 HAVING count(*) >= 30 AND sum(units) <> 0),
r AS (SELECT h.*, a, b, d1, units - a - b * (date - h.d0) AS rest FROM h JOIN p USING (sku_id)),
e AS (SELECT sku_id, dow, avg(rest) AS e FROM r GROUP BY 1, 2),
g AS (SELECT sku_id, stddev_samp(rest - e) AS sigma FROM r JOIN e USING (sku_id, dow) GROUP BY 1),
f AS (SELECT sku_id, CAST(d1 + CAST(s AS INTEGER) AS DATE) AS date, d0, a, b FROM p, generate_series(1, 14) t(s)),
additive AS (SELECT f.sku_id, f.date, a + b * (f.date - d0) + coalesce(e, 0) AS prophet, sigma FROM f JOIN g USING (sku_id)
             LEFT JOIN e ON e.sku_id = f.sku_id AND e.dow = isodow(f.date) - 1)
"""


@query(
    "forecast_additive",
    ADDITIVE_SQL + "SELECT sku_id, date, round(prophet, 4) AS prophet, round(prophet - 1.959963984540054 * sigma, 4) AS p_low, "
    "round(prophet + 1.959963984540054 * sigma, 4) AS p_high FROM additive",
)
def forecast_additive(spark, sf):
    return rounded(forecast.additive(sales_sku(spark, sf)))


@query(
    "clip_non_negative",
    ADDITIVE_SQL + "SELECT sku_id, date, round(greatest(prophet, 0), 4) AS prophet, "
    "round(greatest(prophet - 1.2815515655446008 * sigma, 0), 4) AS p_low, "
    "round(greatest(prophet + 1.2815515655446008 * sigma, 0), 4) AS p_high FROM additive",
)
def clip_non_negative(spark, sf):
    return rounded(forecast.additive(sales_sku(spark, sf), interval_width=0.8, non_negative=True))


@query("forecast_curved")
def forecast_curved(spark, sf):
    return rounded(forecast.curved(sales_sku(spark, sf)))


CURVED_SQL = ADDITIVE_SQL + "SELECT sku_id, date, true AS finite, true AS ordered FROM additive"


def _curve_flags(df):
    finite = scalars.is_finite("prophet") & scalars.is_finite("p_low") & scalars.is_finite("p_high")
    ordered = (F.col("p_low") <= F.col("prophet")) & (F.col("prophet") <= F.col("p_high"))
    return df.select("sku_id", "date", finite.alias("finite"), ordered.alias("ordered"))


@query("forecast_curved_days", CURVED_SQL)
def forecast_curved_days(spark, sf):
    """The days, and properties of the values, which depend on the fit."""
    return _curve_flags(forecast.curved(sales_sku(spark, sf)))


@query("forecast_yearly_days", CURVED_SQL)
def forecast_yearly_days(spark, sf):
    return _curve_flags(forecast.curved(sales_sku(spark, sf), yearly=True))


@query(
    "ensemble",
    "WITH " + PREDICTIONS_SQL + " SELECT run_id, sku_id, date, round(ensemble, 4) AS ensemble FROM pred",
)
def ensemble_mean(spark, sf):
    out = ensemble.ensemble(predictions(spark, sf).drop("ensemble"))
    return rounded(out.select("run_id", "sku_id", "date", "ensemble"))


@query(
    "join_forecasts",
    "WITH " + PREDICTIONS_SQL + ", a AS (SELECT CASE sku_id WHEN 'SKU002' THEN 'SKU902' ELSE sku_id END AS sku_id, date, prophet FROM pred), "
    "b AS (SELECT sku_id, CAST(CASE WHEN lgbm IS NULL THEN date + 100 ELSE date END AS DATE) AS date, coalesce(lgbm, 0) AS lgbm FROM pred) "
    "SELECT sku_id, date, round(prophet, 4) AS prophet, round(lgbm, 4) AS lgbm FROM a FULL JOIN b USING (sku_id, date)",
)
def join_forecasts(spark, sf):
    """All predictions; a renamed SKU and shifted days have no partner on the other side."""
    rows = predictions(spark, sf)
    sku = F.when(F.col("sku_id") == "SKU002", "SKU902").otherwise(F.col("sku_id"))
    day = F.when(F.col("lgbm").isNull(), F.date_add("date", 100)).otherwise(F.col("date"))
    a = rows.select(sku.alias("sku_id"), "date", "prophet")
    b = rows.select("sku_id", day.alias("date"), F.coalesce("lgbm", F.lit(0.0)).alias("lgbm"))
    return rounded(ensemble.join_forecasts(a, b))


@query(
    "forecast_mean",
    "WITH " + PREDICTIONS_SQL + " SELECT sku_id, round(avg(prophet), 4) AS prophet, round(avg(xgb), 4) AS xgb, "
    "round(avg(lgbm), 4) AS lgbm, round(avg(ensemble), 4) AS ensemble FROM pred GROUP BY 1",
)
def forecast_mean(spark, sf):
    return rounded(summary.forecast_mean(predictions(spark, sf)))


def gapless(spark, sf):
    """Cleaned units per SKU and day, without gaps: what the boosters read."""
    return backtest.daily_series(cleaned(spark, sf))
