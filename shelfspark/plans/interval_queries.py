"""Queries of skipped folds, the curved backtest and intervals that widen with the horizon."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import backtest, forecast, intervals
from shelfspark.plans.forecast_queries import ADDITIVE_SQL, EVALUATION_SQL, FOLD_SQL, GAPLESS_SQL, folds, gapless
from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import SKU_SQL, sales_sku

#: Horizons so long that some series of the test tables lack folds, or all of them.
LONG, LONGEST = 700, 1300


def _with_folds(sql: str, horizon: int, n_folds: int) -> str:
    return (
        sql.replace("n >= 56 THEN 3", f"n >= {horizon * (n_folds + 1)} THEN {n_folds}")
        .replace("n // 14 - 1), 3)", f"n // {horizon} - 1), {n_folds})")
        .replace("generate_series(0, 2)", f"generate_series(0, {n_folds - 1})")
        .replace("* 14", f"* {horizon}")
    )


def _skipped_sql(horizon: int) -> str:
    return f"""skipped AS (SELECT * FROM (
  SELECT sku_id, rows, n_folds, f AS fold,
         CASE WHEN n_folds = 0 THEN 'short series' WHEN f >= n_folds THEN 'shorter series'
              WHEN rows - (f + 1) * {horizon} < 30 THEN 'few training rows' END AS reason
  FROM (SELECT sku_id, n AS rows, CASE WHEN n >= {horizon * 4} THEN 3
               WHEN n >= 90 THEN least(greatest(2, n // {horizon} - 1), 3) ELSE 0 END AS n_folds
        FROM (SELECT sku_id, count(*) AS n FROM sku GROUP BY 1)), (VALUES (0), (1), (2)) t(f)) WHERE reason IS NOT NULL)
"""


@query(
    "skipped_folds",
    "WITH " + SKU_SQL + ", " + _skipped_sql(LONG)
    + "SELECT sku_id, rows::INT AS rows, n_folds::INT AS n_folds, fold::INT AS fold, reason FROM skipped",
)
def skipped_folds(spark, sf):
    return backtest.skipped_folds(sales_sku(spark, sf), LONG)


@query(
    "evaluation_complete",
    _with_folds(EVALUATION_SQL, LONGEST, 3) + ", " + _skipped_sql(LONGEST)
    + "SELECT sku_id, n_folds, mae_prophet, mape_naive, best_model, NULL::VARCHAR AS reason FROM evaluation UNION ALL "
    "SELECT sku_id, 0, NULL, NULL, NULL, arg_min(reason, fold) FROM skipped WHERE sku_id NOT IN (SELECT sku_id FROM evaluation) GROUP BY sku_id",
)
def evaluation_complete(spark, sf):
    """Every SKU has a row, those that were not evaluated with their reason."""
    series = sales_sku(spark, sf)
    placed = backtest.add_additive(backtest.add_naive(backtest.fold_bounds(series, LONGEST)))
    table = backtest.evaluation_table(backtest.score(placed, {"naive": "naive", "prophet": "prophet"}))
    full = backtest.with_skipped(table, backtest.skipped_folds(series, LONGEST))
    return full.select("sku_id", "n_folds", "mae_prophet", "mape_naive", "best_model", "reason")


@query("backtest_curved", FOLD_SQL + "SELECT sku_id, fold, date, units, naive, prophet IS NOT NULL AS fitted, true AS agrees FROM sc")
def backtest_curved(spark, sf):
    """The curved model on all folds from running sums, and whether it agrees with a fit of its own for each fold."""
    placed = backtest.add_naive(folds(spark, sf))
    at_once = forecast.add_curved(placed).where(F.col("role") == "test")
    # the single fits forecast days in a row, so days are compared where both have them
    single = forecast.curved(placed.where(F.col("role") == "train"), 60, by=("sku_id", "fold")).select("sku_id", "fold", "date", F.col("prophet").alias("_p"))
    both = at_once.join(single, ["sku_id", "fold", "date"], "left")
    close = F.abs(F.col("prophet") - F.col("_p")) <= 1e-6 * (1 + F.abs(F.col("_p")))
    return both.select(
        "sku_id", "fold", "date", "units", "naive", F.col("prophet").isNotNull().alias("fitted"), F.coalesce(close, F.lit(False)).alias("agrees")
    )


WIDTH_SQL = _with_folds(FOLD_SQL, 14, intervals.ORIGINS).replace(SKU_SQL, GAPLESS_SQL) + """,
sg AS (SELECT tt.sku_id, tt.fold, stddev_samp(units - (a + b * t + coalesce(e, 0))) AS sd, max(date) AS origin
       FROM tt JOIN ln USING (sku_id, fold) LEFT JOIN ef USING (sku_id, fold, dow) WHERE role = 'train' AND k >= 30 AND s <> 0 GROUP BY 1, 2),
scores AS (SELECT CAST(date - origin AS INTEGER) AS step, abs(units - prophet) / sd AS score FROM sc JOIN sg USING (sku_id, fold) WHERE sd > 0),
wq AS (SELECT step, count(*) AS n, quantile_cont(score, 0.95) AS quantile FROM scores GROUP BY 1),
mean AS (SELECT i.step AS i, j.step AS j, sum(w.quantile * w.n) / sum(w.n) AS m
         FROM wq i JOIN wq j ON i.step <= j.step JOIN wq w ON w.step BETWEEN i.step AND j.step GROUP BY 1, 2),
low AS (SELECT wq.step, i, min(m) AS m FROM wq JOIN mean ON i <= step AND j >= step GROUP BY 1, 2),
widths AS (SELECT wq.*, f.factor FROM wq JOIN (SELECT step, max(m) AS factor FROM low GROUP BY 1) f USING (step))
"""


@query("interval_widths", WIDTH_SQL + "SELECT step, n, round(quantile, 4) AS quantile, round(factor, 4) AS factor FROM widths")
def interval_widths(spark, sf):
    return rounded(intervals.pooled_widths(intervals.rolling_scores(gapless(spark, sf))))


@query(
    "forecast_interval",
    WIDTH_SQL + ADDITIVE_SQL[len("WITH " + SKU_SQL):] + "SELECT sku_id, date, round(prophet, 4) AS prophet, "
    "round(prophet - factor * sigma, 4) AS p_low, round(prophet + factor * sigma, 4) AS p_high "
    "FROM (SELECT *, CAST(date - (SELECT max(date) FROM sku s WHERE s.sku_id = additive.sku_id) AS INTEGER) AS step FROM additive) JOIN widths USING (step)",
)
def forecast_interval(spark, sf):
    return rounded(intervals.additive_with_intervals(gapless(spark, sf)))
