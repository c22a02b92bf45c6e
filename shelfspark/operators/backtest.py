"""Rolling-origin backtest: folds by position from the end, forecasts for all series and folds at once, metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfspark import schema
from shelfspark.functions.metrics import METRIC_FUNCTIONS
from shelfspark.operators.ensemble import mean_of_known

# Rows a training part needs, rows below which a short series is skipped, score of a model without one.
MIN_TRAIN, SHORT_SERIES, NO_SCORE = 30, 90, 999.0


def daily_series(sales: DataFrame) -> DataFrame:
    """Units per SKU and day: one row per day, so a horizon counts days whatever the number of stores."""
    return sales.groupBy("sku_id", "date").agg(F.sum("units").alias("units"))


def _planned(n: Column, horizon: int, n_folds: int) -> Column:
    """Folds of a series of ``n`` rows."""
    fewer = F.least(F.greatest(F.lit(2), F.floor(n / horizon).cast("int") - 1), F.lit(n_folds))
    return F.when(n >= horizon * (n_folds + 1), F.lit(n_folds)).when(n >= SHORT_SERIES, fewer).otherwise(0).cast("int")


def fold_bounds(
    series: DataFrame, horizon: int = 14, n_folds: int = 3, by: Sequence[str] = ("sku_id",)
) -> DataFrame:
    """Each row once per fold it takes part in, with ``fold``, ``role`` (train or test) and ``n_folds``.

    Fold f tests the ``horizon`` rows that end f horizons before the end and trains on all rows before them. A series
    shorter than ``horizon * (n_folds + 1)`` gets fewer folds if it has at least 90 rows, else none; a fold needs 30
    training rows. What is left out is listed by :func:`skipped_folds`.
    """
    w = Window.partitionBy(*by)
    n, back = F.col("_n"), F.col("_back")
    placed = (
        series.withColumn("_n", F.count("*").over(w).cast("int"))
        .withColumn("_back", F.row_number().over(w.orderBy(F.col("date").desc())) - 1)
        .withColumn("n_folds", _planned(n, horizon, n_folds))
        .where(F.col("n_folds") > 0)
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.col("n_folds") - 1)))
    )
    start_back = (F.col("fold") + 1) * horizon
    enough = n - start_back >= MIN_TRAIN
    role = F.when(back >= start_back, "train").when(back >= F.col("fold") * horizon, "test")
    return placed.where(enough).withColumn("role", role).where(F.col("role").isNotNull()).drop("_n", "_back")


def skipped_folds(
    series: DataFrame, horizon: int = 14, n_folds: int = 3, by: Sequence[str] = ("sku_id",)
) -> DataFrame:
    """The folds that :func:`fold_bounds` does without, one row each: ``rows``, ``n_folds``, ``fold``, ``reason``.

    ``short series`` has no fold at all, a ``shorter series`` fewer than asked for, and a fold with ``few training rows``
    begins too early.
    """
    n, fold = F.col("rows"), F.col("fold")
    asked = series.groupBy(*by).agg(F.count("*").cast("int").alias("rows")).withColumns(
        {"n_folds": _planned(n, horizon, n_folds), "fold": F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1)))}
    )
    reason = (
        F.when(F.col("n_folds") == 0, "short series")
        .when(fold >= F.col("n_folds"), "shorter series")
        .when(n - (fold + 1) * horizon < MIN_TRAIN, "few training rows")
    )
    return asked.withColumn("reason", reason).where(F.col("reason").isNotNull())


def with_skipped(evaluation: DataFrame, skipped: DataFrame, by: Sequence[str] = ("sku_id",)) -> DataFrame:
    """The evaluation with a row for each series that has none: ``n_folds`` 0, no metrics, and the ``reason`` of its newest fold."""
    first = skipped.groupBy(*by).agg(F.min_by("reason", "fold").alias("reason"))
    missing = first.join(evaluation, list(by), "left_anti").withColumn("n_folds", F.lit(0))
    return evaluation.withColumn("reason", F.lit(None).cast("string")).unionByName(missing, allowMissingColumns=True)


def fold_parts(by: Sequence[str]) -> tuple[Window, Column]:
    """Window of one series and fold, and the units of its training rows only."""
    return Window.partitionBy(*by, "fold"), F.when(F.col("role") == "train", F.col("units"))


def add_naive(folds: DataFrame, by: Sequence[str] = ("sku_id",)) -> DataFrame:
    """The last training value, repeated. Runs on the partitioning the fold windows left behind."""
    w, y = fold_parts(by)
    return folds.withColumn("naive", F.max_by(y, F.when(F.col("role") == "train", F.col("date"))).over(w))


def add_additive(folds: DataFrame, by: Sequence[str] = ("sku_id",)) -> DataFrame:
    """Line plus weekday effect, fitted on each fold's training rows, as the column ``prophet``.

    Needs 30 training rows and any sale. All windows share the series' partitioning.
    """
    w, y = fold_parts(by)
    train = F.col("role") == "train"
    weekday = Window.partitionBy(*by, "fold", "_dow")
    timed = folds.withColumn("_dow", F.weekday("date")).withColumn("_t", F.datediff("date", F.min("date").over(w)))
    t = F.when(train, F.col("_t").cast("double"))
    line = timed.withColumns(
        {
            "_slope": F.regr_slope(y, t).over(w),
            "_level": F.regr_intercept(y, t).over(w),
            "_rows": F.count(y).over(w),
            "_sum": F.sum(y).over(w),
        }
    )
    trend = F.col("_level") + F.col("_slope") * F.col("_t")
    effect = F.coalesce(F.avg(F.when(train, F.col("units") - trend)).over(weekday), F.lit(0.0))
    fitted = line.withColumn("prophet", F.when((F.col("_rows") >= MIN_TRAIN) & (F.col("_sum") != 0), trend + effect))
    return fitted.drop("_dow", "_t", "_slope", "_level", "_rows", "_sum")


def score(folds: DataFrame, models: dict[str, str]) -> DataFrame:
    """Test rows only, with one column per model of ``schema.MODELS``; models not given are NULL.

    ``models`` maps model names to columns. The ensemble is the mean of the known forecasts except the naive one.
    """
    test = folds.where(F.col("role") == "test")
    named = {m: F.col(models[m]) if m in models else F.lit(None).cast("double") for m in schema.MODELS if m != "ens"}
    out = test.select(*[c for c in test.columns if c not in schema.MODELS], *[c.alias(m) for m, c in named.items()])
    return out.withColumn("ens", mean_of_known(["prophet", "xgboost", "lightgbm"]))


def best_model(models: Sequence[str] = tuple(schema.MODELS)) -> Column:
    """Lowest MAPE; an unknown one counts as 999 and ties go by the order of the list."""
    ranked = [
        F.struct(F.coalesce(F.col(f"mape_{m}"), F.lit(NO_SCORE)).alias("m"), F.lit(i).alias("i"), F.lit(m).alias("name"))
        for i, m in enumerate(models)
    ]
    return F.array_min(F.array(*ranked))["name"]


def evaluation_table(scored: DataFrame, by: Sequence[str] = ("sku_id",)) -> DataFrame:
    """One wide row per series: fold means of all metrics of all models, number of folds, best model.

    Both aggregations are wide, so nothing is unpivoted, and both use the partitioning of the folds.
    """
    per_fold = scored.groupBy(*by, "fold").agg(
        F.max("n_folds").alias("n_folds"),
        *[fn("units", m).alias(f"{name}_{m}") for m in schema.MODELS for name, fn in METRIC_FUNCTIONS.items()],
    )
    means = per_fold.groupBy(*by).agg(
        F.max("n_folds").alias("n_folds"),
        *[
            F.bround(F.avg(f"{name}_{m}"), 2).alias(f"{name}_{m}")
            for m in schema.MODELS
            for name in METRIC_FUNCTIONS
        ],
    )
    return means.withColumn("best_model", best_model())


def error_table(pairs: DataFrame, by: Sequence[str], truth: str = "units", forecast: str = "naive") -> DataFrame:
    """All four metrics of one forecast column per group."""
    return pairs.groupBy(*by).agg(*[fn(truth, forecast).alias(name) for name, fn in METRIC_FUNCTIONS.items()])
