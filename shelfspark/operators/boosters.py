"""Global boosted trees over all series, and recursive multi-step scoring. ``trees`` holds the fit.

Trees of different libraries differ value by value; only their properties are comparable. Leaf-wise growth has no
counterpart in ``pyspark.ml`` and is not offered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfspark.operators import trees as boosting
from shelfspark.operators.backtest import add_additive, add_naive, fold_bounds, score
from shelfspark.operators.columns import finite_target
from shelfspark.operators.features import build_features
from shelfspark.operators.forecast import add_curved
from shelfspark.operators.summary import last_n
from shelfspark.session import kept, shared_folder
from shelfspark.sources import catalogue

# Feature lists, training defaults, rows of history the longest feature needs.
SMALL_FEATURES = ["dow", "week", "month", "units_lag_1", "units_lag_7"]
FULL_FEATURES = [*SMALL_FEATURES, "units_lag_14", "units_ma_7", "units_ma_28"]
TREES, BACKTEST_TREES, LEARNING_RATE, DEPTH, SEED = 500, 200, 0.05, 6, 42
HISTORY = 28
STEPS_PER_CHECKPOINT = 7
#: Rows of a task at most. So many fit one task alone, which needs no job for each level of a tree: their latency is more than its time.
MOST_ROWS_PER_TASK = 1_000_000
#: Bins of a feature, and the accuracy of the quantiles that part them.
BINS, QUANTILE_ACCURACY = 64, 10_000
#: Trees between two checkpoints of the residuals.
TREES_PER_CHECKPOINT = 20


def training_table(series: DataFrame, by: Sequence[str] = ("sku_id",)) -> DataFrame:
    """Features of the daily series; rolling means leave the day itself out, because it is the target.

    Written as Parquet in the shared folder, because fitting reads its input several times.
    """
    return kept(finite_target(build_features(series, exclude_current=True, by=by)), "boosters")


def _bucketizer(rows: DataFrame, features: Sequence[str]) -> Bucketizer:
    """Bins of the features, ``BINS`` at most: one for each value where there are few, else quantiles of all rows."""
    shares = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    seen = rows.agg(
        *[F.percentile_approx(F.col(f).cast("double"), shares, QUANTILE_ACCURACY).alias(f) for f in features],
        *[F.approx_count_distinct(f).alias(f"_n_{f}") for f in features],
    ).first()
    few = [f for f in features if seen[f"_n_{f}"] <= 2 * BINS]
    values = rows.agg(*[F.sort_array(F.collect_set(F.col(f).cast("double"))).alias(f) for f in few]).first() if few else {}
    splits = []
    for f in features:
        if f in few and 1 < len(values[f]) <= BINS:
            cuts = [(a + b) / 2 for a, b in zip(values[f], values[f][1:])]
        else:
            cuts = seen[f] or [0.0]
        splits.append([-math.inf, *sorted({c for c in cuts if math.isfinite(c)} or {0.0}), math.inf])
    return Bucketizer(inputCols=list(features), outputCols=[f"_bin_{f}" for f in features], splitsArray=splits)


def fit(
    table: DataFrame, features: Sequence[str], trees: int = TREES, rate: float = LEARNING_RATE, depth: int = DEPTH,
    seed: int = SEED,
) -> PipelineModel:
    """One booster over all rows: one job on small tables, else ``trees * depth`` jobs of one stage.

    Trees see bins only, so rows with equal bins are one row with their number as its weight and their mean as its label:
    within such a row nothing can be split, and the squared error of a split changes by the same amount. With few features
    there are no more such rows than the bins allow, however long the table is. More of them than one task fits are dealt
    to the cores in equal parts.
    """
    shared_folder(table.sparkSession)
    rows = table.select(*features, "units")
    bucketizer = _bucketizer(rows, features)
    bins = bucketizer.getOutputCols()
    cells = kept(
        bucketizer.transform(rows).groupBy(*bins).agg(F.avg("units").alias("units"), F.count("units").cast("double").alias("_weight")),
        "boosters",
    )
    vector = VectorAssembler(inputCols=bins, outputCol="features")
    booster = GBTRegressor(
        featuresCol="features", labelCol="units", predictionCol="forecast", weightCol="_weight", maxIter=trees, stepSize=rate,
        maxDepth=depth, seed=seed, maxBins=BINS, checkpointInterval=TREES_PER_CHECKPOINT,
    )
    n, cores = cells.count(), table.sparkSession.sparkContext.defaultParallelism
    if n == 0:
        raise ValueError("a booster needs training rows")
    parts = 1 if n <= MOST_ROWS_PER_TASK else cores * math.ceil(n / (cores * MOST_ROWS_PER_TASK))
    return PipelineModel(stages=[bucketizer, vector, boosting.fit(cells, booster, bins, parts)])


def r_squared(model: PipelineModel, table: DataFrame) -> float:
    """In-sample R2."""
    judge = RegressionEvaluator(labelCol="units", predictionCol="forecast", metricName="r2")
    return judge.evaluate(model.transform(table))


def importances(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    return dict(zip(features, model.stages[-1].featureImportances.toArray().tolist()))


def _step_features(day: Column) -> dict[str, Column]:
    """Features of one future day from the trailing values in ``_past`` (oldest first)."""
    past, known = F.col("_past"), F.size("_past")

    def lag(k: int) -> Column:
        return F.coalesce(F.when(known >= k, F.element_at(past, -k)), F.lit(0.0))

    def mean(n: int) -> Column:
        tail = F.slice(past, F.greatest(known - n + 1, F.lit(1)), n)
        return F.coalesce(F.try_divide(F.aggregate(tail, F.lit(0.0), lambda a, v: a + v), F.size(tail)), F.lit(0.0))

    return {
        "dow": F.weekday(day), "week": F.weekofyear(day), "month": F.month(day),
        "units_lag_1": lag(1), "units_lag_7": lag(7), "units_lag_14": lag(14),
        "units_ma_7": mean(7), "units_ma_28": mean(28),
    }


def trailing_state(series: DataFrame, by: Sequence[str] = ("sku_id",)) -> DataFrame:
    """One row per series: its last day and its last 28 values, oldest first."""
    newest = last_n(series, HISTORY, by)
    rows = F.sort_array(F.collect_list(F.struct("date", "units")))
    return newest.groupBy(*by).agg(F.max("date").alias("last_date"), rows.alias("_r")).select(
        *by, "last_date", F.col("_r.units").alias("_past")
    )


def recursive_score(
    model: PipelineModel, state: DataFrame, horizon: int, name: str, by: Sequence[str] = ("sku_id",)
) -> DataFrame:
    """Forecast day by day, feeding each forecast back: lag k at step h is history if h <= k, else the forecast of h - k.

    All series move together, so the loop is over days, never over series. The state is one row per series and is
    written every week to keep the plan short.
    """
    keep = [*by, "last_date", "_past", "_out"]
    state = state.select(*by, "last_date", "_past", F.array().cast("array<double>").alias("_out"))
    for step in range(1, horizon + 1):
        scored = model.transform(state.withColumns(_step_features(F.date_add("last_date", step))))
        value = F.col("forecast")
        state = scored.withColumns(
            {
                "_past": _push(value),
                "_out": F.concat("_out", F.array(value)),
            }
        ).select(*keep)
        if step % STEPS_PER_CHECKPOINT == 0 and step < horizon:
            state = kept(state, "boosters")
    return state.select(*by, "last_date", F.posexplode("_out").alias("_i", name)).select(
        *by, F.date_add("last_date", F.col("_i") + 1).alias("date"), name
    )


def _push(value: Column) -> Column:
    """Append a value and keep the last 28."""
    longer = F.concat("_past", F.array(value))
    return F.when(F.size(longer) > HISTORY, F.slice(longer, 2, HISTORY)).otherwise(longer)


def _facts(model: PipelineModel, table: DataFrame, metrics: str) -> tuple[dict, DataFrame]:
    booster = model.stages[-1]
    settings = catalogue.as_json(
        trees=booster.getMaxIter(), learning_rate=booster.getStepSize(), depth=booster.getMaxDepth(), seed=booster.getSeed()
    )
    counted = table.agg(F.count("*").alias("trained_on_rows"))
    return {"trained_on_rows": F.col("trained_on_rows"), "hyperparameters": settings, "metrics": metrics}, counted


def save_model(
    model: PipelineModel, folder: str, model_type: str, version: str, table: DataFrame, seconds: float, metrics: str
) -> DataFrame:
    """Publishes the model in the catalogue ``folder`` and returns the registry row of the version."""
    facts, counted = _facts(model, table, metrics)
    facts["training_duration_sec"] = float(seconds)
    catalogue.publish(table.sparkSession, folder, model_type, version, model.write().save, facts, counted)
    same = (F.col("model_type") == model_type) & (F.col("version") == version)
    return registry(table.sparkSession, folder).where(same)


def load_or_fit(folder: str, model_type: str, version: str, table: DataFrame, features: Sequence[str], **options) -> PipelineModel:
    """The published model, or a new fit that is published with its registry row where there is none."""
    return catalogue.load_or_fit(
        table.sparkSession, folder, model_type, version,
        fit=lambda: fit(table, features, **options),
        write=lambda model, path: model.write().save(path),
        read=PipelineModel.load,
        facts=lambda model: _facts(model, table, catalogue.as_json(r2=round(r_squared(model, table), 6))),
    )


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """One registry row per published model and version."""
    return catalogue.registry(spark, folder)


def backtest(
    series: DataFrame, horizon: int = 14, n_folds: int = 3, by: Sequence[str] = ("sku_id",), trees: int = BACKTEST_TREES,
    trend: str = "additive", yearly: bool = False, **options,
) -> DataFrame:
    """All five models on every fold of a gap-free daily series, as scored test rows.

    ``trend`` is ``additive`` or ``curved``, as in ``forecast_all``.

    Features and fold rows are built once and written. Each fold gets one fit per booster over all series; the fits do not
    wait for each other. Both are scored recursively from the fold's origin, so no model sees a test value. A fold without
    training rows leaves NULLs.
    """
    if trend not in ("additive", "curved"):
        raise ValueError("trend is 'additive' or 'curved'")
    folds = kept(fold_bounds(training_table(series, by), horizon, n_folds, by), "boosters")
    there = {r.fold for r in folds.where("role = 'train'").select("fold").distinct().collect()}

    def one(job: tuple[int, str, list[str]]) -> DataFrame:
        f, name, features = job
        train = folds.where((F.col("fold") == f) & (F.col("role") == "train"))
        scored = recursive_score(fit(train, features, trees=trees, **options), trailing_state(train, by), horizon, name, by)
        return scored.withColumn("fold", F.lit(f))

    work = [(f, name, features) for f in sorted(there) for name, features in (("xgboost", SMALL_FEATURES), ("lightgbm", FULL_FEATURES))]
    base = add_naive(folds.select(*by, "date", "units", "n_folds", "fold", "role"), by)
    plain = add_additive(base, by) if trend == "additive" else add_curved(base, by, yearly)
    if not work:
        return score(plain, {"prophet": "prophet", "naive": "naive"})
    with ThreadPoolExecutor(len(work)) as pool:
        done = list(pool.map(one, work))
    keys = [*by, "fold", "date"]
    small, full = (reduce(DataFrame.unionByName, done[i::2]) for i in (0, 1))
    boosted = plain.where(F.col("role") == "test").join(small.join(full, keys), keys, "left")
    return score(boosted, {m: m for m in ("prophet", "xgboost", "lightgbm", "naive")})


def forecast(
    series: DataFrame, horizon: int = 14, by: Sequence[str] = ("sku_id",), store: str | None = None, version: str = "1", **options
) -> dict[str, DataFrame]:
    """Both boosters scored ahead: the tables ``xgb`` and ``lgbm``.

    With a ``store`` the models of this ``version`` are taken from there, or fitted and kept there with their registry row.
    """
    table = training_table(series, by)
    state = kept(trailing_state(table, by), "boosters")
    models = models_of(table, store, version, **options)
    return {name: recursive_score(models[name], state, horizon, name, by) for name in models}


def models_of(
    table: DataFrame, store: str | None = None, version: str = "1", names: Sequence[str] = ("xgb", "lgbm"), **options
) -> dict[str, PipelineModel]:
    """The models ``names`` of a training table, stored or new; the fits run at the same time."""

    def one(name: str) -> PipelineModel:
        features = {"xgb": SMALL_FEATURES, "lgbm": FULL_FEATURES}[name]
        return load_or_fit(store, name, version, table, features, **options) if store else fit(table, features, **options)

    with ThreadPoolExecutor(len(names)) as pool:
        return dict(zip(names, pool.map(one, names), strict=True))
