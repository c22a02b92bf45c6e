"""Per-series forecasts and the table that holds all models side by side."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shelfspark.functions.scalars import clip_non_negative, normalize_sku
from shelfspark.operators.backtest import MIN_TRAIN
from shelfspark.operators.ensemble import ensemble, join_forecasts
from shelfspark.session import kept
from shelfspark.sources import catalogue

# Fixed values of the curved fit: yearly and weekly waves, bends of the trend, shrinkage.
YEARLY_WAVES, WEEKLY_WAVES, BENDS, RIDGE = 6, 3, 12, 1.0


def last_value(series: DataFrame, by: Sequence[str] = ("sku_id",), ties: Sequence[str] = ()) -> DataFrame:
    newest = F.struct("date", *ties)
    return series.groupBy(*by).agg(F.max("date").alias("last_date"), F.max_by("units", newest).alias("last_units"))


def future_days(last: DataFrame, horizon: int) -> DataFrame:
    """The ``horizon`` days after ``last_date``, one row each."""
    steps = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn("date", F.date_add("last_date", F.col("step"))).drop("step")


def naive(series: DataFrame, horizon: int = 14, by: Sequence[str] = ("sku_id",)) -> DataFrame:
    return future_days(last_value(series, by), horizon).select(*by, "date", F.col("last_units").alias("naive"))


def additive_parameters(
    series: DataFrame, by: Sequence[str] = ("sku_id",), min_rows: int = MIN_TRAIN
) -> DataFrame:
    """Line, weekday effects and residual deviation per series: a table that can be stored and scored later.

    One shuffle: the windows and the final aggregation all run on the series' partitioning. Series with too few rows or
    without any sale have no model.
    """
    w = Window.partitionBy(*by)
    day = Window.partitionBy(*by, "_dow")
    timed = series.withColumn("_dow", F.weekday("date")).withColumn("_first", F.min("date").over(w))
    t = F.datediff("date", "_first").cast("double")
    line = timed.withColumn("_t", t).withColumns(
        {"_slope": F.regr_slope("units", "_t").over(w), "_level": F.regr_intercept("units", "_t").over(w)}
    )
    rest = line.withColumn("_rest", F.col("units") - F.col("_level") - F.col("_slope") * F.col("_t"))
    effects = rest.withColumn("_effect", F.avg("_rest").over(day))
    # at most seven (weekday, effect) pairs per series
    return (
        effects.groupBy(*by)
        .agg(
            F.count("*").alias("rows"), F.sum("units").alias("total"),
            F.min("_first").alias("first_date"), F.max("date").alias("last_date"),
            F.max("_slope").alias("slope"), F.max("_level").alias("level"),
            F.map_from_entries(F.collect_set(F.struct("_dow", "_effect"))).alias("weekday_effect"),
            F.stddev_samp(F.col("_rest") - F.col("_effect")).alias("sigma"),
        )
        .where((F.col("rows") >= min_rows) & (F.col("total") != 0))
    )


def additive_predict(
    parameters: DataFrame,
    horizon: int = 14,
    by: Sequence[str] = ("sku_id",),
    interval_width: float = 0.95,
    non_negative: bool = False,
) -> DataFrame:
    """Forecast with a symmetric normal interval of the given width."""
    z = NormalDist().inv_cdf(0.5 + interval_width / 2)
    t = F.datediff("date", "first_date")
    effect = F.coalesce(F.try_element_at("weekday_effect", F.weekday("date")), F.lit(0.0))
    out = future_days(parameters, horizon).withColumn("prophet", F.col("level") + F.col("slope") * t + effect)

    def bounded(c: Column) -> Column:
        return clip_non_negative(c) if non_negative else c

    return out.select(
        *by, "date", bounded(F.col("prophet")).alias("prophet"),
        bounded(F.col("prophet") - z * F.col("sigma")).alias("p_low"),
        bounded(F.col("prophet") + z * F.col("sigma")).alias("p_high"),
    )


def stored_parameters(
    series: DataFrame, folder: str, version: str, by: Sequence[str] = ("sku_id",), min_rows: int = MIN_TRAIN
) -> DataFrame:
    """The published parameters of this version as a table, or new ones that are published in the model catalogue."""
    spark = series.sparkSession

    def facts(table: DataFrame) -> tuple[dict, DataFrame]:
        told = table.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("trained_on_rows"),
            F.to_json(F.struct(F.count("*").alias("series"), F.avg("sigma").alias("sigma"))).alias("metrics"),
        )
        settings = catalogue.as_json(min_rows=min_rows, weekdays=7)
        return {"trained_on_rows": F.col("trained_on_rows"), "metrics": F.col("metrics"), "hyperparameters": settings}, told

    return catalogue.load_or_fit(
        spark, folder, "prophet", version,
        # kept, so that its facts and its files come from one computation
        fit=lambda: kept(additive_parameters(series, by, min_rows), "parameters"),
        write=lambda table, path: table.write.parquet(path),
        read=spark.read.parquet,
        facts=facts,
    )


def additive(series: DataFrame, horizon: int = 14, by: Sequence[str] = ("sku_id",), **options) -> DataFrame:
    return additive_predict(additive_parameters(series, by), horizon, by, **options)


def _design(days: np.ndarray, span: float, bends: np.ndarray, yearly: bool) -> np.ndarray:
    t = days / span
    parts = [np.ones_like(t), t, *[np.maximum(t - b, 0.0) for b in bends]]
    waves = [(7.0, WEEKLY_WAVES)] + ([(365.25, YEARLY_WAVES)] if yearly else [])
    for period, count in waves:
        for k in range(1, count + 1):
            angle = 2 * np.pi * k * days / period
            parts += [np.sin(angle), np.cos(angle)]
    return np.column_stack(parts)


def curved(
    series: DataFrame, horizon: int = 14, by: Sequence[str] = ("sku_id",), interval_width: float = 0.95, yearly: bool = False
) -> DataFrame:
    """Bending trend with weekly and, if ``yearly``, yearly waves, ridge-fitted per series inside the tasks.

    One daily series is bounded by the calendar, so a group always fits; Spark spreads the series over the cluster.
    """
    z = NormalDist().inv_cdf(0.5 + interval_width / 2)
    keys = list(by)
    types = {f.name: f.dataType.simpleString() for f in series.schema}
    out_schema = ", ".join([f"{k} {types[k]}" for k in keys] + ["date date", "prophet double", "p_low double", "p_high double"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["units"]).sort_values("date")
        if len(pdf) < MIN_TRAIN or pdf["units"].sum() == 0:
            return pd.DataFrame(columns=[*keys, "date", "prophet", "p_low", "p_high"])
        when = pd.to_datetime(pdf["date"])
        days = (when - when.iloc[0]).dt.days.to_numpy(dtype=float)
        span = max(days[-1], 1.0)
        bends = np.linspace(0, 0.8, BENDS + 1)[1:]
        x = _design(days, span, bends, yearly=yearly)
        y = pdf["units"].to_numpy(dtype=float)
        shrink = np.full(x.shape[1], RIDGE)
        shrink[:2] = 1e-8
        beta = np.linalg.solve(x.T @ x + np.diag(shrink), x.T @ y)
        sigma = float(np.std(y - x @ beta, ddof=1))
        ahead = days[-1] + np.arange(1, horizon + 1)
        yhat = _design(ahead, span, bends, yearly=yearly) @ beta
        out = pd.DataFrame({k: pdf[k].iloc[0] for k in keys}, index=range(horizon))
        out["date"] = (when.iloc[-1] + pd.to_timedelta(np.arange(1, horizon + 1), unit="D")).date
        return out.assign(prophet=yhat, p_low=yhat - z * sigma, p_high=yhat + z * sigma)

    return series.select(*keys, "date", "units").groupBy(*keys).applyInPandas(fit, out_schema)


def prefix_fits(days: np.ndarray, y: np.ndarray, ends: Sequence[int], yearly: bool = False) -> list[np.ndarray | None]:
    """The coefficients of :func:`curved` on the first ``e`` rows, for each ``e`` of ``ends``, from one pass over the rows.

    The bends lie at shares of the training span, so each prefix has a design of its own. But a bend is a line that starts
    at its day, so all products in the normal equations are sums of products of (1, day, waves, y) over the rows behind a
    bend: differences of running sums, taken at the ends and at the bends only. None where a prefix has no model.
    """
    base = np.column_stack([np.ones_like(days), days, _design(days, 1.0, np.empty(0), yearly)[:, 2:], y])
    shares = np.linspace(0, 0.8, BENDS + 1)[1:]
    spans = {e: max(days[e - 1], 1.0) for e in ends if e > 0}
    behind = {e: np.searchsorted(days[:e], shares * span, side="right") for e, span in spans.items()}
    cuts = sorted({0, *spans, *(int(i) for at in behind.values() for i in at)})
    sums = {0: np.zeros((base.shape[1], base.shape[1]))}
    for a, b in zip(cuts, cuts[1:]):
        sums[b] = sums[a] + base[a:b].T @ base[a:b]
    found: list[np.ndarray | None] = []
    for e in ends:
        if e < MIN_TRAIN or y[:e].sum() == 0:
            found.append(None)
            continue
        span, at = spans[e], behind[e]
        plain = sums[e].copy()
        scale = np.ones(base.shape[1])
        scale[1] = 1.0 / span
        plain = plain * scale[:, None] * scale
        # products of each bend with (1, t, waves, y), and of the bends with each other
        after = [(sums[e] - sums[int(i)]) * scale[:, None] * scale for i in at]
        line = np.column_stack([-shares, np.ones(BENDS)])
        with_base = np.stack([line[j] @ after[j][:2] for j in range(BENDS)])
        mutual = np.empty((BENDS, BENDS))
        for j in range(BENDS):
            for k in range(j, BENDS):
                mutual[j, k] = mutual[k, j] = line[j] @ after[k][:2, :2] @ line[k]
        waves = slice(2, base.shape[1] - 1)
        gram = np.block([
            [plain[:2, :2], with_base[:, :2].T, plain[:2, waves]],
            [with_base[:, :2], mutual, with_base[:, waves]],
            [plain[waves, :2], with_base[:, waves].T, plain[waves, waves]],
        ])
        right = np.concatenate([plain[:2, -1], with_base[:, -1], plain[waves, -1]])
        shrink = np.full(len(gram), RIDGE)
        shrink[:2] = 1e-8
        found.append(np.linalg.solve(gram + np.diag(shrink), right))
    return found


def add_curved(folds: DataFrame, by: Sequence[str] = ("sku_id",), yearly: bool = False) -> DataFrame:
    """:func:`curved` fitted on each fold's training rows, as the column ``prophet`` of the test rows.

    One grouped map over the series, which the fold windows have already partitioned; all folds of a series come from one
    pass over its rows (:func:`prefix_fits`). Training parts with fewer than 30 rows or without any sale leave NULLs.
    """
    schema = T.StructType([*folds.schema.fields, T.StructField("prophet", T.DoubleType())])
    shares = np.linspace(0, 0.8, BENDS + 1)[1:]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        # the newest fold has all rows of the series
        known = pdf[pdf["fold"] == pdf["fold"].min()].dropna(subset=["units"]).sort_values("date")
        out = pd.Series(np.nan, index=pdf.index)
        if len(known):
            when = pd.to_datetime(pdf["date"])
            first = pd.to_datetime(known["date"].iloc[0])
            days = (pd.to_datetime(known["date"]) - first).dt.days.to_numpy(dtype=float)
            tests = {f: rows.index for f, rows in pdf[pdf["role"] == "test"].groupby("fold")}
            begins = {f: float((when.loc[rows].min() - first).days) for f, rows in tests.items()}
            ends = [int(np.searchsorted(days, begins[f])) for f in tests]
            fits = prefix_fits(days, known["units"].to_numpy(dtype=float), ends, yearly)
            for (_, rows), e, beta in zip(tests.items(), ends, fits):
                if beta is not None:
                    ahead = (when.loc[rows] - first).dt.days.to_numpy(dtype=float)
                    out.loc[rows] = _design(ahead, max(days[e - 1], 1.0), shares, yearly) @ beta
        return pdf.assign(prophet=out)

    return folds.groupBy(*by).applyInPandas(fit, schema)


def forecast_all(
    series: DataFrame, boosters: dict[str, DataFrame], horizon: int = 14, trend: str = "additive", own: DataFrame | None = None, **options
) -> DataFrame:
    """All SKUs: date, prophet, p_low, p_high, xgb, lgbm, ensemble, sku_id.

    ``own`` is a per-series forecast that is there already, such as one of ``intervals.additive_with_intervals``.

    ``trend`` is ``additive`` (line and weekday effect) or ``curved`` (bending trend and waves, with ``yearly`` as an
    option). ``boosters`` holds the already scored tables ``xgb`` and ``lgbm``; a missing one is a NULL column.
    """
    if trend not in ("additive", "curved"):
        raise ValueError("trend is 'additive' or 'curved'")
    if own is None:
        own = (additive if trend == "additive" else curved)(series, horizon, **options)
    joined = join_forecasts(own, *boosters.values())
    absent = {m: F.lit(None).cast("double") for m in ("xgb", "lgbm") if m not in joined.columns}
    full = ensemble(joined.withColumns(absent) if absent else joined)
    return full.select(
        "date", "prophet", "p_low", "p_high", "xgb", "lgbm", "ensemble", normalize_sku("sku_id").alias("sku_id")
    )
