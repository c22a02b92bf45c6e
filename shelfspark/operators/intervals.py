"""Prediction intervals that widen with the horizon, from errors of earlier forecasts (split conformal, by step ahead).

The model is fitted at several earlier origins and scored on the days after each. An error counts in units of the
residual deviation of its own fit, so errors of all series can be pooled; their quantile at each step ahead, times the
deviation of the final fit, is the half width on that day.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfspark.functions.scalars import clip_non_negative
from shelfspark.operators.backtest import add_additive, fold_bounds, fold_parts
from shelfspark.operators.forecast import additive_parameters, additive_predict
from shelfspark.operators.ordered import exact_quantiles

#: Earlier origins, and errors that a series needs at a step to go by its own.
ORIGINS, OWN_SCORES = 8, 20


def rolling_scores(
    series: DataFrame, horizon: int = 14, origins: int = ORIGINS, by: Sequence[str] = ("sku_id",)
) -> DataFrame:
    """One row per series, origin and day ahead: ``step`` and ``score``, the absolute error over the deviation of the fit.

    Short series have fewer origins or none, as in the backtest. Fits without any deviation have no score.
    """
    w, _ = fold_parts(by)
    train = F.col("role") == "train"
    fitted = add_additive(fold_bounds(series, horizon, origins, by), by)
    rest = F.when(train, F.col("units") - F.col("prophet"))
    placed = fitted.withColumns({"_sigma": F.stddev_samp(rest).over(w), "_origin": F.max(F.when(train, F.col("date"))).over(w)})
    score = F.abs(F.col("units") - F.col("prophet")) / F.when(F.col("_sigma") > 0, F.col("_sigma"))
    return (
        placed.where(F.col("role") == "test")
        .select(*by, "fold", "date", F.datediff("date", "_origin").alias("step"), score.alias("score"))
        .where(F.col("score").isNotNull())
    )


def rising(values: Column, weights: Column) -> Column:
    """The non-decreasing array nearest to ``values`` (weighted least squares, both arrays of one length).

    Place h gets the largest, over beginnings up to h, of the smallest mean from there to an end at h or later. A running
    maximum would do as well, but lies above the values by their noise.
    """

    def sums(of: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(of)), lambda k: F.aggregate(F.slice(of, 1, k), F.lit(0.0), lambda a, v: a + v))

    weighted = F.zip_with(values, weights, lambda v, w: v * w)
    one = F.array(F.struct(sums(weighted).alias("v"), sums(weights.cast("array<double>")).alias("w"), F.size(values).alias("m")))

    def fitted(s: Column) -> Column:
        def mean(i: Column, j: Column) -> Column:
            return (s["v"][j] - s["v"][i - 1]) / (s["w"][j] - s["w"][i - 1])

        return F.transform(F.sequence(F.lit(1), s["m"]), lambda h: F.array_max(F.transform(
            F.sequence(F.lit(1), h), lambda i: F.array_min(F.transform(F.sequence(h, s["m"]), lambda j: mean(i, j)))
        )))

    return F.when(F.size(values) > 0, F.transform(one, fitted)[0])


def _rising_by_step(found: DataFrame, by: Sequence[str], quantile: str, factor: str) -> DataFrame:
    """Adds ``factor``, the rising form of the quantiles over the steps of a group; a group has a row per step of the horizon."""
    rows = F.array_sort(F.collect_list(F.struct("step", "n", F.col(quantile).alias("q"))))
    whole = found.groupBy(*by).agg(rows.alias("_r")).where(F.size("_r") > 0)
    fitted = whole.withColumn("_f", rising(F.col("_r.q"), F.col("_r.n")))
    return fitted.select(*by, F.posexplode("_r").alias("_i", "_s"), "_f").select(
        *by, "_s.step", "_s.n", F.col("_s.q").alias(quantile), F.col("_f")[F.col("_i")].alias(factor)
    )


def pooled_widths(scores: DataFrame, width: float = 0.95) -> DataFrame:
    """Per step ahead the quantile of all series' scores, counted exactly, and ``factor``, the same made to rise with the steps.

    One row per step: ``step``, ``n``, ``quantile``, ``factor``.
    """
    found = exact_quantiles(scores, ["score"], [width], by=["step"])
    return _rising_by_step(found.select("step", "n", F.col("quantiles")[0].alias("quantile")), [], "quantile", "factor")


def own_widths(
    scores: DataFrame, width: float = 0.95, by: Sequence[str] = ("sku_id",), least: int = OWN_SCORES
) -> DataFrame:
    """The same per series, for steps with at least ``least`` scores of its own: ``by``, ``step``, ``n``, ``quantile``, ``own``.

    The quantile is the score that a share of ``width`` of the scores and one more to come does not exceed. A series has
    one score per origin and step, so its scores fit a row.
    """
    n = F.col("n")
    wanted = F.least(F.ceil((n + 1) * F.lit(width)), n).cast("int")
    sorted_scores = scores.groupBy(*by, "step").agg(F.array_sort(F.collect_list("score")).alias("_s")).withColumn("n", F.size("_s"))
    own = sorted_scores.where(n >= least).select(*by, "step", "n", F.element_at("_s", wanted).alias("quantile"))
    return _rising_by_step(own, by, "quantile", "own")


def additive_with_intervals(
    series: DataFrame, horizon: int = 14, by: Sequence[str] = ("sku_id",), width: float = 0.95, origins: int = ORIGINS,
    least: int = OWN_SCORES, non_negative: bool = False,
) -> DataFrame:
    """The additive forecast with ``p_low`` and ``p_high`` from earlier errors at the same step ahead.

    Series with enough errors of their own go by them, others by those of all series; where no series has any, by a normal
    law as in ``additive``. The bounds enclose the forecast and never narrow along the horizon.
    """
    scores = rolling_scores(series, horizon, origins, by)
    # one row per step of the horizon
    pooled = F.broadcast(pooled_widths(scores, width).select("step", "factor"))
    own = own_widths(scores, width, by, least).select(*by, "step", "own")
    parameters = additive_parameters(series, by)
    sigma = parameters.select(*by, F.coalesce("sigma", F.lit(0.0)).alias("_sigma"), F.col("last_date").alias("_last"))
    ahead = additive_predict(parameters, horizon, by, width).select(*by, "date", "prophet").join(sigma, list(by))
    stepped = ahead.withColumn("step", F.datediff("date", "_last")).join(pooled, "step", "left").join(own, [*by, "step"], "left")
    # each of the two factors rises on its own; where a series has only some steps of its own, the larger goes on
    upto = Window.partitionBy(*by).orderBy("step")
    normal = NormalDist().inv_cdf(0.5 + width / 2)
    factor = F.max(F.coalesce("own", "factor", F.lit(normal))).over(upto)
    half = factor * F.col("_sigma")

    def bounded(c):
        return clip_non_negative(c) if non_negative else c

    return stepped.select(
        *by, "date", bounded(F.col("prophet")).alias("prophet"),
        bounded(F.col("prophet") - half).alias("p_low"), bounded(F.col("prophet") + half).alias("p_high"),
    )


def coverage(truth: DataFrame, intervals: DataFrame, by: Sequence[str] = ("sku_id",)) -> DataFrame:
    """The share of days whose value lies within the bounds, and their mean width, per step ahead."""
    both = truth.select(*by, "date", "units").join(intervals, [*by, "date"])
    first = Window.partitionBy(*by)
    placed = both.withColumn("step", F.datediff("date", F.min("date").over(first)) + 1)
    inside = F.col("units").between(F.col("p_low"), F.col("p_high"))
    return placed.groupBy("step").agg(
        F.count("*").alias("n"), F.avg(inside.cast("double")).alias("covered"), F.avg(F.col("p_high") - F.col("p_low")).alias("width")
    )
