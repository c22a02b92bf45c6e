"""Descriptive aggregates over sales, metrics and forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfspark import schema
from shelfspark.functions.scalars import day_span, is_finite
from shelfspark.operators.clean import iqr_bounds
from shelfspark.operators.ordered import exact_quantiles, top_rows

QUARTILES = [0.25, 0.5, 0.75]


def kpi_panel(sales: DataFrame) -> DataFrame:
    """Rows, distinct SKUs and stores, day span, mean units.

    The facts are first reduced to one row per SKU and store, so the distinct counts never see the fact rows.
    """
    pairs = sales.groupBy("sku_id", "store_id").agg(
        F.count("*").alias("n"), F.sum("units").alias("s"), F.count("units").alias("k"),
        F.min("date").alias("lo"), F.max("date").alias("hi"),
    )
    return pairs.agg(
        F.sum("n").alias("rows"),
        F.count_distinct("sku_id").alias("skus"),
        F.count_distinct("store_id").alias("stores"),
        F.datediff(F.max("hi"), F.min("lo")).alias("days"),
        F.try_divide(F.sum("s"), F.sum("k")).alias("mean_units"),
    )


def sku_summary(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sku_id").agg(
        F.sum("units").alias("total"), F.avg("units").alias("mean"), F.min("units").alias("min"),
        F.max("units").alias("max"), day_span("date").alias("days"),
    )


def column_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum per numeric column, exact at any group size.

    The quantiles' first scan takes the other numbers along.
    """
    value = F.col("value")
    extra = [F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max")]
    q = exact_quantiles(df, columns, QUARTILES, by, extra=extra)
    named = [F.col("quantiles")[i].alias(name) for i, name in enumerate(("q25", "median", "q75"))]
    return q.select(*by, "column_name", F.col("n").alias("count"), "mean", "std", "min", "max", *named)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum belongs to the last bin. Empty bins have no row."""
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    number = F.when(lo == hi, F.lit(1)).otherwise(F.least(F.width_bucket(column, lo, hi, F.lit(bins)), F.lit(bins)))
    counted = df.where(F.col(column).isNotNull()).groupBy(number.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    width = (hi - lo) / bins
    return counted.withColumns({"low": lo + (F.col("bin") - 1) * width, "high": lo + F.col("bin") * width})


def weekday_profile(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.weekday("date").alias("dow")).agg(F.avg("units").alias("mean_units"))


def month_profile(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.month("date").alias("month")).agg(F.avg("units").alias("mean_units"))


def sku_day_rollup(sales: DataFrame) -> DataFrame:
    """Facts at (date, sku_id): what a table that is unique on that key can hold."""
    return sales.groupBy("date", "sku_id").agg(
        F.sum("units").alias("units"),
        F.sum(F.col("units") * F.col("price")).alias("revenue"),
        F.avg("price").alias("price"),
        F.max("promo_flag").alias("promo_flag"),
    )


def last_n(df: DataFrame, n: int, by: Sequence[str] = tuple(schema.SERIES), ties: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` rows of each series."""
    return top_rows(df, by, [F.col("date").desc(), *[F.col(c).desc() for c in ties]], n, rank="_rn").drop("_rn")


def first_horizon(df: DataFrame, horizon: int, by: Sequence[str] = ("sku_id",)) -> DataFrame:
    """The first ``horizon`` rows by date of each SKU."""
    return top_rows(df, by, [F.col("date")], horizon, rank="_rn").drop("_rn")


def sales_vs_forecast(
    sales: DataFrame, predictions: DataFrame, sku: str, store: str | None = None, rows: int = 90, model: str = "ensemble"
) -> DataFrame:
    """The newest facts of a SKU (or SKU and store) and its forecast on one time axis."""
    facts = sales.where(F.col("sku_id") == sku)
    if store is not None:
        facts = facts.where(F.col("store_id") == store)
    newest = facts.orderBy(F.col("date").desc(), F.col("store_id").desc()).limit(rows)
    actual = newest.select("date", F.lit("actual").alias("kind"), F.col("units").alias("value"))
    future = predictions.where(F.col("sku_id") == sku)
    return actual.unionByName(future.select("date", F.lit("forecast").alias("kind"), F.col(model).alias("value")))


def known_skus(*tables: DataFrame) -> DataFrame:
    """Distinct SKUs of all tables, sorted. Each table is reduced before the union."""
    parts = [t.select("sku_id").where(F.col("sku_id").isNotNull()).distinct() for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct().orderBy("sku_id")


def concat_results(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()]
    return concat_results(*parts)


def active_sku_count(dim: DataFrame) -> DataFrame:
    return dim.agg(F.count_if("is_active").alias("active_skus"))


def forecast_mean(predictions: DataFrame, models: Sequence[str] = ("prophet", "xgb", "lgbm", "ensemble")) -> DataFrame:
    """Mean of each model per SKU; missing forecasts are skipped."""
    return predictions.groupBy("sku_id").agg(*[F.avg(m).alias(m) for m in models])


def _metric_columns(table: DataFrame, metrics: Sequence[str]) -> list[str]:
    return [f"{m}_{model}" for model in schema.MODELS for m in metrics if f"{m}_{model}" in table.columns]


def _split(name: Column) -> list[Column]:
    return [F.substring_index(name, "_", 1).alias("metric"), F.substring_index(name, "_", -1).alias("model")]


def box_stats(evaluation: DataFrame, metrics: Sequence[str] = ("mape", "mae", "rmse")) -> DataFrame:
    """Five numbers and whiskers (1.5 times the quartile distance) over SKUs, per metric and model."""
    columns = _metric_columns(evaluation, metrics)
    stats = column_stats(evaluation, columns)
    low, high = iqr_bounds(F.col("q25"), F.col("q75"))
    fences = stats.select(F.col("column_name").alias("_name"), low.alias("_low"), high.alias("_high"))
    values = evaluation.select(*columns).unpivot([], columns, "column_name", "value").where(is_finite("value"))
    # one row per metric column, so the broadcast is bounded by the schema
    inside = values.join(F.broadcast(fences), F.col("column_name") == F.col("_name")).groupBy("_name").agg(
        F.min(F.when(F.col("value") >= F.col("_low"), F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= F.col("_high"), F.col("value"))).alias("whisker_high"),
        F.count_if((F.col("value") < F.col("_low")) | (F.col("value") > F.col("_high"))).alias("outliers"),
    )
    return stats.join(inside, F.col("column_name") == F.col("_name")).select(
        *_split(F.col("column_name")), F.col("count").alias("n"), "min", "q25", "median", "q75", "max",
        "whisker_low", "whisker_high", "outliers",
    )


def model_means(evaluation: DataFrame, metrics: Sequence[str] = ("mape", "mae", "rmse")) -> DataFrame:
    """Mean of each metric over SKUs per model."""
    means = evaluation.agg(*[F.avg(c).alias(c) for c in _metric_columns(evaluation, metrics)])
    models = [m for m in schema.MODELS if any(c.endswith(f"_{m}") for c in means.columns)]
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            *[
                (F.col(f"{m}_{model}") if f"{m}_{model}" in means.columns else F.lit(None).cast("double")).alias(m)
                for m in metrics
            ],
        )
        for model in models
    ]
    return means.select(F.inline(F.array(*rows)))


def model_wins(evaluation: DataFrame) -> DataFrame:
    return evaluation.groupBy("best_model").agg(F.count("*").alias("wins"))


def most_wins(evaluation: DataFrame) -> DataFrame:
    return model_wins(evaluation).orderBy(F.col("wins").desc(), "best_model").limit(1)


def sku_passport(evaluation: DataFrame, sku: str) -> DataFrame:
    """One SKU's metrics as rows (model, metrics..., is_best)."""
    one = evaluation.where(F.col("sku_id") == sku)
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            *[F.col(f"{m}_{model}").alias(m) for m in schema.METRICS],
            (F.col("best_model") == model).alias("is_best"),
        )
        for model in schema.MODELS
        if f"mape_{model}" in evaluation.columns
    ]
    return one.select("sku_id", F.inline(F.array(*rows)))
