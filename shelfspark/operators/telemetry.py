"""Request and prediction telemetry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfspark.functions.scalars import metric_key
from shelfspark.operators.ordered import exact_quantiles, top_rows

# Observations per metric and per model that a process with little memory would keep, reported quantiles,
# parts of a hot key.
KEEP_REQUESTS, KEEP_PREDICTIONS = 1000, 100
QUANTILES = [0.5, 0.95, 0.99]
SALTS = 16


def request_key() -> Column:
    labels = F.create_map(
        F.lit("endpoint"), F.col("endpoint"), F.lit("method"), F.col("method"),
        F.lit("status"), F.col("status").cast("string"),
    )
    return metric_key(F.lit("http_requests"), labels)


def request_rollup(requests: DataFrame) -> DataFrame:
    return requests.groupBy("endpoint", "method", "status").agg(
        F.count("*").alias("requests"), F.sum("duration").alias("duration_sum"), F.avg("duration").alias("duration_avg")
    )


def keep_newest(observations: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The newest ``n`` observations of each metric. A hot metric is ranked in parts first."""
    return top_rows(observations, keys, order, n, salts=SALTS, rank="_rn").drop("_rn")


def latency_quantiles(
    observations: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str = "duration",
    keep: int | None = None,
) -> DataFrame:
    """Count, sum and quantiles per metric over all its observations, or over the newest ``keep`` of them.

    With ``keep`` a group holds at most that many rows; without it the exact quantiles are ranked across tasks.
    """
    if keep is not None:
        newest = keep_newest(observations, keys, order, keep)
        return newest.groupBy(*keys).agg(
            F.count("*").alias("count"), F.sum(value).alias("sum"),
            F.percentile(value, F.array(*[F.lit(q) for q in QUANTILES])).alias("_q"),
        ).select(*keys, "count", "sum", *_named("_q"))
    totals = observations.groupBy(*keys).agg(F.count(value).alias("count"), F.sum(value).alias("sum"))
    q = exact_quantiles(observations, [value], QUANTILES, keys).select(*keys, *_named("quantiles"))
    return totals.join(q, list(keys))


def latency_estimates(observations: DataFrame, keys: Sequence[str], value: str = "duration", accuracy: int = 10000):
    """Approximate quantiles of all observations: rank error at most ``1 / accuracy`` of the rows."""
    q = F.percentile_approx(value, QUANTILES, accuracy).alias("_q")
    return observations.groupBy(*keys).agg(F.count(value).alias("count"), q).select(*keys, "count", *_named("_q"))


def _named(array: str) -> list[Column]:
    return [F.col(array)[i].alias(f"p{round(q * 100)}") for i, q in enumerate(QUANTILES)]


def prediction_counters(observations: DataFrame, order: Sequence[Column] = (), keep: int | None = None) -> DataFrame:
    """Per model and SKU: predictions, errors, and the mean latency, of all observations or of the newest ``keep`` in ``order``."""
    keys = ["model", "sku_id"]
    totals = [F.count("*").alias("predictions"), F.count_if(~F.col("success")).alias("errors")]
    mean = F.avg("duration").alias("latency_avg")
    if keep is None:
        return observations.groupBy(*keys).agg(*totals, mean)
    newest = keep_newest(observations, keys, order, keep)
    return observations.groupBy(*keys).agg(*totals).join(newest.groupBy(*keys).agg(mean), keys)


def mape_gauge(metrics: DataFrame) -> DataFrame:
    """The newest MAPE of each model and SKU."""
    return metrics.groupBy("model", "sku_id").agg(F.max_by("mape", "at").alias("mape"))
