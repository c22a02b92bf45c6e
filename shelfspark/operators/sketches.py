"""Mergeable sketches per day and key: distinct counts and quantiles over any range of days without reading facts again.

Sketches merge, so a panel reads one small row per day and key. The same rows split otherwise may give another distinct count
within its error, as merged sketches are read by another estimator. Distinct counts are off by at most 3 x ``distinct_error`` and quantiles by at most ``rank_error`` of the rows in rank, each with a probability
of 99 %; below some thousand distinct values the counts are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfspark.session import exists, kept

#: Size of the sketches: 2^12 counters for distinct values, and the width of the lowest level for quantiles.
DISTINCT_BITS, QUANTILE_WIDTH = 12, 400


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (bits / 2)


def rank_error(width: int = QUANTILE_WIDTH) -> float:
    """Largest difference in rank, as a share of the rows, of a quantile; the measured law of these sketches."""
    return 2.446 / width**0.9433


def day_sketches(
    facts: DataFrame, by: Sequence[str] = (), distinct: Sequence[str] = (), values: Sequence[str] = (), day: str = "date",
    bits: int = DISTINCT_BITS, width: int = QUANTILE_WIDTH,
) -> DataFrame:
    """One row per day and key: ``rows``, for each distinct column a sketch, for each value its count, sum and sketch.

    Sketches are built in each task before the shuffle. Null values count in none of them.
    """
    finite = {v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")) for v in values}
    return facts.groupBy(day, *by).agg(
        F.count("*").alias("rows"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(f"distinct_{c}") for c in distinct],
        *[a for v, x in finite.items() for a in (
            F.count(x).alias(f"n_{v}"), F.sum(x).alias(f"sum_{v}"), F.kll_sketch_agg_double(x, width).alias(f"quantiles_{v}"),
        )],
    )


def write_sketches(sketches: DataFrame, path: str, day: str = "date") -> None:
    """Adds days to a table of sketches by month; a day that is written again replaces all its rows.

    Only the months that the new days touch are read and written, aside first, as they are read from the same table.
    """
    spark = sketches.sparkSession
    rows = sketches.withColumn("month", F.date_format(day, "yyyy-MM"))
    if exists(spark, path):
        months, days = rows.select("month").distinct(), rows.select(day).distinct()
        others = spark.read.parquet(path).join(months, "month", "left_semi").join(days, day, "left_anti")
        rows = kept(rows.unionByName(others, allowMissingColumns=True), "sketches")
    rows.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def read_sketches(spark: SparkSession, path: str, first: date | None = None, last: date | None = None, day: str = "date") -> DataFrame:
    """The sketches of a range of days; other months are not read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where((F.col("month") >= f"{first:%Y-%m}") & (F.col(day) >= F.lit(first)))
    if last is not None:
        rows = rows.where((F.col("month") <= f"{last:%Y-%m}") & (F.col(day) <= F.lit(last)))
    return rows.drop("month")


def _merged(sketches: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    def sketch_columns(prefix: str) -> list[str]:
        return [c for c in sketches.columns if c.startswith(prefix)]

    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.datediff(F.max(day), F.min(day)).alias("days"),
        *[F.hll_union_agg(c).alias(c) for c in sketch_columns("distinct_")],
        *[F.sum(c).alias(c) for c in (*sketch_columns("n_"), *sketch_columns("sum_"))],
        *[F.kll_merge_agg_double(c).alias(c) for c in sketch_columns("quantiles_")],
    )


def panel(
    sketches: DataFrame, by: Sequence[str] = (), probabilities: Sequence[float] = (0.5, 0.95, 0.99), day: str = "date"
) -> DataFrame:
    """Per key over all days given: ``rows``, ``days``, distinct counts, and per value its count, sum, mean and quantiles."""
    merged = _merged(sketches, by, day)
    out: list[Column] = [F.col(c) for c in by] + [F.col("rows"), F.col("days")]
    for c in merged.columns:
        kind, _, name = c.partition("_")
        if kind == "distinct":
            out.append(F.hll_sketch_estimate(c).alias(name))
        elif kind == "quantiles":
            out += [F.col(f"n_{name}"), F.col(f"sum_{name}"), F.try_divide(f"sum_{name}", f"n_{name}").alias(f"mean_{name}")]
            # a sketch without values has no quantile
            out += [
                F.when(F.col(f"n_{name}") > 0, F.kll_sketch_get_quantile_double(c, F.lit(float(p)))).alias(f"{name}_p{round(p * 100)}")
                for p in probabilities
            ]
    return merged.select(*out)
