"""ABC-XYZ classes: a SKU's share of all units, and how steady its demand is."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfspark.functions.scalars import abc_label, xyz_label
from shelfspark.operators.ordered import running_total


def sku_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sku_id").agg(F.sum("units").alias("units_sum"))


def _cv(mean, std):
    # one row has no deviation, and a zero mean no ratio: both count as endless variation
    return F.coalesce(F.try_divide(std, F.when(mean != 0, mean)), F.lit(float("inf")))


def sku_variability(sales: DataFrame) -> DataFrame:
    stats = sales.groupBy("sku_id").agg(F.avg("units").alias("mean"), F.stddev_samp("units").alias("std"))
    return stats.withColumn("cv", _cv(F.col("mean"), F.col("std")))


def running_share(totals: DataFrame) -> DataFrame:
    """Inclusive cumulative share of ``units_sum``, biggest SKU first, ties by id."""
    ranked = running_total(totals, order=[F.col("units_sum").desc(), F.col("sku_id")], values=["units_sum"])
    share = F.try_divide(F.col("running_units_sum"), F.col("total_units_sum"))
    return ranked.withColumn("cum_share", share).drop("running_units_sum", "total_units_sum")


def abc_xyz(sales: DataFrame) -> DataFrame:
    """One pass over the facts gives totals and variability together; the rest works on one row per SKU."""
    stats = sales.groupBy("sku_id").agg(
        F.sum("units").alias("units_sum"), F.avg("units").alias("mean"), F.stddev_samp("units").alias("std")
    )
    labelled = (
        running_share(stats)
        .withColumn("ABC", abc_label("cum_share"))
        .withColumn("cv", _cv(F.col("mean"), F.col("std")))
        .withColumn("XYZ", xyz_label("cv"))
    )
    return labelled.select(
        "sku_id", "units_sum", "ABC", "cv", "XYZ", F.concat("ABC", "XYZ").alias("ABCXYZ")
    )


def abc_order(classes: DataFrame) -> DataFrame:
    return classes.orderBy("ABC", "XYZ", F.col("units_sum").desc(), "sku_id")
