"""Segmentation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import segment
from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import SALES_SQL, sales

STATS_SQL = "WITH " + SALES_SQL + """,
s AS (SELECT sku_id, sum(units) AS units_sum, avg(units) AS mean, stddev_samp(units) AS std FROM sales GROUP BY sku_id),
c AS (SELECT *, sum(units_sum) OVER (ORDER BY units_sum DESC, sku_id ROWS UNBOUNDED PRECEDING)
             / sum(units_sum) OVER () AS cum_share,
             coalesce(std / nullif(mean, 0), 'infinity'::DOUBLE) AS cv FROM s),
l AS (SELECT *, CASE WHEN cum_share <= 0.8 THEN 'A' WHEN cum_share <= 0.95 THEN 'B' ELSE 'C' END AS abc,
             CASE WHEN cv < 0.1 THEN 'X' WHEN cv < 0.25 THEN 'Y' ELSE 'Z' END AS xyz FROM c)
"""


@query("sku_totals", STATS_SQL + "SELECT sku_id, units_sum FROM s")
def sku_totals(spark, sf):
    return segment.sku_totals(sales(spark, sf))


@query(
    "sku_variability",
    STATS_SQL + "SELECT sku_id, round(mean, 4) AS mean, round(std, 4) AS std, round(cv, 6) AS cv FROM c",
)
def sku_variability(spark, sf):
    out = segment.sku_variability(sales(spark, sf))
    return out.select("sku_id", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), F.round("cv", 6).alias("cv"))


@query("running_share", STATS_SQL + "SELECT sku_id, units_sum, round(cum_share, 6) AS cum_share FROM c")
def running_share(spark, sf):
    return rounded(segment.running_share(segment.sku_totals(sales(spark, sf))), 6)


@query(
    "abc_xyz",
    STATS_SQL + 'SELECT sku_id, units_sum, abc AS "ABC", round(cv, 6) AS cv, xyz AS "XYZ", abc || xyz AS "ABCXYZ" FROM l',
)
def abc_xyz(spark, sf):
    return rounded(segment.abc_xyz(sales(spark, sf)), 6)


@query(
    "abc_order",
    STATS_SQL + "SELECT sku_id, units_sum, abc || xyz AS class FROM l ORDER BY abc, xyz, units_sum DESC, sku_id",
)
def abc_order(spark, sf):
    ordered = segment.abc_order(segment.abc_xyz(sales(spark, sf)))
    return ordered.select("sku_id", "units_sum", F.col("ABCXYZ").alias("class"))


@query(
    "join_abc_xyz",
    STATS_SQL + "SELECT sku_id, units_sum, round(cv, 6) AS cv FROM c",
)
def join_abc_xyz(spark, sf):
    """Totals and variability side by side: one aggregation holds both, so there is nothing to join."""
    out = segment.abc_xyz(sales(spark, sf))
    return rounded(out.select("sku_id", "units_sum", "cv"), 6)


@query("abc_xyz_labels", STATS_SQL + "SELECT abc || xyz AS class, count(*) AS skus FROM l GROUP BY 1")
def abc_xyz_labels(spark, sf):
    out = segment.abc_xyz(sales(spark, sf))
    return out.groupBy(F.col("ABCXYZ").alias("class")).agg(F.count("*").alias("skus"))
