"""Distribution drift between a reference and a current table: column statistics, Kolmogorov-Smirnov, PSI."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shelfspark.functions.scalars import is_finite
from shelfspark.operators.ordered import Sliced, exact_quantiles, long_values, slice_rows, with_running
from shelfspark.operators.summary import column_stats
from shelfspark.session import kept

# Fixed value: share that stands for an empty bin.
EMPTY_SHARE = 0.0001
#: Values a side up to which the exact law of the statistic is used.
EXACT_ROWS = 10_000
#: Share of a column between two knots of a stored profile.
PROFILE_SHARE = 0.0005


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def reference_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The statistics a drift check is fitted with; a table to store, nothing is kept on the driver."""
    return column_stats(df, list(columns or numeric_columns(df)))


def kolmogorov_p(d: Column, n_ref: Column, n_cur: Column, terms: int = 10) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic.

    Two forms of the same series: one converges fast for large arguments, the other for small ones.
    """
    effective = F.sqrt(n_ref * n_cur / (n_ref + n_cur))
    x = d * effective
    # sums of exponentials, each alternating term by its index
    tail = F.lit(0.0)
    head = F.lit(0.0)
    for k in range(1, terms + 1):
        tail = tail + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * x * x)
        head = head + F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8.0) / F.nullif(x * x, F.lit(0.0)))
    small = 1.0 - head * (F.lit(math.sqrt(2 * math.pi)) / F.nullif(x, F.lit(0.0)))
    p = F.when(x > 1.0, tail).otherwise(F.coalesce(small, F.lit(1.0)))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))


def counted_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> Sliced:
    """Counted values of both tables per column, cut into slices: rows (column_name, value, ref, cur).

    Each table is read once. Counting merges ties; all checks below work on the counts.
    """
    cast = [F.col(c).cast("double").alias(c) for c in columns]
    sides = reference.select(*cast, F.lit(1).alias("_ref")).unionByName(current.select(*cast, F.lit(0).alias("_ref")))
    long = sides.unpivot(["_ref"], list(columns), "column_name", "value").where(is_finite("value"))
    counted = long.groupBy("column_name", "value").agg(
        F.sum("_ref").alias("ref"), F.sum(1 - F.col("_ref")).alias("cur")
    )
    return slice_rows(counted, ["value"], ["ref", "cur"], by=["column_name"])


def ks_statistic(sides: Sliced) -> DataFrame:
    """Per column: largest distance of the two empirical distributions, counts and means of both sides."""
    ranked = with_running(sides, ["ref", "cur"], ["column_name", "value", "ref", "cur"])
    gap = F.abs(
        F.try_divide(F.col("running_ref"), F.col("total_ref")) - F.try_divide(F.col("running_cur"), F.col("total_cur"))
    )
    return ranked.groupBy("column_name").agg(
        F.max(gap).alias("ks_statistic"), F.max("total_ref").alias("n_ref"), F.max("total_cur").alias("n_cur"),
        *[F.try_divide(F.sum(F.col(s) * F.col("value")), F.sum(s)).alias(f"{s}_mean") for s in ("ref", "cur")],
    )


def _deviations(counted: DataFrame, ks: DataFrame) -> DataFrame:
    """Sample deviation of both sides, with squares taken around the means."""
    # one row per column of the schema
    around = counted.join(F.broadcast(ks.select("column_name", "ref_mean", "cur_mean")), "column_name")

    def std(side: str) -> Column:
        off = F.col("value") - F.col(f"{side}_mean")
        return F.sqrt(F.try_divide(F.sum(F.col(side) * off * off), F.sum(side) - 1)).alias(f"{side}_std")

    return around.groupBy("column_name").agg(std("ref"), std("cur"))


def exact_p(d: float, m: int, n: int) -> float:
    """The probability that the distance of two samples of ``m`` and ``n`` values of one law is ``d`` or more.

    Each merged order of the samples is a path over the grid of m x n, and its distance is below ``d`` while the path
    stays in a band around the diagonal. The share of such paths is carried along the columns ``i + j`` of the grid; only
    the band is looked at.
    """
    if m < n:
        m, n = n, m
    wide = round(d * m * n)
    if wide <= 0:
        return 1.0
    # the share of paths to (i, j), of all paths there, that never left the band
    share = np.zeros(n + 2)  # by j + 1, with a place in front
    share[1] = 1.0
    for k in range(1, m + n + 1):
        # |j m - i n| < wide with i = k - j
        low = max(0, k - m, (k * n - wide) // (m + n) + 1)
        high = min(n, k, -((-k * n - wide) // (m + n)) - 1)
        if low > high:
            return 1.0
        j = np.arange(low, high + 1)
        step = share[low:high + 1] * (j / k) + share[low + 1:high + 2] * ((k - j) / k)
        share[max(low - 2, 0):low + 1] = 0.0
        share[low + 1:high + 2] = step
        share[high + 2:high + 4] = 0.0
    return float(min(1.0, max(0.0, 1.0 - share[n + 1])))


def ks_pvalues(table: DataFrame, exact_rows: int = EXACT_ROWS, distance: str = "ks_statistic") -> DataFrame:
    """Adds ``ks_pvalue`` and ``p_method``: the exact law up to ``exact_rows`` values a side, the asymptotic one above.

    ``table`` is a report with one row per column, so the exact law is worked out once for each.
    """
    d, n_ref, n_cur = F.col(distance), F.col("n_ref"), F.col("n_cur")
    small = F.greatest(n_ref, n_cur) <= exact_rows
    out = table.withColumns({
        "ks_pvalue": kolmogorov_p(d, n_ref, n_cur), "p_method": F.when(small, "exact").otherwise("asymptotic"),
    })
    if not exact_rows:
        return out

    @F.pandas_udf("double")
    def exact(far: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([exact_p(*row) if max(row[1:]) <= exact_rows else None for row in zip(far, m, n)], dtype="float64")

    return out.withColumn("ks_pvalue", F.when(small, exact(d, n_ref, n_cur)).otherwise(F.col("ks_pvalue")))


def ks_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, significance: float = 0.05,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Per numeric column both tables have: KS statistic and p-value, percent change of mean and deviation, flag.

    Up to ``exact_rows`` values on each side the p-value is exact (``p_method``); 0 takes the asymptotic law for all.
    """
    shared = [c for c in (columns or numeric_columns(current)) if c in numeric_columns(reference)]
    sides = counted_sides(reference, current, shared)
    ks = ks_statistic(sides).where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))

    def change(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(b) - F.col(a), F.col(a)) * 100, F.lit(0.0))

    report = ks.join(F.broadcast(_deviations(sides.rows, ks)), "column_name").withColumns(
        {"mean_change_pct": change("ref_mean", "cur_mean"), "std_change_pct": change("ref_std", "cur_std")}
    )
    return ks_pvalues(report, exact_rows).withColumn("has_drift", F.col("ks_pvalue") < significance)


# ---- fit once, detect often ---------------------------------------------------------------------------------------------


def fit_profile(reference: DataFrame, path: str, columns: Sequence[str] | None = None, share: float = PROFILE_SHARE) -> None:
    """Writes what drift checks need of a reference table, so that they need not read it again.

    ``stats`` has the statistics of each column, ``knots`` the exact counts of values up to and below chosen ones: between
    two neighbours lies less than ``share`` of the column. A column has about ``1 / share`` knots whatever its rows.
    """
    names = list(columns or numeric_columns(reference))
    counted = long_values(reference, names).groupBy("column_name", "value").agg(F.count("*").alias("ref"))
    ranked = with_running(slice_rows(counted, ["value"], ["ref"], by=["column_name"]), ["ref"], ["column_name", "value", "ref"])
    n, upto = F.col("total_ref"), F.col("running_ref")
    # a value that takes the count over a line of the grid, and the first value
    line = lambda c: F.floor(c / (n * F.lit(share)))
    first = upto == F.col("ref")
    knots = ranked.where(first | (upto == n) | (line(upto) > line(upto - F.col("ref"))))
    knots.select("column_name", "value", (upto - F.col("ref")).alias("below"), upto.alias("upto"), n.alias("n_ref")).write.parquet(f"{path}/knots")
    reference_stats(reference, names).write.parquet(f"{path}/stats")


def ks_bounds(current: DataFrame, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column the bounds ``ks_low`` and ``ks_high`` of the KS statistic against a fitted profile, counts and statistics.

    At the knots both distributions are known, which gives the lower bound. Between two knots either can only lie between
    its values at them, which gives the upper one; the two differ by less than the profile's share. Only the current
    table and the knots are read.
    """
    spark = current.sparkSession
    knots = spark.read.parquet(f"{path}/knots")
    stats = spark.read.parquet(f"{path}/stats").select(
        "column_name", F.col("mean").alias("ref_mean"), F.col("std").alias("ref_std"),
    )
    names = [c for c in (columns or numeric_columns(current)) if c in numeric_columns(current)]
    counts = long_values(current, names).groupBy("column_name", "value").agg(F.count("*").alias("cur"))
    marked = counts.join(stats.select("column_name"), "column_name", "left_semi").unionByName(
        knots.where(F.col("column_name").isin(names)), allowMissingColumns=True
    )
    merged = marked.groupBy("column_name", "value").agg(
        F.coalesce(F.sum("cur"), F.lit(0)).alias("cur"), F.max("below").alias("below"), F.max("upto").alias("upto"), F.max("n_ref").alias("n_ref")
    )
    columns_kept = ["column_name", "value", "cur", "below", "upto", "n_ref"]
    sliced = slice_rows(merged, ["value"], ["cur"], by=["column_name"])
    placed = with_running(sliced, ["cur"], columns_kept).where(F.col("n_ref").isNotNull())
    column = Window.partitionBy("column_name").orderBy("value")  # about 1 / share knots
    n_cur, n_ref = F.col("total_cur"), F.col("n_ref")
    ref_at, ref_before = F.col("upto") / n_ref, F.col("below") / n_ref
    cur_at = F.try_divide(F.col("running_cur"), n_cur)
    cur_before = F.try_divide(F.col("running_cur") - F.col("cur"), n_cur)
    placed = placed.withColumns({"_ra": ref_at, "_rb": ref_before, "_ca": cur_at, "_cb": cur_before})
    # the open stretch in front of a knot; before the first one the reference has nothing
    last_r, last_c = F.coalesce(F.lag("_ra").over(column), F.lit(0.0)), F.coalesce(F.lag("_ca").over(column), F.lit(0.0))
    low = F.greatest(F.abs(F.col("_ra") - F.col("_ca")), F.abs(F.col("_rb") - F.col("_cb")))
    high = F.greatest(low, F.col("_cb") - last_r, F.col("_rb") - last_c)
    bounds = placed.withColumns({"_low": low, "_high": high}).groupBy("column_name").agg(
        F.max("_low").alias("ks_low"), F.max("_high").alias("ks_high"), F.max("n_ref").alias("n_ref"), F.max("total_cur").alias("n_cur"),
    ).where(F.col("n_cur") > 0)
    means = sliced.rows.groupBy("column_name").agg(F.try_divide(F.sum(F.col("cur") * F.col("value")), F.sum("cur")).alias("cur_mean"))
    # one row per column of the schema
    around = sliced.rows.join(F.broadcast(means), "column_name")
    off = F.col("value") - F.col("cur_mean")
    spread = around.groupBy("column_name").agg(
        F.max("cur_mean").alias("cur_mean"), F.sqrt(F.try_divide(F.sum(F.col("cur") * off * off), F.sum("cur") - 1)).alias("cur_std")
    )
    return bounds.join(stats, "column_name").join(spread, "column_name")


def detect_drift(
    current: DataFrame, path: str, columns: Sequence[str] | None = None, significance: float = 0.05,
    reference: Callable[[], DataFrame] | None = None, exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """The flags of :func:`ks_drift` against a fitted profile: ``has_drift``, changes of mean and deviation, bounds of D.

    Where both bounds of the statistic give the same flag, it is the flag. A column between them is checked by its counts
    if ``reference`` gives the table back (``settled`` then says ``counts``), and has no flag otherwise.
    """
    bounds = kept(ks_bounds(current, path, columns), "drift-bounds")
    low = ks_pvalues(bounds, exact_rows, "ks_low").select("column_name", F.col("ks_pvalue").alias("p_high"))
    both = ks_pvalues(bounds, exact_rows, "ks_high").withColumnRenamed("ks_pvalue", "p_low").join(low, "column_name")
    sure = (F.col("p_low") < significance) == (F.col("p_high") < significance)
    flagged = both.withColumn("has_drift", F.when(sure, F.col("p_low") < significance))

    def change(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(b) - F.col(a), F.col(a)) * 100, F.lit(0.0))

    report = flagged.select(
        "column_name", "ks_low", "ks_high", "n_ref", "n_cur", change("ref_mean", "cur_mean").alias("mean_change_pct"),
        change("ref_std", "cur_std").alias("std_change_pct"), "has_drift", F.when(sure, "profile").alias("settled"),
    )
    if reference is None:
        return report
    open_columns = [r.column_name for r in report.where("has_drift IS NULL").select("column_name").collect()]  # columns of a schema
    if not open_columns:
        return report
    counted = ks_drift(reference(), current, open_columns, significance, exact_rows).select(
        "column_name", F.col("ks_statistic").alias("_d"), F.col("has_drift").alias("_flag")
    )
    by_counts = F.col("_flag").isNotNull()
    return report.join(F.broadcast(counted), "column_name", "left").select(
        "column_name", F.coalesce("_d", "ks_low").alias("ks_low"), F.coalesce("_d", "ks_high").alias("ks_high"), "n_ref", "n_cur",
        "mean_change_pct", "std_change_pct", F.coalesce("has_drift", "_flag").alias("has_drift"),
        F.when(by_counts, "counts").otherwise(F.col("settled")).alias("settled"),
    )


def target_drift(reference: DataFrame, current: DataFrame, target: str = "units") -> DataFrame:
    out = ks_drift(reference, current, [target])
    return out.select(
        F.col("column_name").alias("target"), "ks_statistic", "ks_pvalue", "ref_mean", "cur_mean", "mean_change_pct",
        "n_ref", "n_cur", F.col("has_drift").alias("has_target_drift"),
    )


def psi(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index per column, over percentile bins of the reference.

    Equal edges are merged and the last bin is closed. Current values outside the edges are in no bin but stay in the
    denominator; an empty bin counts as a small fixed share. A constant column has no bins and index 0.
    """
    edges = exact_quantiles(reference, columns, [i / bins for i in range(bins + 1)]).select(
        F.col("column_name").alias("_name"), F.array_distinct("quantiles").alias("_edges")
    )
    top = F.element_at("_edges", -1)
    below = F.size(F.filter("_edges", lambda e: e <= F.col("value")))
    number = F.when(F.col("value") == top, F.size("_edges") - 1).otherwise(below)
    inside = (F.size("_edges") > 1) & F.col("value").between(F.col("_edges")[0], top)
    sides = long_values(reference, columns).withColumn("_ref", F.lit(1)).unionByName(
        long_values(current, columns).withColumn("_ref", F.lit(0))
    )
    # the edges are one row per column; after the grouping there are at most bins + 1 rows per column
    binned = (
        sides.join(F.broadcast(edges), F.col("column_name") == F.col("_name"))
        .groupBy("column_name", F.when(inside, number).otherwise(0).alias("bin"))
        .agg(F.sum("_ref").alias("ref"), F.sum(1 - F.col("_ref")).alias("cur"))
    )
    column = Window.partitionBy("column_name")
    binned = binned.withColumns({f"total_{s}": F.sum(s).over(column) for s in ("ref", "cur")})

    def share(side: str) -> Column:
        part = F.try_divide(F.col(side), F.col(f"total_{side}"))
        return F.when(part > 0, part).otherwise(F.lit(EMPTY_SHARE))

    r, c = share("ref"), share("cur")
    term = F.when(F.col("bin") > 0, (c - r) * F.ln(c / r))
    return binned.groupBy("column_name").agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("psi"))
