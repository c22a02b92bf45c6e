"""Cleaning of daily sales facts: first row per key, gap-free calendar, capped outliers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Day

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfspark import schema
from shelfspark.functions.scalars import cap
from shelfspark.operators.columns import ensure_columns, ensure_date, parse_date, zero_fill
from shelfspark.operators.ordered import exact_quantiles, top_rows


def dedup(df: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = tuple(schema.SALES_KEY)) -> DataFrame:
    """Keep the first row of each key in the given order, which must be total for a fixed result.

    Every task drops all but its own first row per key before the shuffle, so a key that is repeated millions of times
    costs its reader one row per task.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    return top_rows(df, keys, by, 1, rank="_rn").drop("_rn")


def _bounds(df: DataFrame, start: Day | str | None, end: Day | str | None) -> tuple[Column, Column]:
    """First and last day: given, or read from the table by one aggregation over its date column."""
    if start is not None and end is not None:
        return F.lit(start).cast("date"), F.lit(end).cast("date")
    seen = df.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    lo = F.lit(start).cast("date") if start is not None else seen.getField("lo")
    hi = F.lit(end).cast("date") if end is not None else seen.getField("hi")
    return lo, hi


def calendar(df: DataFrame, start=None, end=None, series: Sequence[str] = tuple(schema.SERIES)) -> DataFrame:
    """Every day of the range for every observed series, as key rows only."""
    days = F.sequence(*_bounds(df, start, end))
    return df.select(*series).distinct().select(F.explode(days).alias("date"), *series)


def calendar_join(df: DataFrame, start=None, end=None) -> DataFrame:
    """The calendar with the facts attached; days without a fact have NULL in every value column."""
    return calendar(df, start, end).join(df, schema.SALES_KEY, "left")


def fill_date_gaps(df: DataFrame, start: Day | str | None = None, end: Day | str | None = None) -> DataFrame:
    """One row per day and observed series; a missing day takes the last value before it, else the first after it.

    Each fact is stretched to the day before the next one, so the filled table comes out of one window and an
    ``explode``: no calendar table, no join, and a single shuffle on the series. A series has one row per day, which
    bounds the window; a repeated (date, SKU, store) raises, as there is no telling which row is meant (``dedup`` first).

    Back fill stays inside the series. Filling across series would need all rows in one task, and would lend one SKU
    the sales of another.
    """
    lo, hi = _bounds(df, start, end)
    return _final(_days(_stretched(df, lo, hi, start, end)), df.columns)


def _stretched(df: DataFrame, lo: Column, hi: Column, start, end) -> DataFrame:
    """Each fact with the days it stands for, ``_from`` to ``_to``; missing values are filled along the series."""
    values = [c for c in df.columns if c not in schema.SALES_KEY]
    facts = df.where(F.col("date").isNotNull())
    if start is not None:
        facts = facts.where(F.col("date") >= lo)
    if end is not None:
        facts = facts.where(F.col("date") <= hi)
    ordered = Window.partitionBy(*schema.SERIES).orderBy("date")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    # with no earlier value, the first value after the row is the first of the whole series
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = F.lead("date").over(ordered)
    repeated = F.concat(F.lit("repeated key: "), F.concat_ws(" ", F.col("date").cast("string"), *schema.SERIES))
    return facts.select(
        *schema.SERIES,
        *[F.coalesce(F.last(c, True).over(so_far), F.first(c, True).over(whole)).alias(c) for c in values],
        F.when(F.row_number().over(ordered) == 1, lo).otherwise(F.col("date")).alias("_from"),
        F.when(later == F.col("date"), F.raise_error(repeated).cast("date")).otherwise(
            F.coalesce(F.date_sub(later, 1), hi)
        ).alias("_to"),
    )


def _days(stretched: DataFrame) -> DataFrame:
    return stretched.withColumn("date", F.explode(F.sequence("_from", "_to")))


def _final(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[_fixed(c).alias(c) for c in columns])


def _fixed(c: str) -> Column:
    """Final types: whole units, 0/1 promo, price 0 where unknown."""
    if c == "units":
        return F.coalesce(F.col(c).cast("bigint").cast("double"), F.lit(0.0))
    if c == "promo_flag":
        return F.coalesce(F.col(c).cast("int"), F.lit(0))
    if c == "price":
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return F.col(c)


def iqr_bounds(q1: Column, q3: Column, multiplier: float = 1.5) -> tuple[Column, Column]:
    return q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1)


def cap_iqr(df: DataFrame, column: str = "units", by: Sequence[str] = tuple(schema.SERIES)) -> DataFrame:
    """Cap values outside the quartile fences of their daily series; nothing is dropped.

    For groups bounded by the calendar: the window uses the partitioning the gap fill left behind, so this step shuffles
    nothing. Use ``cap_iqr_wide`` for groups of any size.
    """
    quartiles = F.percentile(column, F.array(F.lit(0.25), F.lit(0.75))).over(Window.partitionBy(*by))
    return _capped(df.withColumn("_q", quartiles), column).select(*df.columns)


def cap_iqr_wide(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """``cap_iqr`` for groups too large for one task: counted quantiles joined back, one row per group."""
    q = exact_quantiles(df, [column], [0.25, 0.75], by).select(*by, F.col("quantiles").alias("_q"))
    return _capped(df.join(q, list(by), "left"), column).select(*df.columns)


def _capped(df: DataFrame, column: str) -> DataFrame:
    lower, upper = iqr_bounds(F.col("_q")[0], F.col("_q")[1])
    return df.withColumn(column, cap(column, F.greatest(lower, F.lit(0.0)), upper))


def rescued_dates(df: DataFrame) -> DataFrame:
    """One row: rows of the table, rows whose date no format reads, and rows without a date."""
    text = F.col("date").cast("string")
    parsed = parse_date("date") if dict(df.dtypes)["date"] == "string" else F.col("date").cast("date")
    return df.agg(
        F.count("*").alias("rows"), F.count_if(parsed.isNull() & text.isNotNull()).alias("unreadable"),
        F.count_if(text.isNull()).alias("missing"),
    )


def _dated(df: DataFrame, on_bad_dates: str) -> DataFrame:
    """Dates as DATE. An unreadable one raises while the rows are read, or becomes NULL where the caller says so."""
    if on_bad_dates not in ("raise", "null"):
        raise ValueError("on_bad_dates is 'raise' or 'null'")
    text = dict(df.dtypes).get("date") == "string"
    if on_bad_dates == "null" or not text:
        return ensure_date(df, strict=False)
    unread = F.raise_error(F.concat(F.lit("not a date: "), F.col("date"))).cast("date")
    return df.withColumn("date", F.coalesce(parse_date("date"), F.when(F.col("date").isNotNull(), unread)))


def clean_sales(
    df: DataFrame,
    order: Sequence[Column | str] = (),
    drop: Sequence[str] = (),
    start=None,
    end=None,
    on_bad_dates: str = "raise",
) -> DataFrame:
    """Defaults, dates, zero fill, first row per key, gap-free calendar, capped units.

    ``order`` decides which of several rows of one key is kept; without it the smallest values win. Columns that only
    serve the order and are no part of a sales table are named in ``drop``. A date that no format reads raises: its row
    would vanish, and the gap fill would put other sales in its place. ``on_bad_dates='null'`` leaves such rows out;
    ``rescued_dates`` counts them.
    """
    df = zero_fill(_dated(ensure_columns(df), on_bad_dates))
    rest = [c for c in df.columns if c not in schema.SALES_KEY]
    first = dedup(df, order or rest).drop(*drop)

    # A fact's value counts once per day it stands for, so the quartiles of the filled series come from the facts and
    # their day counts, in the same window pass as the fill: the filled rows are neither sorted nor scanned for them.
    lo, hi = _bounds(df, start, end)
    whole = F.coalesce(F.col("units").cast("bigint").cast("double"), F.lit(0.0))
    facts = _stretched(first, lo, hi, start, end).withColumn("units", whole)
    days = F.datediff("_to", "_from") + 1
    quartiles = F.percentile("units", F.array(F.lit(0.25), F.lit(0.75)), days).over(Window.partitionBy(*schema.SERIES))
    filled = _days(_capped(facts.withColumn("_q", quartiles), "units"))
    return filled.select(*[c if c == "units" else _fixed(c).alias(c) for c in first.columns])
