"""Column helpers. Every one is a built-in expression, so it stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfspark import schema

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_sku(c: ColumnOrName) -> Column:
    """One spelling for SKU ids: ``SKU`` and at least three digits.

    Unicode blanks count as blanks. Text without the prefix and without digits is kept, upper-cased.
    """
    text = F.upper(F.regexp_replace(as_col(c).cast("string"), r"(?U)^\s+|\s+$", ""))
    digits = F.regexp_replace(text, "[^0-9]", "")
    padded = F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    return F.when(text.startswith("SKU") | (digits != ""), F.concat(F.lit("SKU"), padded)).otherwise(
        F.regexp_replace(text, "SKU[_-]", "SKU")
    )


def is_finite(c: ColumnOrName) -> Column:
    c = as_col(c).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def finite_or_null(c: ColumnOrName) -> Column:
    return F.when(is_finite(c), as_col(c))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing everywhere in the package: turn it into NULL once, on read."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def safe_divide(a: ColumnOrName, b: ColumnOrName, default: float = 0.0) -> Column:
    a, b = as_col(a), as_col(b)
    return F.when(b == 0, F.lit(default)).otherwise(F.try_divide(a, b))


def format_number(c: ColumnOrName, decimals: int = 2) -> Column:
    return F.coalesce(F.format_number(as_col(c), decimals), F.lit("N/A"))


def round_metrics(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Half-even rounding of every fractional column; other columns are left as they are."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.bround(c, decimals) for c in floats}) if floats else df


def cap(value: ColumnOrName, lower: Column, upper: Column) -> Column:
    """Bound a value; bounds given the wrong way round are swapped."""
    return F.least(F.greatest(as_col(value), F.least(lower, upper)), F.greatest(lower, upper))


def clip_non_negative(c: ColumnOrName) -> Column:
    c = as_col(c)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def abc_label(share: ColumnOrName) -> Column:
    share, (a, b) = as_col(share), schema.ABC_LIMITS
    return F.when(share <= a, "A").when(share <= b, "B").otherwise("C")


def xyz_label(cv: ColumnOrName) -> Column:
    cv, (x, y) = as_col(cv), schema.XYZ_LIMITS
    return F.when(cv < x, "X").when(cv < y, "Y").otherwise("Z")


def is_holiday(date: ColumnOrName, holidays: list[str] | None = None) -> Column:
    """1 on the given month-day texts (``MM-dd``), else 0."""
    days = schema.HOLIDAYS if holidays is None else holidays
    return F.date_format(as_col(date), "MM-dd").isin(days).cast("int")


def calendar_features(date: ColumnOrName, holidays: list[str] | None = None) -> dict[str, Column]:
    """Monday is 0; weeks are ISO weeks."""
    date = as_col(date)
    return {
        "dow": F.weekday(date),
        "week": F.weekofyear(date),
        "month": F.month(date),
        "is_weekend": (F.weekday(date) >= 5).cast("int"),
        "is_holiday": is_holiday(date, holidays),
        "day_of_year": F.dayofyear(date),
        "quarter": F.quarter(date),
    }


def day_span(date: ColumnOrName) -> Column:
    """Aggregate: days between the first and the last date."""
    return F.datediff(F.max(as_col(date)), F.min(as_col(date)))


def metric_key(name: ColumnOrName, labels: ColumnOrName) -> Column:
    """``name{k="v",...}`` with the labels of a map column in key order; the bare name without labels."""
    entries = F.array_sort(F.map_entries(as_col(labels)))
    pairs = F.transform(entries, lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"')))
    return F.coalesce(F.concat(as_col(name), F.lit("{"), F.array_join(pairs, ","), F.lit("}")), as_col(name))


def json_field(text: ColumnOrName, field: str, dtype: str = "string") -> Column:
    return F.get_json_object(as_col(text), f"$.{field}").try_cast(dtype)


def to_json_text(*cols: ColumnOrName) -> Column:
    return F.to_json(F.struct(*cols))
