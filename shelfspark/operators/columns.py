"""Column-level preparation: headers, defaults, dates, numbers, simple row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfspark import schema
from shelfspark.functions.scalars import is_finite


class ColumnError(ValueError):
    """A table does not have the columns or values an operator needs."""


def normalized_names(names: Sequence[str]) -> list[str]:
    """Stripped, lower-case names with the unit aliases resolved; two headers for one name are refused."""
    out = [schema.UNIT_ALIASES.get(n.strip().lower(), n.strip().lower()) for n in names]
    twice = sorted({n for n in out if out.count(n) > 1})
    if twice:
        raise ColumnError(f"several headers mean {twice}")
    return out


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*normalized_names(df.columns))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ColumnError(f"missing columns {missing}")
    return df


def ensure_columns(df: DataFrame) -> DataFrame:
    """Error without date or sku_id; the optional columns get their defaults."""
    require_columns(df, schema.REQUIRED)
    absent = {c: F.lit(v) for c, v in schema.DEFAULTS.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def zero_fill(df: DataFrame) -> DataFrame:
    """Missing units, price and promo_flag become 0; units is added where absent."""
    if "units" not in df.columns:
        df = df.withColumn("units", F.lit(0.0))
    numeric = [c for c in ("units", "price", "promo_flag") if c in df.columns]
    return df.fillna(0, subset=numeric)


def parse_date(c: Column | str, formats: Sequence[str] = tuple(schema.DATE_FORMATS)) -> Column:
    """The first format that reads the text; NULL when none does."""
    text = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("date")


def ensure_date(df: DataFrame, column: str = "date", strict: bool = True) -> DataFrame:
    """Turn a column into DATE. Text that no format reads raises if ``strict``, else becomes NULL."""
    require_columns(df, [column])
    if not isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, F.col(column).cast("date"))
    parsed = parse_date(column)
    if strict:
        unread = df.agg(F.count_if(parsed.isNull() & F.col(column).isNotNull())).first()[0]
        if unread:
            raise ColumnError(f"{unread} values of {column} are not dates")
    return df.withColumn(column, parsed)


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """To DOUBLE; text that is no number, and NaN, become 0."""
    return df.withColumns({c: _number(c) for c in columns})


def _number(c: str) -> Column:
    value = F.col(c).try_cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


def numeric_issues(df: DataFrame, columns: Sequence[str], min_value: float = 0.0) -> DataFrame:
    """Per column: values lost to the cast, missing values and values below the minimum; one scan for all columns."""
    counts = []
    for c in columns:
        value = F.col(c).try_cast("double")
        counts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(value.isNull() & F.col(c).isNotNull()).alias("rescued"),
                F.count_if(F.col(c).isNull() | F.coalesce(F.isnan(value), F.lit(False))).alias("missing"),
                F.count_if((value < min_value) & ~F.isnan(value)).alias("below_min"),
            )
        )
    return df.agg(F.array(*counts).alias("_c")).select(F.inline("_c"))


def require_non_negative(df: DataFrame, columns: Sequence[str], min_value: float = 0.0) -> DataFrame:
    bad = [r.column_name for r in numeric_issues(df, columns, min_value).collect() if r.below_min]
    if bad:
        raise ColumnError(f"values below {min_value} in {bad}")
    return coerce_numeric(df, columns)


def filter_in(df: DataFrame, skus: Sequence[str] = (), stores: Sequence[str] = ()) -> DataFrame:
    """Rows of the chosen SKUs and stores; an empty choice does not filter."""
    if skus:
        df = df.where(F.col("sku_id").isin(list(skus)))
    if stores:
        df = df.where(F.col("store_id").isin(list(stores)))
    return df


def training_columns(df: DataFrame) -> DataFrame:
    """The three columns a per-series model reads, as (sku_id, ds, y)."""
    return df.select("sku_id", F.col("date").alias("ds"), F.col("units").alias("y"))


def finite_target(df: DataFrame, target: str = "units") -> DataFrame:
    return df.where(is_finite(target))


def page(df: DataFrame, order: Sequence[Column | str], skip: int = 0, limit: int = 100) -> DataFrame:
    """One page of a list in a total order."""
    return df.orderBy(*order).offset(skip).limit(limit)
