"""Calendar, lag and rolling features. All windows of a call share one partitioning: one shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F, types as T

from shelfspark import schema
from shelfspark.functions.scalars import calendar_features
from shelfspark.operators.ordered import running_total


def _series(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy("date")


def add_calendar(df: DataFrame, holidays: list[str] | None = None) -> DataFrame:
    return df.withColumns(calendar_features("date", holidays))


def add_lags(
    df: DataFrame, lags: Sequence[int] = schema.LAGS, by: Sequence[str] = tuple(schema.SERIES)
) -> DataFrame:
    return df.withColumns({f"units_lag_{k}": F.lag("units", k).over(_series(by)) for k in lags})


def add_rolling(
    df: DataFrame,
    windows: Sequence[int] = schema.ROLLING,
    by: Sequence[str] = tuple(schema.SERIES),
    exclude_current: bool = False,
) -> DataFrame:
    """Mean of the last ``n`` rows; ``exclude_current`` keeps the day's own units out of its features."""
    out = {}
    for n in windows:
        frame = (-n, -1) if exclude_current else (1 - n, 0)
        out[f"units_ma_{n}"] = F.avg("units").over(_series(by).rowsBetween(*frame))
    return df.withColumns(out)


def moving_average(df: DataFrame, windows: Sequence[int] = (7, 30), block: int = 100_000) -> DataFrame:
    """Row means per SKU over date, store order, whatever number of stores a SKU has.

    Rows are numbered across tasks and cut into blocks of one SKU; the last rows of a block are lent to the next one, so
    every window sees the rows before it and no task holds more than a block.
    """
    reach = max(windows) - 1
    if block < max(reach, 1):
        raise ValueError("a block must hold the longest window")
    numbered = running_total(df.withColumn("_one", F.lit(1)), ["date", "store_id"], ["_one"], by=["sku_id"])
    at = F.col("running__one") - 1
    own = F.struct(F.floor(at / block).alias("block"), F.lit(False).alias("lent"))
    lent = F.struct((F.floor(at / block) + 1).alias("block"), F.lit(True).alias("lent"))
    places = F.when(at % block >= block - reach, F.array(own, lent)).otherwise(F.array(own))
    placed = numbered.select(*df.columns, at.alias("_at"), F.inline(places))
    w = Window.partitionBy("sku_id", "block").orderBy("_at")
    means = {f"rolling_{n}": F.avg("units").over(w.rowsBetween(1 - n, 0)) for n in windows}
    return placed.withColumns(means).where(~F.col("lent")).drop("_at", "block", "lent")


def build_features(
    df: DataFrame,
    fill: float | None = 0.0,
    exclude_current: bool = False,
    by: Sequence[str] = tuple(schema.SERIES),
    holidays: list[str] | None = None,
) -> DataFrame:
    """Calendar, lags and rolling means; missing numbers become ``fill`` unless it is None."""
    out = add_rolling(add_lags(add_calendar(df, holidays), by=by), by=by, exclude_current=exclude_current)
    if fill is None:
        return out
    numeric = [f.name for f in out.schema if isinstance(f.dataType, T.NumericType)]
    return out.fillna(fill, subset=numeric)
