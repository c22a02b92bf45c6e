"""Forecast error metrics as aggregate columns, usable in any ``agg``; pairs that are not finite are left out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfspark.functions.scalars import ColumnOrName, as_col, is_finite


def _pair(y: ColumnOrName, p: ColumnOrName) -> tuple[Column, Column, Column]:
    y, p = as_col(y), as_col(p)
    return y, p, is_finite(y) & is_finite(p)


def mae(y: ColumnOrName, p: ColumnOrName) -> Column:
    y, p, ok = _pair(y, p)
    return F.avg(F.when(ok, F.abs(y - p)))


def rmse(y: ColumnOrName, p: ColumnOrName) -> Column:
    y, p, ok = _pair(y, p)
    return F.sqrt(F.avg(F.when(ok, (y - p) * (y - p))))


def mape(y: ColumnOrName, p: ColumnOrName) -> Column:
    """Percent; only where the truth is above zero, NULL if it never is."""
    y, p, ok = _pair(y, p)
    return F.avg(F.when(ok & (y > 0), F.abs((y - p) / F.when(y > 0, y)))) * 100


def smape(y: ColumnOrName, p: ColumnOrName) -> Column:
    """Symmetric percent; a zero denominator counts as one."""
    y, p, ok = _pair(y, p)
    half = (F.abs(y) + F.abs(p)) / 2
    return F.avg(F.when(ok, F.abs(y - p) / F.when(half == 0, 1.0).otherwise(half))) * 100


METRIC_FUNCTIONS = {"mae": mae, "rmse": rmse, "mape": mape, "smape": smape}
