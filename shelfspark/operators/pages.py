"""Pages of a list by a cursor: the next page starts behind the last row seen, so a deep page costs what the first does."""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

Order = Sequence[tuple[str, bool]]


def _behind(order: Order, values: Sequence[str | None], types: dict[str, str]) -> Column:
    """Rows after the given values in the order (column, ascending); nulls come first when ascending, last when not."""
    clauses, equal = [], F.lit(True)
    for (name, ascending), value in zip(order, values, strict=True):
        c = F.col(name)
        if value is None:
            # behind null: all others when ascending, none when descending
            step, same = (c.isNotNull() if ascending else F.lit(False)), c.isNull()
        else:
            v = F.lit(value).cast(types[name])
            step, same = (c > v if ascending else (c < v) | c.isNull()), c == v
        clauses.append(equal & step)
        equal = equal & same
    found = reduce(lambda a, b: a | b, clauses)
    # implied by the rest, but a plain comparison that a scan can skip by
    (first, ascending), value = order[0], values[0]
    if value is not None and ascending:
        found = found & (F.col(first) >= F.lit(value).cast(types[first]))
    return found


def cursor_of(row: Row, order: Order) -> str:
    """The cursor that stands behind a row: its values in the order, as text that can be handed out."""
    values = [None if row[f"_cursor_{name}"] is None else str(row[f"_cursor_{name}"]) for name, _ in order]
    return base64.urlsafe_b64encode(json.dumps(values).encode()).decode()


def read_cursor(cursor: str, order: Order) -> list[str | None]:
    values = json.loads(base64.urlsafe_b64decode(cursor.encode()))
    if not isinstance(values, list) or len(values) != len(order):
        raise ValueError("the cursor belongs to another list")
    return values


def page_after(df: DataFrame, order: Order, cursor: str | None = None, limit: int = 100) -> DataFrame:
    """The ``limit`` rows behind the cursor, or the first ones, with columns that :func:`cursor_of` reads.

    ``order`` must be total, so its last column is unique. The values behind the cursor are a filter that reaches the
    scan, and each task keeps ``limit`` rows: no page counts through those before it.
    """
    rows = df if cursor is None else df.where(_behind(order, read_cursor(cursor, order), dict(df.dtypes)))
    by = [F.col(name).asc_nulls_first() if ascending else F.col(name).desc_nulls_last() for name, ascending in order]
    marks = {f"_cursor_{name}": F.col(name).cast("string") for name, _ in order}
    return rows.orderBy(*by).limit(limit).withColumns(marks)


def next_page(df: DataFrame, order: Order, cursor: str | None = None, limit: int = 100) -> tuple[list[Row], str | None]:
    """The rows of a page, as a caller of a list gets them, and the cursor of the next page or None behind the last."""
    found = page_after(df, order, cursor, limit + 1).collect()  # a page
    shown = found[:limit]
    return shown, cursor_of(shown[-1], order) if len(found) > limit else None


def total(df: DataFrame) -> DataFrame:
    """The number of rows, as ``total``. Without a filter no column is read: files tell their rows in their footers."""
    return df.agg(F.count("*").alias("total"))
