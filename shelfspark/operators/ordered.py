"""Order-dependent work that no single task may hold: running totals, exact quantiles, top rows per group.

A window without partition keys, or with one hot key, puts its whole group into one task. The helpers below cut the
order into range slices first, so a group of any size is spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfspark.functions.scalars import is_finite
from shelfspark.session import shared_folder


#: Of approximate quantiles: they are off by at most a share of 1 / ACCURACY of the rows.
ACCURACY = 20_000


@dataclass(frozen=True)
class Sliced:
    """Rows cut into range slices, and per (group, slice) what lies before the slice."""

    rows: DataFrame  # with _slice
    offsets: DataFrame  # _by_<key>..., _at, and per value _sum_<v>, _before_<v>, total_<v>
    order: tuple[Column | str, ...]
    by: tuple[str, ...]

    def at_slice(self) -> Column:
        """Rows and offsets of the same group and slice."""
        same = F.col("_slice") == F.col("_at")
        for c in self.by:
            # plain equality where it is enough: it keeps the partitioning the window already paid for
            left, right = F.col(c), F.col(f"_by_{c}")
            same = same & (left.eqNullSafe(right) if self.rows.schema[c].nullable else left == right)
        return same

    def local(self, values: Sequence[str], rows: DataFrame | None = None) -> DataFrame:
        """Running sums inside each slice, as ``_local_<v>``."""
        w = Window.partitionBy(*self.by, "_slice").orderBy(*self.order)
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        return (self.rows if rows is None else rows).withColumns(
            {f"_local_{v}": F.sum(v).over(upto) for v in values}
        )


def slice_rows(
    df: DataFrame, order: Sequence[Column | str], values: Sequence[str], by: Sequence[str] = ()
) -> Sliced:
    """Cut rows into range slices of (by, order) and add up ``values`` before each slice.

    Slices come from a range shuffle and are written to the checkpoint folder, because range bounds are sampled and a
    second evaluation could cut elsewhere. The offsets have at most (groups + slices) rows, and one group has at most
    one row per slice.
    """
    shared_folder(df.sparkSession)
    sliced = df.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id()).checkpoint()
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = sliced.groupBy(*by, "_slice").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    offsets = totals.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_slice").alias("_at"),
        *[F.col(f"_sum_{v}") for v in values],
        *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_before_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(whole).alias(f"total_{v}") for v in values],
    )
    if not by:
        # one row per range slice, so never more than spark.sql.shuffle.partitions rows
        offsets = F.broadcast(offsets)
    return Sliced(sliced, offsets, tuple(order), tuple(by))


def running_total(
    df: DataFrame,
    order: Sequence[Column | str],
    values: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums of ``values`` in a total order within each ``by`` group, plus the group's total.

    Adds ``running_<v>`` and ``total_<v>``.
    """
    return with_running(slice_rows(df, order, values, by), values, df.columns)


def with_running(sliced: Sliced, values: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return sliced.local(values).join(sliced.offsets, sliced.at_slice()).select(
        *columns,
        *[(F.col(f"_local_{v}") + F.col(f"_before_{v}")).alias(f"running_{v}") for v in values],
        *[F.col(f"total_{v}") for v in values],
    )


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by..., column_name, value)`` of the finite values of numeric columns."""
    typed = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(by), list(columns), "column_name", "value").where(is_finite("value"))


def brackets(probabilities: Sequence[float], accuracy: int = ACCURACY) -> Column:
    """Aggregate: for each probability two values that surely enclose the wanted ranks, as ``ARRAY<DOUBLE>``.

    An approximate quantile is off by at most ``n / accuracy`` ranks, so twice that on either side is enough where that
    is several rows; a group of up to ``4 * accuracy`` rows has infinite ends, as has what would lie beyond them.
    """
    margin, inf = 2.0 / accuracy, F.lit(float("inf"))
    points = [x for p in probabilities for x in (max(p - margin, 0.0), min(p + margin, 1.0))]
    near = F.percentile_approx("value", F.array(*[F.lit(x) for x in points]), accuracy)
    small = F.count("*") <= 4 * accuracy
    ends = []
    for i, p in enumerate(probabilities):
        ends.append(F.when(small, -inf).otherwise(near[2 * i]) if p - margin > 0 else -inf)
        ends.append(F.when(small, inf).otherwise(near[2 * i + 1]) if p + margin < 1 else inf)
    return F.array(*ends)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Exact linear-interpolated quantiles of whole columns: ``(by..., column_name, n, extra..., quantiles ARRAY<DOUBLE>)``.

    ``percentile`` keeps all distinct values of a group in one task's memory. Here a first scan brackets each wanted rank
    by approximate quantiles (and takes the ``extra`` aggregates of ``value``). A second one counts, combined before the
    shuffle, the values inside a bracket one by one and all between two brackets as one, so the running counts give the
    exact ranks. About ``4 / accuracy`` of a large group's rows lie in a bracket; nothing else of it meets in one task,
    nothing is sorted as a whole, and nothing is written.
    """
    rows = long_values(df, columns, by)
    keys = [*by, "column_name"]
    first = rows.groupBy(*keys).agg(F.count("*").alias("n"), *extra, brackets(probabilities, accuracy).alias("_ends"))
    ends = first.select(*[F.col(c).alias(f"_k_{c}") for c in keys], F.col("n").alias("_n"), "_ends")
    # without groups there is one row per column of the schema
    placed = rows.join(ends if by else F.broadcast(ends), _same(keys, "_k_"))
    inside, below = F.lit(False), F.lit(float("-inf"))
    for i in range(len(probabilities)):
        low, high = F.col("_ends")[2 * i], F.col("_ends")[2 * i + 1]
        inside = inside | F.col("value").between(low, high)
        below = F.greatest(below, F.when(high < F.col("value"), high))
    # what lies between brackets stands behind the end of the bracket below it
    counted = (
        placed.groupBy(*keys, F.when(inside, F.col("value")).otherwise(below).alias("_at"), (~inside).alias("_gap"))
        .agg(F.count("*").alias("_c"), F.max("_n").alias("n"))
    )
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_at", "_gap").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("_last", upto - 1)

    def at(position: Column) -> Column:
        here = position.between(F.col("_last") - F.col("_c") + 1, F.col("_last"))
        missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
        return F.max(F.when(here, F.when(F.col("_gap"), missed).otherwise(F.col("_at"))))

    # each end is picked on its own and then joined to a point: aggregates are not nested
    picks, points = [], []
    for i, p in enumerate(probabilities):
        wanted = F.lit(float(p)) * (F.col("n") - 1)
        picks += [at(F.floor(wanted)).alias(f"_lo{i}"), at(F.ceil(wanted)).alias(f"_hi{i}")]
        points.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (wanted - F.floor(wanted)))
    found = ranked.groupBy(*keys).agg(F.max("n").alias("n"), *picks).select(*keys, "n", F.array(*points).alias("quantiles"))
    if not extra:
        return found
    more = first.drop("n", "_ends").select(*[F.col(c).alias(f"_k_{c}" if c in keys else c) for c in first.columns if c not in ("n", "_ends")])
    return found.join(more, _same(keys, "_k_")).drop(*[f"_k_{c}" for c in keys])


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Equality of keys that may be NULL with those of the same names behind a prefix."""
    same = F.col("column_name") == F.col(f"{prefix}column_name")
    for c in keys:
        if c != "column_name":
            same = same & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return same


def top_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    salts: int = 1,
    rank: str = "rn",
) -> DataFrame:
    """The first ``n`` rows of each key in ``order``, with their position as ``rank``.

    Spark already keeps only ``n`` rows per key and task before the shuffle. With ``salts`` above one a hot key is first
    ranked in that many parts, so its final task reads at most ``salts * n`` rows whatever the number of input tasks.
    """
    if salts > 1:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if not _is_nested(df, c)]), F.lit(salts))
        parted = df.withColumn("_part", part)
        in_part = Window.partitionBy(*keys, "_part").orderBy(*order)
        df = parted.withColumn("_rn", F.row_number().over(in_part)).where(F.col("_rn") <= n).drop("_rn", "_part")
    in_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(in_key)).where(F.col(rank) <= n)


def _is_nested(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() == "map"
