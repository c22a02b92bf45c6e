"""Data quality. Checks return findings as rows; the ``assert_*`` forms raise on them.

A finding has the columns of ``schema.FINDING``. A report costs a fixed number of scans, whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Day

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shelfspark import schema
from shelfspark.functions.scalars import day_span
from shelfspark.operators.clean import dedup, iqr_bounds
from shelfspark.operators.columns import ColumnError, missing_columns, parse_date
from shelfspark.operators.ordered import exact_quantiles

# Columns a report expects, and the SKU id pattern.
REPORT_REQUIRED = ["date", "sku_id", "store_id", "units"]
REPORT_EXPECTED = ["date", "sku_id", "store_id", "units", "price"]
SKU_PATTERN = r"^SKU\d+$"

TYPE_CLASSES: dict[str, tuple[type, ...]] = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "numeric": (T.NumericType,),
    "string": (T.StringType,),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "bool": (T.BooleanType,),
}


def finding(
    severity: Column | str,
    category: str,
    column: str | None,
    message: Column,
    affected: Column,
    details: dict[str, Column] | None = None,
) -> Column:
    entries = [x for k, v in (details or {}).items() for x in (F.lit(k), v.cast("string"))]
    return F.struct(
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        F.lit(category).alias("category"),
        F.lit(column).cast("string").alias("column_name"),
        message.alias("message"),
        affected.cast("bigint").alias("affected_rows"),
        (F.create_map(*entries) if entries else F.lit(None)).cast("map<string,string>").alias("details"),
    )


def _is_missing(df: DataFrame, c: str) -> Column:
    floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
    return F.col(c).isNull() | F.isnan(c) if floating else F.col(c).isNull()


# ---- schema -------------------------------------------------------------------------------------------------------


def schema_findings(df: DataFrame) -> list[Column]:
    """Missing required columns are critical, unexpected ones are information. Reads no data."""
    out = []
    missing = missing_columns(df, REPORT_REQUIRED)
    if missing:
        out.append(
            finding("critical", "schema", None, F.lit(f"missing required columns: {', '.join(missing)}"), F.lit(0))
        )
    extra = [c for c in df.columns if c not in REPORT_EXPECTED]
    if extra:
        out.append(finding("info", "schema", None, F.lit(f"unexpected columns: {', '.join(extra)}"), F.lit(0)))
    return out


def type_mismatches(df: DataFrame, expected: dict[str, str]) -> list[dict[str, str | None]]:
    """Columns whose type is not of the expected class; unknown classes are not checked. Reads no data."""
    out: list[dict[str, str | None]] = []
    for c, kind in expected.items():
        if c not in df.columns:
            out.append({"column_name": c, "expected": kind, "actual": None})
        elif kind in TYPE_CLASSES and not isinstance(df.schema[c].dataType, TYPE_CLASSES[kind]):
            out.append({"column_name": c, "expected": kind, "actual": df.schema[c].dataType.simpleString()})
    return out


# ---- single checks ------------------------------------------------------------------------------------------------


def missing_values(df: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Per column: missing count and share, and whether the share is above the threshold. One scan."""
    counts = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(_is_missing(df, c)).alias("missing")) for c in df.columns
    ]
    one = df.agg(F.count("*").alias("rows"), F.array(*counts).alias("_c"))
    share = F.coalesce(F.try_divide(F.col("missing"), F.col("rows")), F.lit(0.0))
    return (
        one.select("rows", F.inline("_c"))
        .withColumn("share", share)
        .withColumn("exceeds", F.col("share") > threshold)
        .drop("rows")
    )


def completeness(df: DataFrame, columns: Sequence[str], max_percent: float = 10.0) -> DataFrame:
    """Critical columns with more than ``max_percent`` missing."""
    present = [c for c in columns if c in df.columns]
    return missing_values(df.select(*present), max_percent / 100).where("exceeds").select(
        "column_name", (F.col("share") * 100).alias("percent")
    )


def duplicate_counts(df: DataFrame, keys: Sequence[str] = tuple(schema.SALES_KEY)) -> DataFrame:
    """Rows that repeat a whole earlier row, and rows that repeat an earlier key.

    Both come from one aggregation chain over whole rows; equal rows are combined before the shuffle, and NULLs count as
    equal.
    """
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    per_key = rows.groupBy(*keys).agg(F.sum("_n").alias("_rows"), F.count("*").alias("_different"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("_rows") - F.col("_different")), F.lit(0)).alias("full_duplicates"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("key_duplicates"),
    )


def mark_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows after the first of each key, as distinct rows with ``repeats``, how often each occurs among them.

    Equal rows are combined first and the rest is matched on whole rows, so the rows of one hot key are spread.
    """
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    first = dedup(rows, [*order, *[c for c in df.columns if c not in order]], keys)
    ours, theirs = rows.alias("r"), first.alias("f")
    same = F.lit(True)
    for c in df.columns:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}"))
    later = ours.join(theirs, same, "left_anti").withColumnRenamed("_n", "repeats")
    copies = first.where(F.col("_n") > 1).withColumn("repeats", F.col("_n") - 1).drop("_n")
    return later.unionByName(copies)


def date_range(df: DataFrame, as_of: Column, min_date=None, max_date=None, column: str = "date") -> DataFrame:
    """Counts of dates before the minimum, after the maximum and after ``as_of``."""
    c = F.col(column)
    below = (c < F.lit(min_date).cast("date")) if min_date else F.lit(False)
    above = (c > F.lit(max_date).cast("date")) if max_date else F.lit(False)
    return df.agg(
        F.count_if(below).alias("before_min"), F.count_if(above).alias("after_max"),
        F.count_if(c > as_of).alias("future"),
    )


def day_coverage(df: DataFrame, min_days: int = 30, max_days: int = 1000) -> DataFrame:
    days = df.agg(day_span("date").alias("days"))
    return days.withColumns({"too_short": F.col("days") < min_days, "very_long": F.col("days") > max_days})


def numeric_range(df: DataFrame, column: str, min_value=None, max_value=None, allow_negative: bool = False) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.count_if((c < 0) & F.lit(not allow_negative)).alias("negative"),
        F.count_if(c < F.lit(min_value) if min_value is not None else F.lit(False)).alias("below_min"),
        F.count_if(c > F.lit(max_value) if max_value is not None else F.lit(False)).alias("above_max"),
    )


def _z_mask(df: DataFrame, column: str, threshold: float) -> Column:
    """|x - mean| / std above the threshold. The one-row statistics are a scalar subquery, not a join."""
    stats = df.agg(F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))).scalar()
    z = F.abs(F.try_divide(F.col(column) - stats.getField("mean"), stats.getField("std")))
    return F.coalesce(z > threshold, F.lit(False))


def outliers_z(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """All rows with ``is_outlier``; a constant column has none."""
    return df.withColumn("is_outlier", _z_mask(df, column, threshold))


def iqr_fences(df: DataFrame, columns: Sequence[str], multiplier: float = 1.5) -> DataFrame:
    """Exact quartile fences of whole columns, one row per column."""
    q = exact_quantiles(df, columns, [0.25, 0.75])
    low, high = iqr_bounds(F.col("quantiles")[0], F.col("quantiles")[1], multiplier)
    return q.select(
        "column_name", low.alias("low"), high.alias("high"),
        (F.col("quantiles")[1] - F.col("quantiles")[0]).alias("iqr"),
    )


def outliers_iqr(
    df: DataFrame, columns: Sequence[str], multiplier: float = 1.5, skip_constant: bool = False
) -> DataFrame:
    """Values outside the fences per column; ``skip_constant`` reports 0 where the quartiles are equal.

    The fences are one row per column and are broadcast; nothing runs before the result is asked for.
    """
    fences = iqr_fences(df, columns, multiplier)
    if skip_constant:
        fences = fences.where("iqr <> 0")
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    values = typed.unpivot([], list(columns), "column_name", "value")
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    counts = values.join(F.broadcast(fences), "column_name").groupBy("column_name").agg(F.count_if(outside).alias("outliers"))
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name"))
    return names.join(counts, "column_name", "left").select("column_name", F.coalesce("outliers", F.lit(0).cast("long")).alias("outliers"))


def invalid_skus(df: DataFrame) -> DataFrame:
    """Spellings of sku_id that are not ``SKU`` and digits, with their row counts."""
    bad = ~F.coalesce(F.col("sku_id").cast("string").rlike(SKU_PATTERN), F.lit(False))
    return df.where(bad).groupBy("sku_id").agg(F.count("*").alias("n"))


def format_check(df: DataFrame, examples: int = 5) -> DataFrame:
    """Row count of invalid SKU ids and a few of them; the examples are a top-k, never the whole set."""
    bad = invalid_skus(df)
    few = bad.orderBy("sku_id").limit(examples).agg(F.sort_array(F.collect_list("sku_id"))).scalar()
    return bad.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("invalid")).withColumn("examples", few)


def not_allowed(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Rows whose value is outside the list; NULL is outside."""
    return df.where(~F.coalesce(F.col(column).isin(list(allowed)), F.lit(False)))


def orphans(df: DataFrame, foreign_key: str, reference: DataFrame, key: str) -> DataFrame:
    """Rows without a partner. A NULL key is an orphan unless the reference holds a NULL too."""
    ref = reference.select(F.col(key).alias("_key")).distinct()
    return df.join(ref, F.col(foreign_key).eqNullSafe(F.col("_key")), "left_anti")


def orphan_count(df: DataFrame, foreign_key: str, reference: DataFrame, key: str) -> DataFrame:
    """Counted per key value before the join, so a hot key is one row there."""
    counted = df.groupBy(foreign_key).agg(F.count("*").alias("_n"))
    return orphans(counted, foreign_key, reference, key).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))


_STEP = {"D": 1, "W": 7}


def gaps(df: DataFrame, by: Sequence[str] = (), frequency: str = "D", column: str = "date") -> DataFrame:
    """Runs of missing steps as ``(by..., first_missing, until, missing)``; ``until`` is the first step after the run.

    Works on distinct days, so a group has at most one row per day of the calendar. Weekly steps count from the group's
    own first day, up to its last day.
    """
    step = _STEP[frequency]
    days = df.select(*by, F.col(column).cast("date").alias("_d")).where(F.col("_d").isNotNull()).distinct()
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    ends = days.withColumns({"_lo": F.min("_d").over(group), "_hi": F.max("_d").over(group)})
    on_step = ends.where(F.datediff("_d", "_lo") % step == 0) if step > 1 else ends
    steps = F.floor(F.datediff("_hi", "_lo") / step).cast("int") + 1
    after_all = F.date_add("_lo", steps * step)
    until = F.coalesce(F.lead("_d").over(group.orderBy("_d")), after_all)
    return (
        on_step.withColumn("until", until)
        .where(F.datediff("until", "_d") > step)
        .select(
            *by,
            F.date_add("_d", step).alias("first_missing"),
            "until",
            (F.datediff("until", "_d") / step - 1).cast("bigint").alias("missing"),
        )
    )


def continuity(df: DataFrame, by: Sequence[str] = tuple(schema.SERIES), frequency: str = "D") -> DataFrame:
    """Groups with missing steps: how many, and the first."""
    return gaps(df, by, frequency).groupBy(*by).agg(
        F.sum("missing").alias("missing_dates"), F.min("first_missing").alias("first_missing")
    )


def continuity_total(df: DataFrame, frequency: str = "D") -> DataFrame:
    """Missing steps of the table as a whole."""
    total = gaps(df, (), frequency).agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_dates"))
    return total.withColumn("has_gaps", F.col("missing_dates") > 0)


def missing_dates(df: DataFrame, by: Sequence[str] = (), frequency: str = "D") -> DataFrame:
    """Every missing step as a row, unrolled from the gaps instead of subtracted from a calendar."""
    last = F.date_sub("until", _STEP[frequency])
    days = F.sequence("first_missing", last, F.expr(f"INTERVAL {_STEP[frequency]} DAY"))
    return gaps(df, by, frequency).select(*by, F.explode(days).alias("date"))


def sku_count(df: DataFrame, min_skus: int = 1) -> DataFrame:
    n = df.select("sku_id").where(F.col("sku_id").isNotNull()).distinct().agg(F.count("*").alias("skus"))
    return n.withColumn("enough", F.col("skus") >= min_skus)


def model_ready(df: DataFrame, min_rows: int = 30) -> DataFrame:
    """Whether a table can be trained on: enough rows, and no missing date, SKU or units."""
    needed = ["date", "sku_id", "units"]
    missing = missing_columns(df, needed)
    nulls = [F.count_if(_is_missing(df, c)) for c in needed if c not in missing]
    total = nulls[0] if nulls else F.lit(0)
    for n in nulls[1:]:
        total = total + n
    one = df.agg(F.count("*").alias("rows"), total.alias("nulls"))
    ok = (F.col("rows") >= min_rows) & (F.col("nulls") == 0) & F.lit(not missing)
    return one.withColumn("ready", ok)


def assert_model_ready(df: DataFrame, min_rows: int = 30) -> None:
    row = model_ready(df, min_rows).first()
    if not row.ready:
        raise ColumnError(f"not ready for training: {row.rows} rows, {row.nulls} missing values")


# ---- reports ------------------------------------------------------------------------------------------------------


def quality_report(
    df: DataFrame,
    as_of: Column | Day | str | None = None,
    missing_threshold: float = 0.1,
    outlier_std: float = 3.0,
    min_date: Day | str | None = None,
    max_date: Day | str | None = None,
) -> DataFrame:
    """All findings of a sales table: schema, missing, duplicates, date range, numeric range, outliers, id format.

    Three scans: one aggregation for all counts, one for duplicates, and the subquery with mean and deviation.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date") if as_of else F.current_date()
    has = set(df.columns)
    counts: dict[str, Column] = {"rows": F.count("*")}
    for i, c in enumerate(df.columns):
        counts[f"missing_{i}"] = F.count_if(_is_missing(df, c))
    if "date" in has:
        text = isinstance(df.schema["date"].dataType, T.StringType)
        day = parse_date("date") if text else F.col("date").cast("date")
        counts["unread"] = F.count_if(day.isNull() & F.col("date").isNotNull())
        counts["future"] = F.count_if(day > as_of)
        counts["early"] = F.count_if(day < F.lit(min_date).cast("date"))
        counts["late"] = F.count_if(day > F.lit(max_date).cast("date"))
    if "units" in has:
        counts["units_below"] = F.count_if(F.col("units") < 0)
        counts["units_zero"] = F.count_if(F.col("units") == 0)
        counts["outside"] = F.count_if(_z_mask(df, "units", outlier_std))
    if "price" in has:
        counts["price_below"] = F.count_if(F.col("price") < 0)
    if "sku_id" in has:
        counts["odd_skus"] = F.count_if(~F.coalesce(F.col("sku_id").cast("string").rlike(SKU_PATTERN), F.lit(False)))
    one = df.agg(*[v.alias(k) for k, v in counts.items()])

    rows, found = F.col("rows"), schema_findings(df)

    def report(severity, category, column, n: str, text: str, when: Column | None = None) -> None:
        share = F.try_divide(F.col(n), rows)
        hit = (F.col(n) > 0) if when is None else when
        row = finding(
            severity, category, column, F.concat(F.col(n).cast("string"), F.lit(f" {text}")), F.col(n),
            {"count": F.col(n), "share": F.bround(share, 6)},
        )
        found.append(F.when(hit, row))

    for i, c in enumerate(df.columns):
        share = F.try_divide(F.col(f"missing_{i}"), rows)
        severity = F.when(share > missing_threshold, "critical").otherwise("warning")
        report(severity, "missing", c, f"missing_{i}", "missing values")
    if "date" in has:
        readable = F.col("unread") == 0
        report("critical", "date_range", "date", "unread", "values are not dates")
        report("warning", "date_range", "date", "future", "future dates", readable & (F.col("future") > 0))
        report("warning", "date_range", "date", "early", "dates before the minimum", readable & (F.col("early") > 0))
        report("warning", "date_range", "date", "late", "dates after the maximum", readable & (F.col("late") > 0))
    if "units" in has:
        report("critical", "numeric_range", "units", "units_below", "negative values")
        report("warning", "numeric_range", "units", "units_zero", "zero values", F.col("units_zero") > rows * 0.5)
        few = F.when(F.try_divide(F.col("outside"), rows) < 0.05, "warning").otherwise("critical")
        report(few, "outlier", "units", "outside", f"values beyond {outlier_std} deviations")
    if "price" in has:
        report("critical", "numeric_range", "price", "price_below", "negative values")
    if "sku_id" in has:
        report("warning", "consistency", "sku_id", "odd_skus", "SKU ids of another format")
    findings = one.select(F.inline(F.filter(F.array(*found), lambda f: f.isNotNull())))

    keyed = all(c in has for c in schema.SALES_KEY)
    dup = duplicate_counts(df, schema.SALES_KEY if keyed else df.columns)
    repeats = [F.when(
        F.col("full_duplicates") > 0,
        finding("warning", "duplicates", None, F.concat(F.col("full_duplicates").cast("string"), F.lit(" repeated rows")),
                F.col("full_duplicates"), {"count": F.col("full_duplicates")}),
    )]
    if keyed:
        repeats.append(F.when(
            F.col("key_duplicates") > 0,
            finding("critical", "duplicates", "date, sku_id, store_id",
                    F.concat(F.col("key_duplicates").cast("string"), F.lit(" repeated keys")),
                    F.col("key_duplicates"), {"count": F.col("key_duplicates")}),
        ))
    return findings.unionByName(dup.select(F.inline(F.filter(F.array(*repeats), lambda f: f.isNotNull()))))


def report_summary(findings: DataFrame) -> DataFrame:
    """Issues and affected rows by severity, by category and in all (both NULL), in one pass; plus ``passed``.

    One empty row is added, so that a report without findings has a total too.
    """
    severity, category = F.col("severity"), F.col("category")
    none = findings.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("severity"), F.lit(None).cast("string").alias("category"),
        F.lit(0).cast("bigint").alias("affected_rows"), F.lit(0).alias("_issue"),
    )
    rows = findings.select("severity", "category", "affected_rows", F.lit(1).alias("_issue")).unionByName(none)
    sets = rows.groupingSets([[severity], [category], []], severity, category).agg(
        F.sum("_issue").alias("issues"),
        F.sum("affected_rows").alias("affected_rows"),
        F.count_if(F.col("severity") == "critical").alias("_critical"),
        F.grouping_id("severity", "category").alias("_set"),
    )
    total = F.col("_set") == 3
    return sets.where(total | (F.col("issues") > 0)).select(
        "severity", "category", "issues", "affected_rows", F.when(total, F.col("_critical") == 0).alias("passed")
    )


def _repeats_and_skus(df: DataFrame, keys: Sequence[str]) -> Column:
    """Struct (skus, repeats) by one pass: rows per key first, then keys per SKU."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    per_sku = per_key.groupBy("sku_id").agg(F.sum(F.col("_n") - 1).alias("_r"))
    return per_sku.agg(
        F.struct(F.count("sku_id").alias("skus"), F.coalesce(F.sum("_r"), F.lit(0)).alias("repeats"))
    ).scalar()


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, SKUs, date range, missing percent per column, repeated rows, outliers per number."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    percents = [
        x for c in df.columns
        for x in (F.lit(c), F.bround(F.try_divide(F.count_if(_is_missing(df, c)), F.count("*")) * 100, 1))
    ]
    base = df.agg(
        F.count("*").alias("rows"),
        F.min("date").alias("min_date"), F.max("date").alias("max_date"), day_span("date").alias("days"),
        F.create_map(*percents).alias("missing_percent"),
    )
    keyed = _repeats_and_skus(df, df.columns)
    outside = outliers_iqr(df, numeric, skip_constant=True).agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "outliers")))
    ).scalar()
    return base.withColumns(
        {
            "columns": F.lit(len(df.columns)), "skus": keyed.getField("skus"), "duplicates": keyed.getField("repeats"),
            "outliers": outside,
        }
    )


def file_validation(df: DataFrame) -> DataFrame:
    """The checks a new sales file must pass, in order, as rows (step, check_name, failed, detail).

    Missing columns end the check; everything else is counted in one scan plus one for repeated keys.
    """
    missing = missing_columns(df, schema.REQUIRED)
    if missing:
        row = F.struct(
            F.lit(1).alias("step"), F.lit("columns").alias("check_name"), F.lit(True).alias("failed"),
            F.lit(f"missing {', '.join(missing)}").alias("detail"),
        )
        return df.sparkSession.range(1).select(F.inline(F.array(row)))
    text = isinstance(df.schema["date"].dataType, T.StringType)
    day = parse_date("date") if text else F.col("date").cast("date")
    counts = {
        "rows": F.count("*"), "bad_dates": F.count_if(day.isNull()), "span": F.datediff(F.max(day), F.min(day)),
    }
    numbers = [c for c in ("units", "price") if c in df.columns]
    critical = [c for c in ("date", "sku_id", "units") if c in df.columns]
    for c in numbers:
        counts[f"below_{c}"] = F.count_if(F.col(c).try_cast("double") < 0)
    for c in critical:
        counts[f"null_{c}"] = F.count_if(F.col(c).isNull())
    keys = [c for c in schema.SALES_KEY if c in df.columns]
    keyed = _repeats_and_skus(df, keys)
    one = df.agg(*[v.alias(k) for k, v in counts.items()]).withColumns(
        {"skus": keyed.getField("skus"), "repeats": keyed.getField("repeats")}
    )
    checks = [
        ("rows", F.col("rows") == 0, F.col("rows")),
        ("dates", F.col("bad_dates") > 0, F.col("bad_dates")),
        ("day_coverage", F.coalesce(F.col("span") < 30, F.lit(True)), F.col("span")),
        *[(f"{c}_not_negative", F.col(f"below_{c}") > 0, F.col(f"below_{c}")) for c in numbers],
        ("sku_count", F.col("skus") < 1, F.col("skus")),
        # repeated keys are reported, but do not fail a file
        ("repeated_keys", F.lit(False), F.col("repeats")),
        *[
            (f"{c}_complete", F.coalesce(F.try_divide(F.col(f"null_{c}"), F.col("rows")) > 0.1, F.lit(False)),
             F.col(f"null_{c}"))
            for c in critical
        ],
    ]
    rows = [
        F.struct(
            F.lit(i + 1).alias("step"), F.lit(name).alias("check_name"), bad.alias("failed"),
            seen.cast("string").alias("detail"),
        )
        for i, (name, bad, seen) in enumerate(checks)
    ]
    return one.select(F.inline(F.array(*rows)))


def assert_valid_file(df: DataFrame) -> None:
    bad = file_validation(df).where("failed").orderBy("step").first()
    if bad is not None:
        raise ColumnError(f"{bad.check_name}: {bad.detail}")

