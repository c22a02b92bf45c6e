"""Quality checks and drift against hand-made cases and brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.operators import drift, quality
from shelfspark.operators.columns import ColumnError

D = dt.date


@pytest.fixture(scope="module")
def flawed(spark):
    """100 rows: eleven without units, six negative, the first five repeated."""
    rows = []
    for i in range(100):
        units = None if i <= 10 else -5.0 if 20 <= i <= 25 else float(10 + i % 7)
        rows.append((D(2024, 1, 1) + dt.timedelta(days=i), f"SKU{i % 3:03d}" if i != 50 else "odd", "S01", units, 100.0))
    return spark.createDataFrame(rows + rows[:5], "date date, sku_id string, store_id string, units double, price double")


def test_report(flawed):
    found = {(f.category, f.severity, f.column_name): f.affected_rows
             for f in quality.quality_report(flawed, as_of="2024-03-31").collect()}
    assert found == {
        ("missing", "critical", "units"): 16,
        ("duplicates", "warning", None): 5,
        ("duplicates", "critical", "date, sku_id, store_id"): 5,
        ("date_range", "warning", "date"): 9,
        ("numeric_range", "critical", "units"): 6,
        ("consistency", "warning", "sku_id"): 1,
        # the six negative values are more than three deviations off, and more than five percent of the rows
        ("outlier", "critical", "units"): 6,
    }


def test_summary(flawed):
    report = quality.quality_report(flawed, as_of="2030-01-01")
    rows = quality.report_summary(report).collect()
    total = [r for r in rows if r.severity is None and r.category is None]
    assert (total[0].issues, total[0].passed) == (6, False)
    assert {r.severity: r.issues for r in rows if r.severity} == {"critical": 4, "warning": 2}


def test_clean_table_passes(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "SKU001", "S01", 1.0, 2.0)],
                               "date date, sku_id string, store_id string, units double, price double")
    report = quality.quality_report(df, as_of="2024-02-01")
    assert report.count() == 0
    assert quality.report_summary(report).where("passed").count() == 1


def test_report_without_columns_and_with_bad_dates(spark):
    df = spark.createDataFrame([("soon", "SKU001", 0.0, 1)], "date string, sku_id string, units double, extra int")
    found = {(f.category, f.severity) for f in quality.quality_report(df, as_of="2024-01-01").collect()}
    assert found == {("schema", "critical"), ("schema", "info"), ("date_range", "critical"), ("numeric_range", "warning")}


def test_types(flawed):
    expected = {"units": "int", "price": "float", "date": "datetime", "sku_id": "string", "gone": "int", "store_id": "?"}
    assert [m["column_name"] for m in quality.type_mismatches(flawed, expected)] == ["units", "gone"]


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), ("a", 1)], "k string, v int")
    row = quality.duplicate_counts(df, ["k"]).first()
    assert (row.full_duplicates, row.key_duplicates) == (1, 2)
    marked = quality.mark_duplicates(df, ["k"], ["v"])
    assert sorted((r.v, r.repeats) for r in marked.collect()) == [(1, 1), (2, 1)]


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [10, 11, 12, 13, 14, 15, 100]], "v double")
    assert [r.v for r in quality.outliers_z(df, "v", 2.0).where("is_outlier").collect()] == [100.0]
    assert quality.outliers_iqr(df, ["v"]).first().outliers == 1
    same = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert quality.outliers_z(same, "v").where("is_outlier").count() == 0
    steps = spark.createDataFrame([(1.0,)] * 9 + [(5.0,)], "v double")
    assert quality.outliers_iqr(steps, ["v"]).first().outliers == 1
    assert quality.outliers_iqr(steps, ["v"], skip_constant=True).first().outliers == 0


def test_orphans_and_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    some, with_null = spark.createDataFrame([(1,)], "r int"), spark.createDataFrame([(1,), (None,)], "r int")
    assert quality.orphans(df, "k", some, "r").count() == 3
    assert quality.orphan_count(df, "k", some, "r").first().orphans == 3
    assert quality.orphan_count(df, "k", with_null, "r").first().orphans == 2


def test_not_allowed_includes_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert quality.not_allowed(df, "c", ["a"]).count() == 2


def days(spark, texts):
    return spark.createDataFrame([("x", t) for t in texts], "g string, d string").select("g", F.col("d").cast("date").alias("date"))


def test_continuity(spark):
    df = days(spark, ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-05"])
    row = quality.continuity(df, ["g"]).first()
    assert (row.missing_dates, row.first_missing) == (2, D(2024, 1, 3))
    assert quality.continuity_total(df).first().missing_dates == 2
    assert [r.date for r in quality.missing_dates(df, ["g"]).orderBy("date").collect()] == [D(2024, 1, 3), D(2024, 1, 4)]
    weekly = days(spark, ["2024-01-03", "2024-01-10", "2024-01-12", "2024-01-31"])
    row = quality.continuity(weekly, ["g"], "W").first()
    assert (row.missing_dates, row.first_missing) == (2, D(2024, 1, 17))
    assert [r.date for r in quality.missing_dates(weekly, ["g"], "W").collect()] == [D(2024, 1, 17), D(2024, 1, 24)]
    # the last day lies between two steps: the steps up to it are expected too
    trailing = days(spark, ["2024-01-03", "2024-01-10", "2024-01-30"])
    assert quality.continuity(trailing, ["g"], "W").first().missing_dates == 2


def test_file_validation(spark):
    rows = [(str(D(2024, 1, 1) + dt.timedelta(days=i)), "SKU001", "5") for i in range(40)]
    good = spark.createDataFrame(rows, "date string, sku_id string, units string")
    quality.assert_valid_file(good)
    for change, failing in [
        (good.limit(10), "day_coverage"),
        (good.withColumn("units", F.lit("-1")), "units_not_negative"),
        (good.withColumn("date", F.lit("soon")), "dates"),
        (good.drop("sku_id"), "columns"),
        (good.limit(0), "rows"),
    ]:
        failed = {r.check_name for r in quality.file_validation(change).where("failed").collect()}
        assert failing in failed
        with pytest.raises(ColumnError):
            quality.assert_valid_file(change)


def test_model_ready(spark):
    ok = spark.range(30).select(F.current_date().alias("date"), F.lit("a").alias("sku_id"), F.lit(1.0).alias("units"))
    quality.assert_model_ready(ok)
    with pytest.raises(ColumnError):
        quality.assert_model_ready(ok.limit(29))
    with pytest.raises(ColumnError):
        quality.assert_model_ready(ok.withColumn("units", F.lit(None).cast("double")))


def test_profile(flawed):
    row = quality.profile(flawed).first()
    assert (row.rows, row.columns, row.skus, row.days, row.duplicates) == (105, 5, 4, 99, 5)
    assert row.missing_percent["units"] == 15.2 and row.outliers["price"] == 0


@pytest.fixture(scope="module")
def two_sides(spark):
    rng = np.random.default_rng(11)
    a, b = np.round(rng.normal(50, 10, 400), 1), np.round(rng.normal(56, 14, 300), 1)
    make = lambda v: spark.createDataFrame([(float(x), 3.0) for x in v], "v double, c double")
    return a, b, make(a), make(b)


def test_ks(two_sides):
    a, b, ref, cur = two_sides
    grid = np.sort(np.concatenate([a, b]))
    at = lambda v: np.searchsorted(np.sort(v), grid, side="right") / len(v)
    row = {r.column_name: r for r in drift.ks_drift(ref, cur).collect()}
    assert row["v"].ks_statistic == pytest.approx(np.abs(at(a) - at(b)).max())
    assert row["v"].mean_change_pct == pytest.approx((b.mean() - a.mean()) / a.mean() * 100)
    assert row["v"].cur_std == pytest.approx(b.std(ddof=1)) and row["v"].has_drift
    assert row["c"].ks_statistic == 0.0 and row["c"].ks_pvalue == 1.0 and not row["c"].has_drift


def test_kolmogorov_series(spark):
    """Both forms of the series against the published upper tail: Q(0.5) = 0.9639, Q(1.0) = 0.2700, Q(1.358) = 0.05."""
    for x, q in [(0.5, 0.9639), (1.0, 0.2700), (1.358, 0.05)]:
        p = spark.range(1).select(drift.kolmogorov_p(F.lit(x), F.lit(2.0), F.lit(2.0))).first()[0]
        assert p == pytest.approx(q, abs=5e-4)


def test_psi(two_sides):
    a, b, ref, cur = two_sides
    edges = np.unique(np.percentile(a, np.linspace(0, 100, 11)))
    share = lambda v: np.where((h := np.histogram(v, edges)[0] / len(v)) == 0, 0.0001, h)
    r, c = share(a), share(b)
    got = {x.column_name: x.psi for x in drift.psi(ref, cur, ["v", "c"]).collect()}
    assert got["v"] == pytest.approx(((c - r) * np.log(c / r)).sum())
    assert got["c"] == 0.0


def test_column_stats(two_sides):
    a, _, ref, _ = two_sides
    row = {r.column_name: r for r in drift.reference_stats(ref).collect()}["v"]
    assert (row["count"], row.min, row.max) == (400, a.min(), a.max())
    assert [row.mean, row.std, row.q25, row.median, row.q75] == pytest.approx(
        [a.mean(), a.std(ddof=1), *np.quantile(a, [0.25, 0.5, 0.75])]
    )
