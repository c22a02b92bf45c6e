"""Columns, cleaning, features and segments on small tables whose wrong variants give other answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import scalars
from shelfspark.functions.text import identifier, sku_text
from shelfspark.operators import clean, columns, features, segment

D = dt.date


def test_headers(spark):
    df = spark.createDataFrame([("2024-01-01", "a", 1)], " Date string, SKU_ID string, Qty int")
    assert columns.normalize_headers(df).columns == ["date", "sku_id", "units"]
    with pytest.raises(columns.ColumnError):
        columns.normalize_headers(spark.createDataFrame([(1, 2)], "qty int, Sales int"))


def test_defaults_and_missing_columns(spark):
    row = columns.ensure_columns(spark.createDataFrame([("2024-01-01", "a")], "date string, sku_id string")).first()
    assert (row.store_id, row.price, row.promo_flag) == ("S01", 0.0, 0)
    with pytest.raises(columns.ColumnError):
        columns.ensure_columns(spark.createDataFrame([("a",)], "sku_id string"))


def test_dates_in_several_spellings(spark):
    texts = ["2024-01-02", "01/02/2024", "2024/01/02", "not-a-date", None]
    df = spark.createDataFrame([(t,) for t in texts], "date string")
    assert [r.date for r in columns.ensure_date(df, strict=False).collect()] == [D(2024, 1, 2)] * 3 + [None] * 2
    with pytest.raises(columns.ColumnError):
        columns.ensure_date(df)


def test_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("-2",), ("NaN",)], "units string")
    assert [r.units for r in columns.coerce_numeric(df, ["units"]).collect()] == [1.5, 0.0, 0.0, -2.0, 0.0]
    issues = columns.numeric_issues(df, ["units"]).first()
    assert (issues.rescued, issues.missing, issues.below_min) == (1, 2, 1)
    with pytest.raises(columns.ColumnError):
        columns.require_non_negative(df, ["units"])


SPELLINGS = {
    "SKU1": "SKU001", "SKU_001": "SKU001", "SKU-1": "SKU001", "sku_001": "SKU001", "  SKU001  ": "SKU001",
    "123": "SKU123", "SKU1234": "SKU1234", "SKU__001": "SKU001", "SKU-_001": "SKU001", "SKU@001": "SKU001",
    " SKU7 ": "SKU007", "SKU123456789": "SKU123456789", "": "", "SKU": "SKU000", "abc": "ABC",
}


def test_sku_spellings(spark):
    df = spark.createDataFrame([(s,) for s in SPELLINGS], "s string")
    out = df.select("s", scalars.normalize_sku("s").alias("n")).collect()
    assert {r.s: r.n for r in out} == SPELLINGS
    assert {s: sku_text(s) for s in SPELLINGS} == SPELLINGS


def test_identifier():
    assert identifier("sales_2024") == "sales_2024"
    for bad in ("1st", "a b", "a;drop", ""):
        with pytest.raises(ValueError):
            identifier(bad)


def test_dedup_keeps_the_first_in_order(spark):
    df = spark.createDataFrame([("d", "a", "s", 3, 9), ("d", "a", "s", 1, 5), ("d", "b", "s", 2, 7)],
                               "date string, sku_id string, store_id string, seq int, units int")
    assert {(r.sku_id, r.units) for r in clean.dedup(df, ["seq"]).collect()} == {("a", 5), ("b", 7)}


def filled(df, **kw):
    return {(r.sku_id, str(r.date)): r.units for r in clean.fill_date_gaps(df, **kw).collect()}


def test_gaps_take_the_last_value_and_leading_gaps_the_first_of_their_own_series(sales):
    df = sales([
        ("2024-01-01", "B", "S01", 20.0), ("2024-01-04", "B", "S01", 23.0), ("2024-01-03", "A", "S01", 7.0),
    ])
    assert filled(df) == {
        ("A", "2024-01-01"): 7.0, ("A", "2024-01-02"): 7.0, ("A", "2024-01-03"): 7.0, ("A", "2024-01-04"): 7.0,
        ("B", "2024-01-01"): 20.0, ("B", "2024-01-02"): 20.0, ("B", "2024-01-03"): 20.0, ("B", "2024-01-04"): 23.0,
    }


def test_given_bounds_cut_and_extend(sales):
    df = sales([("2024-01-01", "A", "S01", 1.9), ("2024-01-03", "A", "S01", 3.0)])
    assert filled(df, start="2024-01-02", end="2024-01-04") == {
        ("A", "2024-01-02"): 3.0, ("A", "2024-01-03"): 3.0, ("A", "2024-01-04"): 3.0,
    }
    # units are whole after the fill
    assert filled(df, end="2024-01-02") == {("A", "2024-01-01"): 1.0, ("A", "2024-01-02"): 1.0}


def test_missing_values_inside_a_series_are_filled(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 1), "A", "S01", None), (D(2024, 1, 2), "A", "S01", "x"), (D(2024, 1, 3), "A", "S01", None)],
        "date date, sku_id string, store_id string, category string",
    )
    assert [r.category for r in clean.fill_date_gaps(df).orderBy("date").collect()] == ["x", "x", "x"]


def test_a_repeated_key_invents_no_days(sales):
    df = sales([("2024-01-01", "A", "S01", 1.0), ("2024-01-03", "A", "S01", 3.0), ("2024-01-03", "A", "S01", 4.0)])
    with pytest.raises(Exception, match="repeated key: 2024-01-03 A S01"):
        filled(df)


def test_an_unreadable_date_stops_the_cleaning(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "A", "S01", 1.0), ("03.01.2024", "A", "S01", 5.0), ("2024-01-03", "A", "S01", 2.0), (None, "A", "S01", 9.0)],
        "date string, sku_id string, store_id string, units double",
    )
    with pytest.raises(Exception, match="not a date: 03.01.2024"):
        clean.clean_sales(df).collect()
    by_name = clean.clean_sales(df, on_bad_dates="null")
    assert [(str(r.date), r.units) for r in by_name.orderBy("date").collect()] == [("2024-01-01", 1.0), ("2024-01-02", 1.0), ("2024-01-03", 2.0)]
    assert tuple(clean.rescued_dates(df).first()) == (4, 1, 1)
    with pytest.raises(ValueError):
        clean.clean_sales(df, on_bad_dates="drop")


@pytest.mark.parametrize("values, expected", [
    ([10.0] * 9 + [1000.0], [10.0] * 10),
    ([10.0] * 10 + [1.0, 100.0], [10.0] * 12),
    ([10.0, 11.0, 100.0], [10.0, 11.0, 100.0]),
    # all negative: the lower bound 0 is above the upper one, so the bounds change places
    ([-4.0, -4.0, -4.0], [-4.0, -4.0, -4.0]),
])
def test_cap(spark, values, expected):
    df = spark.createDataFrame([("A", "S01", v) for v in values], "sku_id string, store_id string, units double")
    assert sorted(r.units for r in clean.cap_iqr(df).collect()) == sorted(expected)
    wide = clean.cap_iqr_wide(df, "units", ["sku_id"])
    assert sorted(r.units for r in wide.collect()) == sorted(expected)


def test_clean_equals_its_steps(spark):
    """The quartiles taken from weighted facts are those of the filled series."""
    rows = [(D(2024, 1, 1) + dt.timedelta(days=d), f"S{k}", "S01", float((d * 7 + k * 3) % 13 + 90 * (d % 11 == 0)), d)
            for k in range(4) for d in range(0, 60, k + 1)]
    df = spark.createDataFrame(rows, "date date, sku_id string, store_id string, units double, seq int")
    whole = clean.clean_sales(df, order=["seq"], drop=["seq"])
    base = columns.zero_fill(columns.ensure_columns(df)).drop("seq")
    steps = clean.cap_iqr(clean.fill_date_gaps(base))
    key = lambda d: sorted((r.sku_id, str(r.date), r.units, r.price, r.promo_flag) for r in d.collect())
    assert key(whole) == key(steps)


def test_calendar_features(spark):
    days = ["2024-02-29", "2023-12-31", "2024-12-30", "2024-01-08", "2024-05-09"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("date"))
    got = {str(r.date): r for r in features.add_calendar(df).collect()}
    assert (got["2024-02-29"].day_of_year, got["2024-02-29"].dow, got["2024-02-29"].quarter) == (60, 3, 1)
    assert (got["2023-12-31"].week, got["2023-12-31"].is_weekend, got["2024-12-30"].week) == (52, 1, 1)
    assert [got[d].is_holiday for d in days] == [0, 0, 0, 1, 1]


def test_lags_and_rolling_means(sales):
    df = sales([(f"2024-01-{d:02d}", "A", "S01", float(d)) for d in range(1, 11)])
    got = features.build_features(df).orderBy("date").collect()
    assert got[0].units_lag_1 == 0.0 and got[8].units_lag_7 == 2.0 and got[9].units_ma_7 == 7.0
    past = features.build_features(df, exclude_current=True, fill=None).orderBy("date").collect()
    assert past[0].units_ma_7 is None and past[0].units_lag_1 is None and past[9].units_ma_7 == 6.0


@pytest.mark.parametrize("block", [6, 7, 100_000])
def test_moving_average_across_blocks(sales, block):
    rows = [(f"2024-01-{d:02d}", sku, f"S0{s}", float((d * 7 + s * 5) % 11)) for d in range(1, 15)
            for sku, stores in (("A", 3), ("B", 1)) for s in range(stores)]
    got = {(r.sku_id, str(r.date), r.store_id): (r.rolling_2, r.rolling_7)
           for r in features.moving_average(sales(rows), (2, 7), block).collect()}
    assert len(got) == len(rows)
    for sku in "AB":
        ordered = sorted((d, s, u) for d, k, s, u in rows if k == sku)
        for i, (d, s, _) in enumerate(ordered):
            means = [sum(x[2] for x in ordered[max(0, i + 1 - n):i + 1]) / min(n, i + 1) for n in (2, 7)]
            assert got[sku, d, s] == pytest.approx(tuple(means))


def classes(spark, rows):
    df = spark.createDataFrame(rows, "sku_id string, units double")
    return {r.sku_id: r.ABCXYZ for r in segment.abc_xyz(df).collect()}


def test_abc_xyz_edges(spark):
    # a lone SKU has share 1.0 and is C; one row has no deviation and is Z
    assert classes(spark, [("A", 5.0)]) == {"A": "CZ"}
    # the inclusive share decides: 80 of 100 is still A, 95 of 100 still B
    assert classes(spark, [("A", 80.0), ("B", 15.0), ("C", 5.0)]) == {"A": "AZ", "B": "BZ", "C": "CZ"}
    # no units at all: no share, class C, no ratio, class Z
    assert classes(spark, [("A", 0.0), ("A", 0.0)]) == {"A": "CZ"}
    steady = [("A", 100.0), ("A", 100.0), ("B", 100.0), ("B", 130.0)]
    assert {k: v[1] for k, v in classes(spark, steady).items()} == {"A": "X", "B": "Y"}


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(scalars.safe_divide("a", "b", -1.0)).collect()] == [-1.0, 0.25, None]
    numbers = spark.createDataFrame([(1234567.891,), (None,)], "a double")
    assert [r[0] for r in numbers.select(scalars.format_number("a")).collect()] == ["1,234,567.89", "N/A"]
    half = spark.createDataFrame([(0.125, "x", 2)], "a double, s string, n int")
    assert tuple(scalars.round_metrics(half).first()) == (0.12, "x", 2)
    key = spark.range(1).select(scalars.metric_key(F.lit("m"), F.create_map(F.lit("z"), F.lit("1"), F.lit("a"), F.lit("2"))))
    assert key.first()[0] == 'm{a="2",z="1"}'
    bare = spark.range(1).select(scalars.metric_key(F.lit("m"), F.lit(None).cast("map<string,string>")))
    assert bare.first()[0] == "m"
