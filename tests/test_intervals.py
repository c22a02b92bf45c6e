"""Curved backtest from running sums, skipped folds, and intervals from earlier errors."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.operators import backtest, boosters, forecast, intervals

D0 = dt.date(2022, 1, 3)


def table(spark, series):
    rows = [(sku, D0 + dt.timedelta(days=i), None if v is None else float(v)) for sku, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "sku_id string, date date, units double")


def shop(n_sku, days, seed=1, noise=3.0):
    rng = np.random.default_rng(seed)
    d = np.arange(days)
    return {
        f"SKU{k:03d}": 40 + k + 0.05 * d * (k % 3) + 10 * ((d + k) % 7 >= 5) + rng.normal(0, noise * (1 + k % 4), days)
        for k in range(n_sku)
    }


# ---- curved backtest --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("yearly", [False, True])
def test_prefix_fits_equal_single_fits(yearly):
    rng = np.random.default_rng(3)
    days = np.sort(rng.choice(1500, 1000, replace=False)).astype(float)
    days -= days[0]
    y = 50 + 0.02 * days + 9 * np.sin(days / 58) + rng.normal(0, 4, len(days))
    ends = [1000, 986, 500, 31, 30, 29, 0]
    fits = forecast.prefix_fits(days, y, ends, yearly)
    assert [f is None for f in fits] == [False] * 5 + [True] * 2
    shares = np.linspace(0, 0.8, forecast.BENDS + 1)[1:]
    for e, beta in zip(ends[:5], fits):
        span = max(days[e - 1], 1.0)
        x = forecast._design(days[:e], span, shares, yearly)
        shrink = np.full(x.shape[1], forecast.RIDGE)
        shrink[:2] = 1e-8
        want = np.linalg.solve(x.T @ x + np.diag(shrink), x.T @ y[:e])
        ahead = forecast._design(days[e - 1] + np.arange(1, 15), span, shares, yearly)
        assert ahead @ beta == pytest.approx(ahead @ want, rel=1e-6)


@pytest.mark.parametrize("yearly", [False, True])
def test_the_curved_backtest_equals_a_fit_per_fold(spark, yearly):
    values = shop(3, 400) | {"none": [0.0] * 400, "holes": [None if i % 9 == 0 else 5 + i % 7 for i in range(300)], "short": [1.0] * 50}
    folds = backtest.add_naive(backtest.fold_bounds(table(spark, values)))
    got = {(r.sku_id, r.fold, r.date): r.prophet for r in forecast.add_curved(folds, yearly=yearly).where("role = 'test'").collect()}
    single = forecast.curved(folds.where("role = 'train'"), 14, by=("sku_id", "fold"), yearly=yearly).collect()
    want = {(r.sku_id, r.fold, r.date): r.prophet for r in single}
    assert len(got) == 5 * 3 * 14 and len(want) == 4 * 3 * 14
    for key, value in got.items():
        assert (np.isnan(value) if value is not None else True) if key[0] == "none" else value == pytest.approx(want[key], rel=1e-6)
    assert forecast.add_curved(folds).columns == [*folds.columns, "prophet"]


def test_all_models_with_the_curved_trend(spark):
    series = table(spark, shop(2, 140))
    scored = boosters.backtest(series, horizon=7, n_folds=2, trees=3, rate=0.3, depth=3, trend="curved")
    folds = backtest.fold_bounds(boosters.training_table(series), 7, 2)
    want = {(r.sku_id, r.fold, r.date): r.prophet for r in forecast.curved(folds.where("role = 'train'"), 7, by=("sku_id", "fold")).collect()}
    rows = scored.collect()
    assert len(rows) == 2 * 2 * 7 and all(r.prophet == pytest.approx(want[r.sku_id, r.fold, r.date], rel=1e-6) for r in rows)
    assert all(r.ens == pytest.approx((r.prophet + r.xgboost + r.lightgbm) / 3) for r in rows)
    with pytest.raises(ValueError, match="additive"):
        boosters.backtest(series, trend="other")


# ---- skipped folds ----------------------------------------------------------------------------------------------------


def test_every_fold_is_placed_or_listed(spark):
    values = {f"n{n}": [1.0 + i % 3 for i in range(n)] for n in (1, 29, 43, 44, 55, 56, 70, 72, 89, 90, 100, 200)}
    series = table(spark, values)
    for horizon, n_folds in ((14, 3), (30, 3), (30, 2), (7, 5)):
        placed = {(r.sku_id, r.fold) for r in backtest.fold_bounds(series, horizon, n_folds).select("sku_id", "fold").distinct().collect()}
        left = backtest.skipped_folds(series, horizon, n_folds).collect()
        listed = {(r.sku_id, r.fold) for r in left}
        assert not placed & listed and len(listed) == len(left)
        assert placed | listed == {(k, f) for k in values for f in range(n_folds)}
        assert all((r.n_folds == 0) == (r.reason == "short series") for r in left)
    reasons = {(r.sku_id, r.fold): r.reason for r in backtest.skipped_folds(series, 14, 3).collect()}
    assert reasons["n55", 0] == "short series" and reasons["n56", 2] == "few training rows" and ("n56", 0) not in reasons
    assert {r.reason for r in backtest.skipped_folds(series.where("sku_id = 'n100'"), 30, 3).collect()} == {"shorter series"}


def test_skipped_series_are_in_the_evaluation(spark):
    series = table(spark, shop(2, 200) | {"new": [3.0] * 20})
    folds = backtest.add_additive(backtest.add_naive(backtest.fold_bounds(series)))
    scores = backtest.evaluation_table(backtest.score(folds, {"prophet": "prophet", "naive": "naive"}))
    rows = {r.sku_id: r for r in backtest.with_skipped(scores, backtest.skipped_folds(series)).collect()}
    assert rows.keys() == {"SKU000", "SKU001", "new"} and rows["SKU000"].n_folds == 3 and rows["SKU000"].reason is None
    assert (rows["new"].n_folds, rows["new"].reason, rows["new"].mae_prophet, rows["new"].best_model) == (0, "short series", None, None)


# ---- intervals --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def shops(spark):
    return table(spark, shop(60, 300)).persist()


@pytest.mark.parametrize("width", [0.8, 0.95])
def test_held_out_coverage(spark, shops, width):
    cut = D0 + dt.timedelta(days=286)
    ahead = intervals.additive_with_intervals(shops.where(F.col("date") < cut), 14, width=width)
    rows = intervals.coverage(shops, ahead).collect()
    assert len(rows) == 14 and sum(r.n for r in rows) == 60 * 14
    assert abs(sum(r.covered * r.n for r in rows) / (60 * 14) - width) < 0.03


def test_bounds_are_ordered_and_never_narrow(spark, shops):
    by_sku = {}
    for r in intervals.additive_with_intervals(shops, 14).orderBy("sku_id", "date").collect():
        assert r.p_low <= r.prophet <= r.p_high
        by_sku.setdefault(r.sku_id, []).append(r.p_high - r.p_low)
    assert len(by_sku) == 60
    assert all(b >= a - 1e-9 for w in by_sku.values() for a, b in zip(w, w[1:]))
    plain = forecast.additive(shops, 14).collect()
    assert {(r.sku_id, r.date): r.prophet for r in plain} == pytest.approx(
        {(r.sku_id, r.date): r.prophet for r in intervals.additive_with_intervals(shops, 14).collect()}
    )


def test_drifting_errors_widen_the_interval(spark):
    """A random walk strays further with each day ahead; one sigma for all days would not see it."""
    rng = np.random.default_rng(9)
    walks = {f"W{k}": 500 + np.cumsum(rng.normal(0, 2, 250)) for k in range(40)}
    out = intervals.additive_with_intervals(table(spark, walks), 28, origins=4).where("sku_id = 'W0'").orderBy("date").collect()
    assert out[27].p_high - out[27].p_low > 1.3 * (out[0].p_high - out[0].p_low)


def test_pooled_quantiles_equal_numpy(spark, shops):
    scores = intervals.rolling_scores(shops, 14, 4).persist()
    by_step = {}
    for r in scores.collect():
        by_step.setdefault(r.step, []).append(r.score)
    rows = intervals.pooled_widths(scores, 0.9).orderBy("step").collect()
    assert [r.step for r in rows] == sorted(by_step) == list(range(1, 15))
    for r in rows:
        assert r.n == 240 and r.quantile == pytest.approx(np.quantile(by_step[r.step], 0.9))
    assert [r.factor for r in rows] == pytest.approx(pool_adjacent([r.quantile for r in rows], [1] * 14))


def pool_adjacent(values, weights):
    """Isotonic regression by pooling neighbours."""
    blocks = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            v, w, n = blocks.pop()
            b = blocks[-1]
            b[0], b[1], b[2] = (b[0] * b[1] + v * w) / (b[1] + w), b[1] + w, b[2] + n
    return [v for v, _, n in blocks for _ in range(n)]


def test_rising_equals_pooling_neighbours(spark):
    rng = np.random.default_rng(2)
    cases = [(rng.normal(0, 1, n).tolist(), rng.integers(1, 9, n).tolist()) for n in (1, 2, 3, 14, 30)] + [([3.0, 2.0, 1.0], [1, 1, 1]), ([], [])]
    df = spark.createDataFrame([(i, v, w) for i, (v, w) in enumerate(cases)], "i int, v array<double>, w array<int>")
    for r in df.select("i", intervals.rising(F.col("v"), F.col("w")).alias("f")).collect():
        assert r.f is None if not cases[r.i][0] else r.f == pytest.approx(pool_adjacent(*cases[r.i]))


def test_long_series_go_by_their_own_errors(spark):
    series = table(spark, shop(3, 500, seed=4) | {"wild": 100 + 80 * np.random.default_rng(8).standard_t(2, 500), "new": 5 + np.arange(60) % 4})
    scores = intervals.rolling_scores(series, 7, 30).persist()
    own = intervals.own_widths(scores, 0.9, least=20).collect()
    assert {r.sku_id for r in own} == {"SKU000", "SKU001", "SKU002", "wild"}
    for sku in ("SKU001", "wild"):
        mine = sorted((r for r in own if r.sku_id == sku), key=lambda r: r.step)
        for r in mine:
            found = sorted(x.score for x in scores.where((F.col("sku_id") == sku) & (F.col("step") == r.step)).collect())
            assert r.n == len(found) and r.quantile == found[min(int(np.ceil((len(found) + 1) * 0.9)), len(found)) - 1]
        assert [r.own for r in mine] == pytest.approx(pool_adjacent([r.quantile for r in mine], [r.n for r in mine]))
    out = intervals.additive_with_intervals(series, 7, width=0.9, origins=30, least=20).collect()
    assert len(out) == 35 and {r.sku_id for r in out} >= {"new", "wild"}


def test_without_earlier_errors_the_normal_law_holds(spark):
    series = table(spark, {"new": [5.0 + i % 4 for i in range(50)]})
    out = sorted(intervals.additive_with_intervals(series, 7).collect(), key=lambda r: r.date)
    plain = sorted(forecast.additive(series, 7).collect(), key=lambda r: r.date)
    assert [(r.p_low, r.p_high) for r in out] == [pytest.approx((r.p_low, r.p_high)) for r in plain]
    assert intervals.additive_with_intervals(table(spark, {"x": [1.0] * 10}), 7).count() == 0
    flat = intervals.additive_with_intervals(table(spark, {"flat": [5.0] * 200}), 7, non_negative=True).collect()
    assert len(flat) == 7 and all(r.p_low == pytest.approx(5) and r.p_high == pytest.approx(5) for r in flat)


def test_all_models_beside_the_widening_intervals(spark, shops):
    series = shops.where("sku_id < 'SKU003'")
    own = intervals.additive_with_intervals(series, 7)
    out = {(r.sku_id, r.date): r for r in forecast.forecast_all(series, {}, 7, own=own).collect()}
    want = {(r.sku_id, r.date): r for r in own.collect()}
    assert out.keys() == want.keys()
    assert all((r.prophet, r.p_low, r.p_high) == pytest.approx((want[k].prophet, want[k].p_low, want[k].p_high)) for k, r in out.items())
