"""Metrics, folds, forecasts, boosters: hand-made cases, brute force and properties."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark import schema
from shelfspark.functions import metrics
from shelfspark.operators import backtest, boosters, ensemble, forecast, summary

D0 = dt.date(2023, 1, 1)


def series_of(spark, values, sku="SKU001"):
    rows = [(sku, D0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "sku_id string, date date, units double")


@pytest.fixture(scope="module")
def seasonal(spark):
    """Two SKUs: a weekly wave on a trend, and the same shifted."""
    out = None
    for k in range(2):
        one = series_of(spark, [50 + 0.05 * d + 20 * ((d + k) % 7 in (5, 6)) + (d * 13 % 5) for d in range(140)], f"SKU{k:03d}")
        out = one if out is None else out.unionByName(one)
    return out.persist()


@pytest.mark.parametrize("pairs, expected", [
    ([(10, 12), (20, 18)], (2.0, 2.0, 15.0, (2 / 11 + 2 / 19) / 2 * 100)),
    ([(0, 5), (10, 5)], (5.0, 5.0, 50.0, (2 + 5 / 7.5) / 2 * 100)),
    ([(0, 0)], (0.0, 0.0, None, 0.0)),
    ([(None, 1), (float("inf"), 1), (4, float("nan")), (4, 3)], (1.0, 1.0, 25.0, 100 / 3.5)),
    ([(None, 1)], (None, None, None, None)),
])
def test_metrics(spark, pairs, expected):
    df = spark.createDataFrame([(None if y is None else float(y), float(p)) for y, p in pairs], "y double, p double")
    got = df.agg(*[fn("y", "p").alias(n) for n, fn in metrics.METRIC_FUNCTIONS.items()]).first()
    for value, wanted in zip(got, expected):
        assert value == (None if wanted is None else pytest.approx(wanted))


def folds_of(spark, n, horizon=14, folds=3):
    out = backtest.fold_bounds(series_of(spark, range(n)), horizon, folds).collect()
    parts = {}
    for r in out:
        parts.setdefault((r.fold, r.role), []).append(r.units)
    return {k: (min(v), max(v), len(v)) for k, v in parts.items()}, {r.n_folds for r in out}


def test_folds(spark):
    parts, n_folds = folds_of(spark, 100)
    assert n_folds == {3}
    assert parts[0, "test"] == (86, 99, 14) and parts[0, "train"] == (0, 85, 86)
    assert parts[2, "test"] == (58, 71, 14) and parts[2, "train"] == (0, 57, 58)


def test_short_series_get_fewer_folds_or_none(spark):
    assert folds_of(spark, 55)[0] == {}
    # 56 rows would be enough for three folds, but the third has only 14 rows to train on
    assert set(folds_of(spark, 56)[0]) == {(0, "train"), (0, "test")}
    assert folds_of(spark, 100, horizon=30)[1] == {2}
    assert folds_of(spark, 89, horizon=30)[0] == {}


def test_naive_uses_the_last_training_value(spark):
    out = backtest.add_naive(backtest.fold_bounds(series_of(spark, range(100)))).where("role = 'test'")
    assert {(r.fold, r.naive) for r in out.select("fold", "naive").distinct().collect()} == {(0, 85.0), (1, 71.0), (2, 57.0)}


def test_additive_recovers_trend_and_week(spark, seasonal):
    folds = backtest.add_additive(backtest.add_naive(backtest.fold_bounds(seasonal)))
    table = backtest.evaluation_table(backtest.score(folds, {"prophet": "prophet", "naive": "naive"})).collect()
    assert all(r.best_model in ("prophet",) and r.mape_prophet < 6 < r.mape_naive for r in table)
    assert all(r.mape_xgboost is None and r.mae_ens == r.mae_prophet for r in table)


def best(spark, **mape):
    row = {f"mape_{m}": mape.get(m) for m in schema.MODELS}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} double" for c in row))
    return df.select(backtest.best_model().alias("b")).first().b


def test_best_model(spark):
    assert best(spark, prophet=5.0, naive=4.0) == "naive"
    assert best(spark, xgboost=4.0, ens=4.0, prophet=9.0) == "xgboost"
    assert best(spark) == "prophet"
    # an unknown score counts as 999, so a worse known one loses against it
    assert best(spark, naive=1200.0) == "prophet"


def test_ensemble_skips_missing_models(spark):
    df = spark.createDataFrame([(10.0, 12.0), (None, 18.0), (30.0, None), (None, None)], "prophet double, xgb double")
    assert [r.ensemble for r in ensemble.ensemble(df).collect()] == [11.0, 18.0, 30.0, None]


def test_additive_forecast(spark, seasonal):
    out = forecast.additive(seasonal, 14).orderBy("sku_id", "date").collect()
    assert len(out) == 28 and out[0].date == D0 + dt.timedelta(days=140)
    assert all(r.p_low < r.prophet < r.p_high for r in out)
    y = np.array([r.units for r in seasonal.where("sku_id = 'SKU000'").orderBy("date").collect()])
    t = np.arange(140)
    slope, level = np.polyfit(t, y, 1)
    rest = y - level - slope * t
    week = {d: rest[[(D0 + dt.timedelta(days=int(i))).weekday() == d for i in t]].mean() for d in range(7)}
    ahead = [D0 + dt.timedelta(days=140 + i) for i in range(14)]
    assert [r.prophet for r in out[:14]] == pytest.approx([level + slope * (140 + i) + week[d.weekday()] for i, d in enumerate(ahead)])


def test_no_model_for_short_or_unsold_series(spark):
    assert forecast.additive(series_of(spark, [1.0] * 29)).count() == 0
    assert forecast.additive(series_of(spark, [0.0] * 60)).count() == 0
    assert forecast.curved(series_of(spark, [0.0] * 60)).count() == 0


def test_curved_forecast_beats_the_naive_one(spark, seasonal):
    train = seasonal.where(F.col("date") < D0 + dt.timedelta(days=126))
    curve, naive = forecast.curved(train, 14), forecast.naive(train, 14)
    both = seasonal.join(curve, ["sku_id", "date"]).join(naive, ["sku_id", "date"])
    row = both.agg(F.count("*").alias("n"), metrics.mae("units", "prophet").alias("c"), metrics.mae("units", "naive").alias("v")).first()
    assert row.n == 28 and row.c < row.v


@pytest.fixture(scope="module")
def fitted(seasonal):
    table = boosters.training_table(seasonal)
    return table, boosters.fit(table, boosters.FULL_FEATURES, trees=10, rate=0.3, depth=3)


def test_booster_properties(fitted):
    table, model = fitted
    weights = boosters.importances(model, boosters.FULL_FEATURES)
    assert min(weights.values()) >= 0 and sum(weights.values()) == pytest.approx(1.0)
    assert boosters.r_squared(model, table) > 0.8


def test_rows_with_equal_bins_are_one_weighted_row(spark, seasonal, monkeypatch):
    """The training data of a booster is bounded by its bins: a table three times as long has no row more to fit on."""
    table = boosters.training_table(seasonal)
    taken, keep = [], boosters.kept
    monkeypatch.setattr(boosters, "kept", lambda df, purpose: taken.append(keep(df, purpose)) or taken[-1])
    options = {"trees": 6, "rate": 0.3, "depth": 4}
    one = boosters.fit(table, boosters.SMALL_FEATURES, **options)
    three = boosters.fit(table.unionByName(table).unionByName(table), boosters.SMALL_FEATURES, **options)
    cells = [t.agg(F.count("*"), F.sum("_weight"), F.sum(F.col("_weight") * F.col("units"))).first() for t in taken]
    total = table.agg(F.sum("units")).first()[0]
    assert cells[0][0] == cells[1][0] <= 280 and [c[1] for c in cells] == [280, 840]
    assert [c[2] for c in cells] == pytest.approx([total, 3 * total])
    both = one.transform(table).select("sku_id", "date", F.col("forecast").alias("a")).join(three.transform(table), ["sku_id", "date"])
    assert both.where("abs(a - forecast) > 1e-6").count() == 0


def test_recursive_score_feeds_forecasts_back(spark, fitted):
    table, model = fitted
    state = boosters.trailing_state(table)
    out = boosters.recursive_score(model, state, 9, "lgbm").orderBy("sku_id", "date").collect()
    assert [r.date for r in out[:9]] == [D0 + dt.timedelta(days=140 + i) for i in range(9)]
    past = [r.units for r in table.where("sku_id = 'SKU000'").orderBy("date").collect()]
    for step in range(9):
        day = D0 + dt.timedelta(days=140 + step)
        features = (day.weekday(), day.isocalendar().week, day.month, past[-1], past[-7], past[-14],
                    float(np.mean(past[-7:])), float(np.mean(past[-28:])))
        one = spark.createDataFrame([tuple(map(float, features))], ", ".join(f"{c} double" for c in boosters.FULL_FEATURES))
        value = model.transform(one).first().forecast
        assert out[step].lgbm == pytest.approx(value)
        past.append(value)


def test_short_history_counts_missing_lags_as_zero(spark, fitted):
    _, model = fitted
    state = boosters.trailing_state(series_of(spark, [5.0, 6.0]))
    assert boosters.recursive_score(model, state, 3, "xgb").count() == 3


def test_model_store(spark, fitted, tmp_path):
    table, model = fitted
    row = boosters.save_model(model, str(tmp_path), "lgbm", "1", table, 1.5, "{}").first()
    assert row.trained_on_rows == 280 and '"trees":10' in row.hyperparameters
    again = boosters.load_or_fit(str(tmp_path), "lgbm", "1", table, boosters.FULL_FEATURES)
    assert again.stages[-1].getNumTrees == model.stages[-1].getNumTrees


def test_all_models_side_by_side(spark, seasonal):
    scored = boosters.backtest(seasonal, horizon=7, n_folds=2, trees=5, rate=0.3, depth=3)
    rows = scored.collect()
    assert len(rows) == 2 * 2 * 7
    assert all(r.ens == pytest.approx((r.prophet + r.xgboost + r.lightgbm) / 3) for r in rows)
    full = forecast.forecast_all(seasonal, boosters.forecast(seasonal, 7, trees=5, rate=0.3, depth=3), 7).collect()
    assert len(full) == 14 and all(r.ensemble == pytest.approx((r.prophet + r.xgb + r.lgbm) / 3) for r in full)
    assert forecast.forecast_all(seasonal, {}, 7).where("xgb is null and ensemble = prophet").count() == 14


def test_box_and_means(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, 1.0), ("c", 3.0, 1.0), ("d", 100.0, None)],
                               "sku_id string, mape_naive double, mae_ens double")
    box = {(r.metric, r.model): r for r in summary.box_stats(df).collect()}
    row = box["mape", "naive"]
    assert (row.n, row.median, row.whisker_low, row.whisker_high, row.outliers) == (4, 2.5, 1.0, 3.0, 1)
    assert box["mae", "ens"].n == 3
    assert {r.model: r.mape for r in summary.model_means(df).collect()} == {"naive": 26.5, "ens": None}


def test_models_are_kept_with_their_registry_row(spark, seasonal, tmp_path):
    table = boosters.training_table(seasonal)
    options = {"trees": 4, "rate": 0.3, "depth": 3}
    first = boosters.models_of(table, str(tmp_path), "7", **options)
    again = boosters.models_of(table, str(tmp_path), "7", **options)
    score = lambda m: sorted((r.sku_id, r.date, r.forecast) for r in m["xgb"].transform(table).collect())
    assert score(first) == score(again)
    rows = boosters.registry(spark, str(tmp_path)).collect()
    assert sorted((r.model_type, r.version, r.trained_on_rows) for r in rows) == [("lgbm", "7", table.count()), ("xgb", "7", table.count())]
    assert all(0 < json.loads(r.metrics)["r2"] <= 1 and json.loads(r.hyperparameters)["trees"] == 4 for r in rows)


def test_curved_recovers_a_yearly_wave(spark):
    days = [dt.date(2021, 1, 1) + dt.timedelta(days=d) for d in range(3 * 365)]
    wave = lambda d: 100 + 40 * np.sin(2 * np.pi * (d - days[0]).days / 365.25)
    df = spark.createDataFrame([("SKU001", d, float(wave(d))) for d in days], "sku_id string, date date, units double")
    with_it = forecast.curved(df, 60, yearly=True).collect()
    without = forecast.curved(df, 60).collect()
    error = lambda rows: max(abs(r.prophet - wave(r.date)) for r in rows)
    assert error(with_it) < 8 < error(without)
    assert all(r.p_low <= r.prophet <= r.p_high for r in with_it)
    out = forecast.forecast_all(df, {}, 60, trend="curved", yearly=True).collect()
    assert len(out) == 60 and all(r.xgb is None for r in out)
