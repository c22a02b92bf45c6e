"""Exact law of the KS statistic, and drift checks against a stored profile."""

from itertools import combinations
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.operators import drift


def statistic(a, b):
    points = np.unique(np.concatenate([a, b]))
    return np.abs(np.searchsorted(np.sort(a), points, "right") / len(a) - np.searchsorted(np.sort(b), points, "right") / len(b)).max()


@pytest.mark.parametrize("m, n", [(1, 1), (2, 3), (3, 3), (5, 4), (7, 5), (6, 6), (10, 1), (8, 8)])
def test_exact_law_equals_all_orders(m, n):
    distances = []
    for where in combinations(range(m + n), m):
        a = np.zeros(m + n, bool)
        a[list(where)] = True
        distances.append(np.abs(np.cumsum(a) / m - np.cumsum(~a) / n).max())
    distances = np.array(distances)
    assert len(distances) == comb(m + n, m)
    for d in np.unique(np.round(distances, 12)):
        want = (distances >= d - 1e-9).mean()
        assert drift.exact_p(float(d), m, n) == pytest.approx(want, abs=1e-12)
        assert drift.exact_p(float(d), n, m) == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("n, critical", [(5, 5), (10, 7), (20, 9), (30, 11)])
def test_published_critical_values(n, critical):
    """The tables' smallest n D of equal samples that is significant at 5 %; and the closed form, an alternating sum."""

    def closed(c):
        return 2 * sum((-1) ** (i + 1) * comb(2 * n, n - i * c) for i in range(1, n // c + 1)) / comb(2 * n, n)

    assert drift.exact_p(critical / n, n, n) <= 0.05 < drift.exact_p((critical - 1) / n, n, n)
    for c in range(1, n + 1):
        assert drift.exact_p(c / n, n, n) == pytest.approx(min(1.0, closed(c)), abs=1e-9)


@pytest.mark.parametrize("n", [100, 1000, 10_000])
def test_large_samples_equal_the_reflected_walk(n):
    for x in (0.8, 1.36, 2.2):
        c = round(x * np.sqrt(n / 2) * n / n)
        want, term = 0.0, 1.0
        for i in range(1, n // c + 1):
            # comb(2n, n - ic) / comb(2n, n) without large numbers
            k = np.arange(1, i * c + 1)
            term = np.exp(np.sum(np.log(n - i * c + k) - np.log(n + k)))
            want += 2 * (-1) ** (i + 1) * term
        assert drift.exact_p(c / n, n, n) == pytest.approx(want, abs=1e-9)


def test_report_names_the_law(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 60), rng.normal(0.4, 1, 45)
    ref, cur = (spark.createDataFrame([(float(x), float(i % 3)) for i, x in enumerate(v)], "v double, w double") for v in (a, b))
    small = {r.column_name: r for r in drift.ks_drift(ref, cur).collect()}
    assert small["v"].p_method == "exact" and small["v"].ks_pvalue == pytest.approx(drift.exact_p(statistic(a, b), 60, 45), abs=1e-12)
    large = {r.column_name: r for r in drift.ks_drift(ref, cur, exact_rows=59).collect()}
    assert large["v"].p_method == "asymptotic" and abs(large["v"].ks_pvalue - small["v"].ks_pvalue) < 0.05
    assert small["w"].has_drift is False


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(5)
    n = 6000

    def frame(shift, k):
        return spark.createDataFrame([
            (float(x), float(y), float(z), None if i % 50 == 0 else float(u), int(t), 1.0)
            for i, (x, y, z, u, t) in enumerate(zip(
                rng.normal(shift, 1, k), rng.integers(0, 3, k), rng.exponential(1 + shift, k), rng.normal(0, 1, k), rng.integers(0, 2000, k)))
        ], "same double, few double, tail double, still double, wide int, one double")

    return frame(0.0, n).persist(), frame(0.0, 2000).persist(), frame(0.08, 2500).persist()


@pytest.mark.parametrize("share", [0.0005, 0.01, 0.2])
def test_flags_equal_those_of_the_counted_form(spark, tables, tmp_path, share):
    ref, same, moved = tables
    path = str(tmp_path / "p")
    drift.fit_profile(ref, path, share=share)
    knots = {r.column_name: r["count"] for r in spark.read.parquet(f"{path}/knots").groupBy("column_name").count().collect()}
    assert all(k <= 1 / share + 2 for k in knots.values()) and knots["one"] == 1 and knots["few"] <= 3
    for cur in (same, moved, ref):
        want = {r.column_name: r for r in drift.ks_drift(ref, cur).collect()}
        got = {r.column_name: r for r in drift.detect_drift(cur, path, reference=lambda: ref).collect()}
        alone = {r.column_name: r for r in drift.detect_drift(cur, path).collect()}
        assert got.keys() == want.keys() == alone.keys()
        for name, r in got.items():
            w = want[name]
            assert r.has_drift == w.has_drift
            assert (r.n_ref, r.n_cur) == (w.n_ref, w.n_cur)
            assert r.mean_change_pct == pytest.approx(w.mean_change_pct, abs=1e-9) and r.std_change_pct == pytest.approx(w.std_change_pct, abs=1e-9)
            assert alone[name].ks_low <= w.ks_statistic + 1e-12 and w.ks_statistic <= alone[name].ks_high + 1e-12
            assert alone[name].ks_high - alone[name].ks_low < share
            # without the reference a column is flagged rightly or left open
            assert alone[name].has_drift in (None, w.has_drift) and (alone[name].has_drift is None) == (r.settled == "counts")


def test_a_check_does_not_read_the_reference(spark, tables, tmp_path):
    ref, same, _ = tables
    ref.write.parquet(str(tmp_path / "reference"))
    same.write.parquet(str(tmp_path / "current"))
    drift.fit_profile(spark.read.parquet(str(tmp_path / "reference")), str(tmp_path / "p"))
    bounds = drift.ks_bounds(spark.read.parquet(str(tmp_path / "current")), str(tmp_path / "p"))
    files = {f.rsplit("/", 2)[-2] for f in bounds.inputFiles()}
    assert "reference" not in files
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "/reference" not in plan


def test_values_outside_the_reference_and_empty_columns(spark, tmp_path):
    ref = spark.createDataFrame([(float(i), None) for i in range(100)], "v double, e double")
    drift.fit_profile(ref, str(tmp_path / "p"), share=0.1)
    for values, d in (([1000.0] * 50, 1.0), ([-5.0] * 50, 1.0), ([49.0] * 3, 0.5)):
        cur = spark.createDataFrame([(x, 1.0) for x in values], "v double, e double")
        rows = drift.detect_drift(cur, str(tmp_path / "p"), reference=lambda: ref).collect()
        assert [r.column_name for r in rows] == ["v"]
        assert rows[0].ks_low <= d + 1e-12 <= rows[0].ks_high + 2e-12
        assert rows[0].has_drift == drift.ks_drift(ref, cur, ["v"]).first().has_drift
    assert drift.detect_drift(ref.limit(0), str(tmp_path / "p")).count() == 0
