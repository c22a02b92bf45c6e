"""Running totals, exact quantiles and top rows against brute force, with hot groups and ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.operators.ordered import exact_quantiles, running_total, top_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """300 rows, a third of them in one group, many ties, some missing values."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        group = "hot" if i % 3 == 0 else f"g{i % 7}"
        value = None if i % 29 == 0 else float(rng.integers(0, 12))
        rows.append((group, i, value))
    return spark.createDataFrame(rows, "g string, id int, v double"), rows


@pytest.fixture(autouse=True)
def several_slices(spark):
    """Keeps the slices apart although the data is small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_total_of_whole_table(spark, skewed):
    df, rows = skewed
    out = running_total(df.fillna(0.0), [F.col("v").desc(), F.col("id")], ["v"]).collect()
    assert len({r.id for r in out}) == 300
    expected, total = {}, 0.0
    for g, i, v in sorted(((g, i, v or 0.0) for g, i, v in rows), key=lambda r: (-r[2], r[1])):
        total += v
        expected[i] = total
    assert {r.id: r.running_v for r in out} == expected
    assert {r.total_v for r in out} == {total}


def test_running_total_within_groups(spark, skewed):
    df, rows = skewed
    with_null_key = df.withColumn("g", F.when(F.col("g") != "g1", F.col("g"))).fillna(0.0, ["v"])
    out = running_total(with_null_key, ["id"], ["v"], by=["g"]).collect()
    expected, sums = {}, {}
    for g, i, v in rows:
        key = None if g == "g1" else g
        sums[key] = sums.get(key, 0.0) + (v or 0.0)
        expected[i] = sums[key]
    assert {r.id: r.running_v for r in out} == expected
    assert all(r.total_v == sums[r.g] for r in out)


@pytest.mark.parametrize("accuracy", [20_000, 4, 20])
def test_exact_quantiles_match_numpy(spark, skewed, accuracy):
    df, rows = skewed
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    out = exact_quantiles(df, ["v", "id"], probabilities, by=["g"], accuracy=accuracy).collect()
    assert len(out) == 2 * len({g for g, _, _ in rows})
    for r in out:
        at = 2 if r.column_name == "v" else 1
        values = [x[at] for x in rows if x[0] == r.g and x[at] is not None]
        assert r.n == len(values)
        assert np.allclose(r.quantiles, np.quantile(values, probabilities))


@pytest.mark.parametrize("accuracy", [50, 500])
def test_brackets_hold_the_ranks_of_a_long_column(spark, accuracy):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=6000), np.full(3000, 0.25), rng.integers(0, 9, 3000)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.5, 0.75, 0.99, 1.0]
    out = exact_quantiles(df, ["v"], probabilities, accuracy=accuracy).first()
    assert out.n == 12_000 and np.allclose(out.quantiles, np.quantile(values, probabilities))
    plan = exact_quantiles(df, ["v"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "ExistingRDD[_" not in plan


def test_exact_quantiles_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(1.5, None), (1.5, None)], "a double, b double")
    out = {r.column_name: r for r in exact_quantiles(df, ["a", "b"], [0.25, 0.75]).collect()}
    assert list(out) == ["a"] and out["a"].quantiles == [1.5, 1.5]


@pytest.mark.parametrize("salts", [1, 5])
def test_top_rows(skewed, salts):
    df, rows = skewed
    out = top_rows(df, ["g"], [F.col("id").desc()], 4, salts=salts).collect()
    for group in {g for g, _, _ in rows}:
        wanted = sorted((i for g, i, _ in rows if g == group), reverse=True)[:4]
        assert [r.id for r in sorted((r for r in out if r.g == group), key=lambda r: r.rn)] == wanted
