"""What the plans must look like, whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import backtest, clean, features, quality
from shelfspark.plans.catalog import ORACLES, QUERIES
from shelfspark.plans.standins import RUN_IDS


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


@pytest.fixture
def facts(spark, tmp_path):
    """A stored table; broadcasts are off, so that shuffles show as they would at scale."""
    spark.range(200).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("date"),
        F.concat(F.lit("SKU"), F.col("id") % 4).alias("sku_id"), F.lit("S01").alias("store_id"),
        F.col("id").cast("double").alias("units"), F.lit(1.0).alias("price"), F.lit(0).alias("promo_flag"),
        F.lit("x" * 10).alias("comment"),
    ).write.parquet(str(tmp_path / "facts"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.read.parquet(str(tmp_path / "facts"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_fill_lags_and_means_share_one_shuffle(facts):
    filled = clean.cap_iqr(clean.fill_date_gaps(facts.drop("comment"), "2024-01-01", "2024-03-01"))
    assert shuffles(plan(features.build_features(filled))) == 1


def test_cleaning_shuffles_on_the_key_and_then_on_the_series(facts):
    text = plan(clean.clean_sales(facts.drop("comment"), order=["units"], start="2024-01-01", end="2024-03-01"))
    assert shuffles(text) == 2
    # only the first row per key leaves a task
    assert text.count("WindowGroupLimit") == 2


def test_backtest_uses_one_shuffle(facts):
    daily = facts.select("sku_id", "date", "units")
    folds = backtest.add_additive(backtest.add_naive(backtest.fold_bounds(daily)))
    assert shuffles(plan(backtest.evaluation_table(backtest.score(folds, {"prophet": "prophet", "naive": "naive"})))) == 1


def test_no_cartesian_products_and_no_python_in_the_core(facts):
    for df in (
        clean.clean_sales(facts, order=["units"]),
        features.build_features(facts),
        quality.quality_report(facts, as_of="2024-06-01"),
        quality.outliers_z(facts, "units"),
        clean.fill_date_gaps(facts),
    ):
        text = plan(df)
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "InPandas", "PythonUDF", "Python"):
            assert word not in text


def test_filters_and_columns_reach_the_scan(facts):
    text = plan(facts.where(F.col("sku_id") == "SKU1").groupBy("store_id").agg(F.sum("units")))
    assert "EqualTo(sku_id,SKU1)" in text and "comment" not in text


def test_every_sql_twin_has_its_query():
    assert set(ORACLES) <= set(QUERIES) and len(RUN_IDS) == 3
