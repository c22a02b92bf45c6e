"""The fit of boosted trees: as the library's own, in few jobs, in one task or over parts."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfspark.operators import boosters, trees
from shelfspark.session import shared_folder

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def cells(spark):
    """Weighted rows of three features with 20 bins, the third of which says nothing."""
    rng = np.random.default_rng(7)
    bins, noise, weights = rng.integers(0, 20, (900, 3)), rng.normal(0, 3, 900), rng.integers(1, 4, 900)
    rows = [(*map(float, b), float(2 * b[0] + 15 * (b[1] > 11) * (b[0] < 9) + e), float(w)) for b, e, w in zip(bins, noise, weights)]
    return spark.createDataFrame(rows, "a double, b double, c double, units double, _weight double").repartition(3).persist()


def booster(**options):
    given = {"maxIter": 8, "stepSize": 0.2, "maxDepth": 4, "seed": 1, "maxBins": 64, "checkpointInterval": 3, **options}
    return GBTRegressor(featuresCol="features", labelCol="units", predictionCol="forecast", weightCol="_weight", **given)


@pytest.mark.parametrize("parts", [1, 3])
def test_trees_are_those_of_the_library(spark, cells, parts):
    shared_folder(spark)
    data = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(cells)
    own, theirs = trees.fit(cells, booster(), COLUMNS, parts), booster().fit(data)
    assert (own.getNumTrees, own.getMaxIter(), own.getStepSize(), own.getMaxDepth(), own.getSeed()) == (8, 8, 0.2, 4, 1)
    assert own.treeWeights == theirs.treeWeights and own.totalNumNodes == theirs.totalNumNodes
    score = lambda m: [r.forecast for r in m.transform(data).orderBy(*data.columns[:5]).collect()]
    assert score(own) == pytest.approx(score(theirs), abs=1e-8)
    assert own.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-2)


def test_a_small_table_is_fitted_in_few_jobs(spark):
    """A job for each level of each tree would be 120 of them, whose latency is the time of the fit."""
    rows = [(i % 7, i % 50, float(3 * (i % 7) + i % 50 + i % 3)) for i in range(400)]
    table = spark.createDataFrame(rows, "dow int, week int, units double")
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "one booster")
    try:
        model = boosters.fit(table, ["dow", "week"], trees=40, rate=0.1, depth=3)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert model.stages[-1].getNumTrees == 40 and boosters.r_squared(model, table) > 0.9
    assert 0 < len(context.statusTracker().getJobIdsForGroup("few-jobs")) < 60


def test_equal_labels_and_no_rows(spark, cells):
    flat = trees.fit(cells.withColumn("units", F.lit(5.0)), booster(), COLUMNS, 1)
    assert flat.totalNumNodes == 8
    with pytest.raises(ValueError):
        boosters.fit(cells.limit(0).select("a", "units"), ["a"], trees=2)
    with pytest.raises(Exception, match="finite"):
        trees.fit(cells.withColumn("units", F.lit(float("nan"))), booster(), COLUMNS, 1)
