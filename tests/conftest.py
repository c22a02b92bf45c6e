import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session("4", memory="6g", spark__checkpoint__dir=folder, spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sales(spark):
    """Builds a sales table out of (date, sku, store, units) rows."""

    def build(rows, columns="date string, sku_id string, store_id string, units double"):
        df = spark.createDataFrame(rows, columns)
        return df.withColumn("date", df.date.cast("date")) if "date" in df.columns else df

    return build
