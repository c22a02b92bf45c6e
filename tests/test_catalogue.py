"""Model catalogue: concurrent publishing, half-written versions, parameters as a table."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import forecast
from shelfspark.sources import catalogue

D0 = dt.date(2023, 1, 1)


def publish(spark, folder, kind, version, value, **facts):
    write = lambda path: spark.range(value, value + 1).write.parquet(path)
    return catalogue.publish(spark, folder, kind, version, write, {"trained_on_rows": value, "metrics": "{}", **facts})


def test_eight_threads_publish_at_once_and_nothing_is_lost(spark, tmp_path):
    folder = str(tmp_path)
    for turn in range(3):
        jobs = [(f"kind{i % 2}", f"{turn}.{i}") for i in range(8)]
        with ThreadPoolExecutor(8) as pool:
            paths = list(pool.map(lambda j: publish(spark, folder, *j, value=int(j[1][-1])), jobs))
        for (kind, version), path in zip(jobs, paths):
            assert catalogue.published(spark, folder, kind, version) == path
            assert spark.read.parquet(path).first().id == int(version[-1])
    rows = catalogue.registry(spark, folder)
    assert rows.count() == rows.select("model_type", "version").distinct().count() == 24


def test_of_eight_writers_of_one_version_the_first_counts(spark, tmp_path):
    folder = str(tmp_path)
    with ThreadPoolExecutor(8) as pool:
        paths = list(pool.map(lambda i: publish(spark, folder, "xgb", "a/b c", i), range(8)))
    assert len(set(paths)) == 1
    row = catalogue.registry(spark, folder).collect()
    assert len(row) == 1 and row[0].version == "a/b c" and row[0].file_path == paths[0]
    assert spark.read.parquet(paths[0]).first().id == row[0].trained_on_rows
    # the attempts of the others are gone, but for the row's own that moved
    assert [d for d in os.listdir(tmp_path / "attempts")] == [os.path.basename(os.path.dirname(paths[0]))]


def test_threads_that_ask_for_one_version_fit_it_once(spark, tmp_path):
    fits = []

    def get(_):
        return catalogue.load_or_fit(
            spark, str(tmp_path), "table", "1", fit=lambda: fits.append(1) or spark.range(3),
            write=lambda df, path: df.write.parquet(path), read=spark.read.parquet, facts=lambda df: ({"trained_on_rows": 3}, None),
        ).count()

    with ThreadPoolExecutor(6) as pool:
        assert set(pool.map(get, range(6))) == {3}
    assert len(fits) == 1


def test_a_half_written_version_is_never_loaded(spark, tmp_path):
    folder = str(tmp_path)

    def dies(path):
        spark.range(1).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        catalogue.publish(spark, folder, "xgb", "1", dies, {})
    assert catalogue.published(spark, folder, "xgb", "1") is None
    assert catalogue.registry(spark, folder).count() == 0
    # a writer that died between its model and the rename
    os.makedirs(tmp_path / "attempts" / "xgb-1-x" / "row")
    (tmp_path / "attempts" / "xgb-1-x" / "row" / "part-0.json").write_text('{"model_type":"xgb","version":"1","file_path":"nowhere"}')
    assert catalogue.published(spark, folder, "xgb", "1") is None and catalogue.registry(spark, folder).count() == 0
    path = publish(spark, folder, "xgb", "1", 7)
    assert catalogue.published(spark, folder, "xgb", "1") == path and spark.read.parquet(path).first().id == 7


def test_the_current_version_is_the_newest_active_one(spark, tmp_path):
    at = lambda day: F.lit(dt.datetime(2024, 1, day))
    for version, day, active in (("1", 1, True), ("2", 3, True), ("3", 5, False), ("10", 3, True)):
        publish(spark, str(tmp_path), "xgb", version, 1, created_at=at(day), is_active=active)
    publish(spark, str(tmp_path), "lgbm", "1", 1, created_at=at(1))
    rows = catalogue.current(catalogue.registry(spark, str(tmp_path))).collect()
    assert {(r.model_type, r.version) for r in rows} == {("xgb", "2"), ("lgbm", "1")}


def test_parameters_are_stored_as_a_table(spark, tmp_path):
    rows = [(f"SKU{k}", D0 + dt.timedelta(days=d), float(10 + k + d % 7)) for k in range(3) for d in range(60)]
    series = spark.createDataFrame(rows, "sku_id string, date date, units double")
    table = forecast.stored_parameters(series, str(tmp_path), "1")
    # a later series of the same version is not fitted again
    again = forecast.stored_parameters(series.where("sku_id = 'SKU0'"), str(tmp_path), "1")
    assert sorted(map(str, table.collect())) == sorted(map(str, again.collect())) and table.count() == 3
    key = lambda r: (r.sku_id, r.date)
    stored = sorted(forecast.additive_predict(again).collect(), key=key)
    fresh = sorted(forecast.additive(series).collect(), key=key)
    assert [r.prophet for r in stored] == pytest.approx([r.prophet for r in fresh])
    row = catalogue.registry(spark, str(tmp_path)).first()
    assert (row.model_type, row.trained_on_rows) == ("prophet", 180) and '"series":3' in row.metrics
