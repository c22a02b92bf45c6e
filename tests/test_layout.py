"""Sketches per day, cursor pages, bucketed features, files without a byte."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.operators import features, pages, segment, sketches, summary
from shelfspark.sources import files, sinks

D0 = dt.date(2024, 1, 20)


@pytest.fixture(scope="module")
def facts(spark):
    rng = np.random.default_rng(3)
    n = 30_000
    rows = zip(rng.integers(0, 30, n).tolist(), rng.integers(0, 9000, n).tolist(), rng.integers(0, 3, n).tolist(), rng.exponential(5, n).tolist())
    data = [(D0 + dt.timedelta(days=d), f"K{k}", f"S{s}", None if k % 97 == 0 else v) for d, k, s, v in rows]
    return spark.createDataFrame(data, "date date, k string, store string, v double").persist()


# ---- sketches ---------------------------------------------------------------------------------------------------------


def test_merging_does_not_depend_on_the_split(spark, facts):
    """Sketches of days, of twenty parts by value, and of the whole merged once: the same panel within the error."""
    panels = []
    for split in (F.col("date"), F.date_add(F.lit(D0), F.pmod(F.hash("k", "v"), F.lit(20))), F.when(F.col("k") == "K1", F.lit(D0)).otherwise(F.date_add(F.lit(D0), 1))):
        rows = sketches.panel(sketches.day_sketches(facts.withColumn("date", split), ["store"], ["k"], ["v"]), ["store"])
        panels.append(sorted((r.store, r.rows, r.n_v, round(r.sum_v, 6), r.k) for r in rows.collect()))
    for other in panels[1:]:
        assert [r[:4] for r in other] == [r[:4] for r in panels[0]]
        assert [r[4] for r in other] == pytest.approx([r[4] for r in panels[0]], rel=3 * sketches.distinct_error())


def test_estimates_are_within_the_stated_errors(spark, facts):
    probabilities = (0.05, 0.5, 0.95, 0.99)
    for r in sketches.panel(sketches.day_sketches(facts, ["store"], ["k"], ["v"]), ["store"], probabilities).collect():
        mine = facts.where(F.col("store") == r.store)
        exact = mine.agg(F.count_distinct("k").alias("k"), F.count("*").alias("n")).first()
        assert r.rows == exact.n and abs(r.k - exact.k) <= 3 * sketches.distinct_error() * exact.k
        values = np.sort([x.v for x in mine.where("v is not null").collect()])
        assert r.n_v == len(values) and r.mean_v == pytest.approx(values.mean())
        for p in probabilities:
            rank = np.searchsorted(values, r[f"v_p{round(p * 100)}"]) / len(values)
            assert abs(rank - p) <= sketches.rank_error()


def test_a_restated_day_replaces_its_row(spark, facts, tmp_path):
    path = str(tmp_path / "s")
    cut = D0 + dt.timedelta(days=15)
    build = lambda df: sketches.day_sketches(df, ["store"], ["k"], ["v"])
    sketches.write_sketches(build(facts.where(F.col("date") < cut)), path)
    sketches.write_sketches(build(facts.where(F.col("date") >= cut)), path)
    full = sketches.panel(sketches.read_sketches(spark, path)).first()
    assert full.rows == 30_000 and full.days == 29
    # a day comes again with one store only: its other stores are gone, all other days stay
    day = cut - dt.timedelta(days=3)
    again = facts.where((F.col("date") == day) & (F.col("store") == "S1"))
    for _ in range(2):
        sketches.write_sketches(build(again), path)
    left = 30_000 - facts.where(F.col("date") == day).count() + again.count()
    assert sketches.panel(sketches.read_sketches(spark, path)).first().rows == left
    one = sketches.read_sketches(spark, path, day, day)
    assert [r.store for r in one.collect()] == ["S1"]
    plan = sketches.read_sketches(spark, path, dt.date(2024, 2, 1), dt.date(2024, 2, 3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_empty_and_null_values(spark, facts):
    none = sketches.panel(sketches.day_sketches(facts.limit(0), ["store"], ["k"], ["v"]), ["store"])
    assert none.count() == 0
    nulls = facts.limit(5).withColumns({"v": F.lit(None).cast("double"), "k": F.lit(None).cast("string")})
    r = sketches.panel(sketches.day_sketches(nulls, [], ["k"], ["v"])).first()
    assert (r.rows, r.k, r.n_v, r.v_p50, r.mean_v) == (5, 0, 0, None, None)


# ---- pages ------------------------------------------------------------------------------------------------------------


def walk(df, order, limit):
    seen, cursor, n = [], None, 0
    while True:
        rows, cursor = pages.next_page(df, order, cursor, limit)
        seen += rows
        n += 1
        if cursor is None:
            return seen, n


@pytest.mark.parametrize("order", [[("day", True), ("id", True)], [("day", False), ("id", True)], [("name", True), ("day", False), ("id", False)]])
def test_walking_all_pages_gives_every_row_once_in_order(spark, order):
    rng = random.Random(1)
    data = [(i, None if rng.random() < 0.2 else D0 + dt.timedelta(days=rng.randrange(9)), rng.choice([None, "", "a", 'b"\\', "é"])) for i in range(137)]
    df = spark.createDataFrame(data, "id long, day date, name string").repartition(3)
    by = [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in order]
    want = [r.id for r in df.orderBy(*by).collect()]
    for limit in (10, 137, 200):
        rows, n = walk(df, order, limit)
        assert [r.id for r in rows] == want and n == max(1, -(-137 // limit))
    assert walk(df.limit(0), order, 10) == ([], 1)


def test_all_pages_of_the_orders(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderdate", "o_totalprice")
    rows, _ = walk(orders, [("o_orderdate", False), ("o_orderkey", True)], 211)
    assert len(rows) == orders.count() == len({r.o_orderkey for r in rows})


def test_the_plan_of_a_deep_page(spark, tmp_path):
    spark.range(5000).selectExpr("id", "id div 7 AS day").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    order = [("day", True), ("id", True)]
    _, cursor = pages.next_page(df, order, None, 1000)
    plan = pages.page_after(df, order, cursor, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Offset" not in plan and "GreaterThanOrEqual(day,142)" in plan and "TakeOrderedAndProject" in plan
    total = pages.total(df)
    assert total.first().total == 5000 and "ReadSchema: struct<>" in total._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="another list"):
        pages.page_after(df, [("id", True)], cursor)


# ---- layout -----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    rows = [(D0 + dt.timedelta(days=d), f"SKU{k:03d}", f"S{s}", "c", float(k + d % 7), 1.0, 0) for d in range(90) for k in range(12) for s in range(2)]
    sales = spark.createDataFrame(rows, "date date, sku_id string, store_id string, category string, units double, price double, promo_flag int")
    table = features.build_features(sales).persist()
    spark.sql("DROP TABLE IF EXISTS layout_features")
    sinks.save_features(table, "layout_features", str(tmp_path_factory.mktemp("f") / "rows"), 4)
    yield table
    spark.sql("DROP TABLE IF EXISTS layout_features")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_features_are_the_features(spark, bucketed):
    key = lambda df: sorted(map(str, df.select(*sorted(bucketed.columns)).collect()))
    assert key(sinks.read_features(spark, "layout_features")) == key(bucketed)


def test_work_per_sku_needs_no_exchange(spark, bucketed):
    stored = sinks.read_features(spark, "layout_features")
    assert "Exchange" not in plan_of(summary.sku_summary(stored)).split("Initial Plan")[-1]
    assert "Exchange" in plan_of(summary.sku_summary(bucketed)).split("Initial Plan")[-1]
    assert "Exchange" not in plan_of(segment.sku_variability(stored)).split("Initial Plan")[-1]
    got = {r.sku_id: r.total for r in summary.sku_summary(stored).collect()}
    assert got == {r.sku_id: r.total for r in summary.sku_summary(bucketed).collect()}


def test_a_range_of_days_reads_its_months(spark, bucketed):
    part = sinks.read_features(spark, "layout_features", dt.date(2024, 2, 10), dt.date(2024, 2, 20))
    assert part.count() == 11 * 24
    months = {f.split("sales_month=")[1][:7] for f in part.inputFiles()}
    assert months <= {"2024-01", "2024-02", "2024-03", "2024-04"}
    assert "PartitionFilters: [isnotnull(sales_month" in plan_of(part)
    assert part.agg(F.min("date"), F.max("date")).first() == (dt.date(2024, 2, 10), dt.date(2024, 2, 20))


def test_bucket_count():
    assert sinks.bucket_count(0) == 1 and sinks.bucket_count(10 * 2**40, 60) == 1366
    assert sinks.bucket_count(2**30, 1, 2**28) == 4


def test_files_without_a_byte_are_listed(spark, tmp_path):
    (tmp_path / "none.csv").write_bytes(b"")
    (tmp_path / "some.csv").write_text("a,b\n1,2\n")
    (tmp_path / "_SUCCESS").write_bytes(b"")
    rows = {r.name: r for r in files.dataset_catalogue(spark, str(tmp_path)).collect()}
    assert rows.keys() == {"none.csv", "some.csv"}
    assert (rows["none.csv"].size_bytes, rows["none.csv"].rows, rows["none.csv"].error) == (0, None, "is empty")
    assert rows["none.csv"].modified is not None and rows["some.csv"].rows == 1 and rows["some.csv"].error is None
