"""Queries of sketches per day, cursor pages and the bucketed layout."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from shelfspark.operators import features, pages, sketches, summary
from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import REQUESTS_SQL, SALES_SQL, requests, sales, table
from shelfspark.session import run_folder
from shelfspark.sources import sinks

FIRST, LAST = dt.date(1995, 3, 1), dt.date(1996, 8, 31)


@query(
    "kpi_panel_sketch",
    "WITH " + SALES_SQL + f', r AS (SELECT * FROM sales WHERE date BETWEEN DATE \'{FIRST}\' AND DATE \'{LAST}\') '
    'SELECT store_id, count(*) AS "rows", count(DISTINCT sku_id) AS sku_id, CAST(max(date) - min(date) AS INTEGER) AS days, '
    "round(avg(units), 4) AS mean_units FROM r GROUP BY 1",
)
def kpi_panel_sketch(spark, sf):
    """A panel per store over a range of days from sketches alone; so few SKUs are counted exactly."""
    path = run_folder(spark, "sketches")
    sketches.write_sketches(sketches.day_sketches(sales(spark, sf), ["store_id"], ["sku_id"], ["units"]), path)
    found = sketches.panel(sketches.read_sketches(spark, path, FIRST, LAST), ["store_id"])
    return rounded(found.select("store_id", "rows", "sku_id", "days", "mean_units"))


@query("distinct_sketch", "SELECT l_returnflag, count(*) AS rows, true AS within FROM lineitem GROUP BY 1")
def distinct_sketch(spark, sf):
    """Distinct orders per return flag, merged over all days, within the stated error of the exact number."""
    lines = table(spark, sf, "lineitem").withColumn("date", F.col("l_shipdate").cast("date"))
    merged = sketches.panel(sketches.day_sketches(lines, ["l_returnflag"], ["l_orderkey"]), ["l_returnflag"])
    exact = lines.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("exact"))
    within = F.abs(F.col("l_orderkey") - F.col("exact")) <= 3 * sketches.distinct_error() * F.col("exact")
    return merged.join(exact, "l_returnflag").select("l_returnflag", "rows", within.alias("within"))


@query(
    "latency_sketch",
    "WITH " + REQUESTS_SQL + ' SELECT endpoint, count(*) AS "rows", round(avg(duration), 4) AS mean_duration, true AS within FROM requests GROUP BY 1',
)
def latency_sketch(spark, sf):
    """Latency quantiles per endpoint merged over days; their true ranks are within the stated error."""
    log = requests(spark, sf).withColumn("date", F.col("ts").cast("date"))
    probabilities = (0.5, 0.95, 0.99)
    merged = sketches.panel(sketches.day_sketches(log, ["endpoint"], [], ["duration"]), ["endpoint"], probabilities)
    # one row per endpoint
    ranked = log.select("endpoint", "duration").join(merged, "endpoint")
    shares = []
    for p in probabilities:
        q = F.col(f"duration_p{round(p * 100)}")
        below, upto = F.avg((F.col("duration") < q).cast("double")), F.avg((F.col("duration") <= q).cast("double"))
        # equal values share ranks: the wanted one lies in or near their stretch
        shares.append((below <= p + sketches.rank_error()) & (upto >= p - sketches.rank_error()))
    checked = ranked.groupBy("endpoint").agg(
        F.max("rows").alias("rows"), F.max("mean_duration").alias("mean_duration"), (shares[0] & shares[1] & shares[2]).alias("within")
    )
    return rounded(checked)


ORDER = [("o_orderdate", False), ("o_orderkey", True)]


@query(
    "page_after",
    "SELECT o_orderkey, o_orderdate::DATE AS o_orderdate, o_totalprice, (SELECT count(*) FROM orders) AS total FROM orders "
    "ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 100",
)
def page_after(spark, sf):
    """The third page of fifty orders, newest first, reached by cursors."""
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    cursor = None
    for _ in range(2):
        _, cursor = pages.next_page(orders, ORDER, cursor, 50)
    third = pages.page_after(orders, ORDER, cursor, 50)
    return third.select("o_orderkey", "o_orderdate", "o_totalprice", pages.total(orders).scalar().alias("total"))


@query(
    "features_by_bucket",
    "WITH " + SALES_SQL + f" SELECT sku_id, sum(units) AS total, round(avg(units), 4) AS mean, min(units) AS min, max(units) AS max, "
    f"CAST(max(date) - min(date) AS INTEGER) AS days FROM sales WHERE date BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY 1",
)
def features_by_bucket(spark, sf):
    """Features stored by month and bucket; the summary per SKU of a range of days reads its months and shuffles nothing."""
    name = f"features_{uuid.uuid4().hex}"
    sinks.save_features(features.build_features(sales(spark, sf)), name, run_folder(spark, "bucketed"), buckets=4)
    return rounded(summary.sku_summary(sinks.read_features(spark, name, FIRST, LAST)))
