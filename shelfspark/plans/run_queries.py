"""Queries over runs, predictions, the dimension, summaries, audit log and telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import schema
from shelfspark.functions import scalars
from shelfspark.operators import audit, columns, lookups, runs as run_ops, summary, telemetry
from shelfspark.operators.quality import duplicate_counts
from shelfspark.plans.forecast_queries import EVALUATION_SQL, evaluation
from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import (
    AUDIT_SQL, DIM_SQL, PREDICTIONS_SQL, RAW_SQL, REQUESTS_SQL, RUNS_SQL, SALES_SQL, SKU_SQL, audit_log, predictions,
    requests, runs, sales, sales_raw, sales_sku, sku_dim, table,
)
from shelfspark.session import kept, run_folder
from shelfspark.sources import files, store

# ---- summaries ----------------------------------------------------------------------------------------------------


@query(
    "kpi_panel",
    "WITH " + SALES_SQL + ' SELECT count(*) AS "rows", count(DISTINCT sku_id) AS skus, count(DISTINCT store_id) AS stores, '
    "CAST(max(date) - min(date) AS INTEGER) AS days, round(avg(units), 4) AS mean_units FROM sales",
)
def kpi_panel(spark, sf):
    return rounded(summary.kpi_panel(sales(spark, sf)))


@query(
    "sku_summary",
    "WITH " + SALES_SQL + " SELECT sku_id, sum(units) AS total, round(avg(units), 4) AS mean, min(units) AS min, "
    "max(units) AS max, CAST(max(date) - min(date) AS INTEGER) AS days FROM sales GROUP BY 1",
)
def sku_summary(spark, sf):
    return rounded(summary.sku_summary(sales(spark, sf)))


@query(
    "describe",
    "WITH " + SALES_SQL + " SELECT sku_id, 'units' AS column_name, count(units) AS count, round(avg(units), 4) AS mean, "
    "round(stddev_samp(units), 4) AS std, min(units) AS min, max(units) AS max, round(quantile_cont(units, 0.25), 4) AS q25, "
    "round(quantile_cont(units, 0.5), 4) AS median, round(quantile_cont(units, 0.75), 4) AS q75 FROM sales GROUP BY 1",
)
def describe(spark, sf):
    return rounded(summary.column_stats(sales(spark, sf), ["units"], by=["sku_id"]))


@query(
    "histogram",
    "WITH " + SALES_SQL + ", b AS (SELECT min(units) AS lo, max(units) AS hi FROM sales) "
    "SELECT bin, count(*) AS n, round(any_value(lo) + (bin - 1) * any_value(hi - lo) / 30, 4) AS low, "
    "round(any_value(lo) + bin * any_value(hi - lo) / 30, 4) AS high FROM (SELECT lo, hi, "
    "CAST(least(floor((units - lo) / (hi - lo) * 30) + 1, 30) AS INTEGER) AS bin FROM sales, b) GROUP BY bin",
)
def histogram(spark, sf):
    return rounded(summary.histogram(sales(spark, sf), "units"))


@query(
    "weekday_profile",
    "WITH " + SALES_SQL + " SELECT CAST(isodow(date) - 1 AS INTEGER) AS dow, round(avg(units), 6) AS mean_units FROM sales GROUP BY 1",
)
def weekday_profile(spark, sf):
    return rounded(summary.weekday_profile(sales(spark, sf)), 6)


@query(
    "month_profile",
    "WITH " + SALES_SQL + " SELECT CAST(month(date) AS INTEGER) AS month, round(avg(units), 6) AS mean_units FROM sales GROUP BY 1",
)
def month_profile(spark, sf):
    return rounded(summary.month_profile(sales(spark, sf)), 6)


@query(
    "last_n",
    "WITH " + SALES_SQL + " SELECT date, sku_id, store_id, units FROM sales "
    "QUALIFY row_number() OVER (PARTITION BY sku_id, store_id ORDER BY date DESC) <= 60",
)
def last_n(spark, sf):
    return summary.last_n(sales(spark, sf).select("date", "sku_id", "store_id", "units"), 60)


@query(
    "sales_vs_forecast",
    "WITH " + PREDICTIONS_SQL + " SELECT * FROM (SELECT date, 'actual' AS kind, units AS value FROM sales "
    "WHERE sku_id = 'SKU004' AND store_id = 'S03' ORDER BY date DESC LIMIT 90) UNION ALL "
    "SELECT date, 'forecast', round(ensemble, 4) FROM pred WHERE run_id = 3 AND sku_id = 'SKU004'",
)
def sales_vs_forecast(spark, sf):
    newest = predictions(spark, sf).where(F.col("run_id") == 3)
    return rounded(summary.sales_vs_forecast(sales(spark, sf), newest, "SKU004", "S03"))


@query(
    "known_skus",
    "WITH " + PREDICTIONS_SQL + ", " + DIM_SQL.strip() + " SELECT sku_id FROM pred UNION SELECT sku_id FROM sales UNION SELECT sku_id FROM dim ORDER BY 1",
)
def known_skus(spark, sf):
    return summary.known_skus(sales(spark, sf), predictions(spark, sf), sku_dim(spark, sf))


@query(
    "concat_results",
    "WITH " + PREDICTIONS_SQL + " SELECT sku_id, date, round(prophet, 4) AS prophet, NULL::DOUBLE AS xgb FROM pred WHERE run_id = 1 "
    "UNION ALL SELECT sku_id, date, NULL, round(xgb, 4) FROM pred WHERE run_id <> 1",
)
def concat_results(spark, sf):
    rows = predictions(spark, sf)
    return rounded(summary.concat_results(
        rows.where(F.col("run_id") == 1).select("sku_id", "date", "prophet"),
        rows.where(F.col("run_id") != 1).select("sku_id", "date", "xgb"),
    ))


@query(
    "table_counts",
    "WITH " + PREDICTIONS_SQL + ", " + DIM_SQL.strip() + " SELECT 'skus' AS table_name, count(*) AS n FROM dim "
    "UNION ALL SELECT 'predictions', count(*) FROM pred UNION ALL SELECT 'forecast_runs', count(*) FROM orders "
    "UNION ALL SELECT 'metrics', count(*) FROM labels UNION ALL SELECT 'sales_records', count(*) FROM sales",
)
def table_counts(spark, sf):
    return summary.table_counts({
        "skus": sku_dim(spark, sf), "predictions": predictions(spark, sf), "forecast_runs": runs(spark, sf),
        "metrics": table(spark, sf, "labels"), "sales_records": sales(spark, sf),
    })


@query("active_sku_count", "WITH " + DIM_SQL + " SELECT count(*) FILTER (is_active) AS active_skus FROM dim")
def active_sku_count(spark, sf):
    return summary.active_sku_count(sku_dim(spark, sf))


# ---- scalar helpers -----------------------------------------------------------------------------------------------


@query(
    "safe_divide",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN -1.0::DOUBLE ELSE round(l_tax / l_discount, 4) END AS ratio FROM lineitem",
)
def safe_divide(spark, sf):
    ratio = scalars.safe_divide("l_tax", "l_discount", -1.0)
    return rounded(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", ratio.alias("ratio")))


@query(
    "format_number",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) "
    "|| '.' || lpad(CAST(CAST(round((o_totalprice - floor(o_totalprice)) * 100) AS INTEGER) AS VARCHAR), 2, '0') END AS shown FROM orders",
)
def format_number(spark, sf):
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, sf, "orders").select("o_orderkey", scalars.format_number(value).alias("shown"))


@query(
    "round_metrics",
    "SELECT p_partkey, p_name, round_even(p_retailprice / 7, 2) AS price, round_even(p_size / 8.0::DOUBLE, 2) AS size FROM part",
)
def round_metrics(spark, sf):
    part = table(spark, sf, "part")
    return scalars.round_metrics(
        part.select("p_partkey", "p_name", (F.col("p_retailprice") / 7).alias("price"), (F.col("p_size") / 8.0).alias("size"))
    )


@query("json_details", "SELECT event_id, CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT) AS k, "
       "'{\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}' AS details FROM events")
def json_details(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", scalars.json_field("props", "k", "bigint").alias("k"),
        scalars.to_json_text("event_type", "user_id").alias("details"),
    )


@query(
    "metric_key",
    "WITH " + REQUESTS_SQL + """ SELECT 'http_requests{endpoint="' || endpoint || '",method="' || method || '",status="' || status || '"}' AS key,
    count(*) AS n FROM requests GROUP BY 1""",
)
def metric_key(spark, sf):
    return requests(spark, sf).groupBy(telemetry.request_key().alias("key")).agg(F.count("*").alias("n"))


@query("day_span", "SELECT o_orderstatus, CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS INTEGER) AS days FROM orders GROUP BY 1")
def day_span(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(scalars.day_span("o_orderdate").alias("days"))


# ---- runs ---------------------------------------------------------------------------------------------------------


@query(
    "run_states",
    "SELECT user_id AS run_id, max_by(event_type, event_id) AS status, max(ts) AS at FROM events GROUP BY 1",
)
def run_states(spark, sf):
    """Events as run records: a run's state is its newest record."""
    records = table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("status"),
        F.col("ts").cast("timestamp").alias("at"), "event_id",
    )
    return run_ops.run_state(records, ["event_id"]).select("run_id", "status", "at")


@query(
    "run_log",
    "WITH " + RUNS_SQL + " SELECT run_id, 14 AS horizon, 'ensemble' AS model_type, status, started_at, completed_at, "
    "CASE WHEN status = 'failed' THEN 'stopped after ' || run_id % 1440 || ' minutes' END AS error_message, "
    "CASE WHEN status = 'completed' THEN run_id * 2 END AS records_count FROM runs",
)
def run_log(spark, sf):
    """Every order as a run whose start and end are appended to a log, one of them twice; the states are read back."""
    log, rows = run_folder(spark, "run-log"), runs(spark, sf)
    store.start_runs(rows.select("run_id", F.lit(14).alias("horizon"), F.lit("ensemble").alias("model_type"), F.col("started_at").alias("at")), log)
    done = rows.where("status = 'completed'").select("run_id", (F.col("run_id") * 2).alias("records_count"), F.col("completed_at").alias("at"))
    store.complete_runs(done, log)
    store.complete_runs(done, log)
    message = F.concat(F.lit("stopped after "), F.col("run_id") % 1440, F.lit(" minutes"))
    store.fail_runs(rows.where("status = 'failed'").select("run_id", message.alias("error_message"), F.col("completed_at").alias("at")), log)
    return run_ops.run_log(files.read_artifact(spark, log, schema.RUN_RECORD))


@query(
    "latest_run",
    "WITH " + RUNS_SQL + " SELECT run_id, status, completed_at FROM runs WHERE status = 'completed' ORDER BY completed_at DESC, run_id DESC LIMIT 1",
)
def latest_run(spark, sf):
    return run_ops.latest_run(runs(spark, sf)).select("run_id", "status", "completed_at")


@query(
    "page",
    "WITH " + RUNS_SQL + " SELECT run_id, status, started_at, (SELECT count(*) FROM runs) AS total FROM runs "
    "ORDER BY started_at DESC, run_id DESC LIMIT 25 OFFSET 50",
)
def page(spark, sf):
    """One page of runs with the total count alongside."""
    all_runs = runs(spark, sf)
    total = all_runs.agg(F.count("*")).scalar()
    one = columns.page(all_runs, [F.col("started_at").desc(), F.col("run_id").desc()], 50, 25)
    return one.select("run_id", "status", "started_at", total.alias("total"))


# the stand-in runs 1..3 end one day apart, the newest last
RUN3_SQL = PREDICTIONS_SQL + ", done AS (SELECT run_id, DATE '2002-01-01' + CAST(run_id AS INTEGER) AS completed_at FROM (SELECT DISTINCT run_id FROM pred))"


def three_runs(spark, sf):
    ids = predictions(spark, sf).select("run_id").distinct()
    return ids.select(
        "run_id", F.lit("completed").alias("status"),
        F.date_add(F.lit("2002-01-01").cast("date"), F.col("run_id").cast("int")).cast("timestamp").alias("completed_at"),
    )


@query(
    "latest_predictions",
    "WITH " + RUN3_SQL + " SELECT run_id, sku_id, date, round(ensemble, 4) AS ensemble FROM pred "
    "WHERE run_id = (SELECT run_id FROM done ORDER BY completed_at DESC LIMIT 1) "
    "QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY date) <= 7",
)
def latest_predictions(spark, sf):
    out = run_ops.run_predictions(predictions(spark, sf), three_runs(spark, sf), horizon=7)
    return rounded(out.select("run_id", "sku_id", "date", "ensemble"))


@query(
    "first_horizon",
    "WITH " + PREDICTIONS_SQL + " SELECT sku_id, date, round(xgb, 4) AS xgb FROM pred WHERE run_id = 2 "
    "QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY date) <= 5",
)
def first_horizon(spark, sf):
    rows = run_ops.run_predictions(predictions(spark, sf), run_id=2)
    return rounded(summary.first_horizon(rows, 5).select("sku_id", "date", "xgb"))


@query(
    "export_forecast",
    "WITH " + PREDICTIONS_SQL + " SELECT round(avg(prophet), 4) AS prophet, round(avg(xgb), 4) AS xgb, round(avg(lgbm), 4) AS lgbm, "
    "round(avg(ensemble), 4) AS ensemble, count(*) AS n FROM (SELECT * FROM pred WHERE run_id = 3 AND sku_id = 'SKU008' ORDER BY date LIMIT 10)",
)
def export_forecast(spark, sf):
    """What a forecast export writes for one SKU, as the means it reports."""
    rows = run_ops.run_predictions(predictions(spark, sf), run_id=3, sku="sku_8", horizon=10)
    return rounded(rows.agg(
        *[F.avg(c).alias(c) for c in ("prophet", "xgb", "lgbm", "ensemble")], F.count("*").alias("n")
    ))


@query(
    "batch_forecast",
    "WITH " + PREDICTIONS_SQL + " SELECT sku_id, date, round(ensemble, 4) AS ensemble FROM pred WHERE run_id = 3 "
    "AND sku_id IN ('SKU001', 'SKU002', 'SKU012') QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY date) <= 9",
)
def batch_forecast(spark, sf):
    newest = run_ops.run_predictions(predictions(spark, sf), run_id=3)
    out = run_ops.batch_forecast(newest, ["sku_1", "SKU-002", " 12 ", "SKU999"], 9)
    return rounded(out.select("sku_id", "date", "ensemble"))


@query("batch_not_found", "WITH " + PREDICTIONS_SQL + " SELECT s AS sku_id FROM (VALUES ('SKU001'), ('SKU777'), ('SKU999')) t(s) "
       "WHERE s NOT IN (SELECT sku_id FROM pred)")
def batch_not_found(spark, sf):
    return run_ops.batch_not_found(predictions(spark, sf), ["SKU001", "sku-777", "SKU999"])


@query(
    "join_dim",
    "WITH " + PREDICTIONS_SQL + ", " + DIM_SQL.strip() + " SELECT run_id, sku_id, date, category, store_id FROM pred JOIN dim USING (sku_id) "
    "WHERE is_active AND run_id = 3",
)
def join_dim(spark, sf):
    rows = run_ops.run_predictions(predictions(spark, sf), run_id=3)
    return run_ops.join_dim(rows, sku_dim(spark, sf), active_only=True).select(
        "run_id", "sku_id", "date", "category", "store_id"
    )


@query(
    "upsert_dim",
    "WITH " + DIM_SQL + ", inc AS (SELECT DISTINCT 'SKU' || CASE WHEN p_size < 10 THEN '00' || p_size ELSE '0' || p_size END AS sku_id FROM part) "
    "SELECT sku_id, category, is_active FROM dim UNION ALL SELECT sku_id, NULL, true FROM inc WHERE sku_id NOT IN (SELECT sku_id FROM dim)",
)
def upsert_dim(spark, sf):
    """Part sizes as incoming SKU numbers: those without a brand are new."""
    incoming = table(spark, sf, "part").select(F.concat(F.lit("sku_"), "p_size").alias("sku_id"))
    return run_ops.upsert_dim(sku_dim(spark, sf), incoming).select("sku_id", "category", "is_active")


@query(
    "fill_actuals",
    "WITH " + PREDICTIONS_SQL + " SELECT run_id, p.sku_id, p.date, round(ensemble, 4) AS ensemble, units AS actual FROM pred p "
    "LEFT JOIN sku s ON s.sku_id = p.sku_id AND s.date = p.date",
)
def fill_actuals(spark, sf):
    out = run_ops.fill_actuals(predictions(spark, sf), sales_raw(spark, sf))
    return rounded(out.select("run_id", "sku_id", "date", "ensemble", "actual"))


@query(
    "realised_error",
    "WITH " + PREDICTIONS_SQL + ", j AS (SELECT run_id, ensemble AS p, units FROM pred p LEFT JOIN sku s ON s.sku_id = p.sku_id AND s.date = p.date) "
    "SELECT run_id, count(units) AS known, round(avg(abs(units - p)), 4) AS mae, round(sqrt(avg((units - p) ** 2)), 4) AS rmse, "
    "round(avg(abs((units - p) / units)) FILTER (units > 0) * 100, 4) AS mape, "
    "round(avg(abs(units - p) / ((abs(units) + abs(p)) / 2)) * 100, 4) AS smape FROM j GROUP BY 1",
)
def realised_error(spark, sf):
    return rounded(run_ops.realised_error(run_ops.fill_actuals(predictions(spark, sf), sales_raw(spark, sf))))


@query(
    "load_sales",
    "WITH " + RAW_SQL + ", " + DIM_SQL.strip() + ", h AS (SELECT sku_id, date, sum(units) AS units, round(sum(units * price), 2) AS revenue, "
    "round(avg(price) + 1e-7, 3) AS price, max(promo_flag) AS promo_flag, DATE '2002-01-01'::TIMESTAMP AS created_at FROM raw GROUP BY 1, 2) "
    "SELECT h.*, (SELECT count(*) FROM (SELECT sku_id FROM dim WHERE is_active UNION SELECT sku_id FROM h)) AS skus FROM h",
)
def load_sales(spark, sf):
    """History loaded in two parts, the second part twice, into a table that already knows some SKUs; read back with all columns."""
    path, dim = run_folder(spark, "history"), run_folder(spark, "skus")
    sku_dim(spark, sf).where("is_active").write.parquet(dim)
    raw, at = sales_raw(spark, sf), F.lit("2002-01-01").cast("timestamp")
    early = F.col("date") < "1996-01-15"
    for part in (raw.where(early), raw.where(~early), raw.where(~early)):
        store.load_sales(part, path, dim, at)
    rows = files.read_artifact(spark, path, schema.SALES_HISTORY).drop("month")
    skus = spark.read.parquet(dim).agg(F.count("sku_id")).scalar()
    return rows.withColumns({"revenue": F.round("revenue", 2), "price": F.round(F.col("price") + 1e-7, 3), "skus": skus})


@query(
    "load_metrics",
    EVALUATION_SQL + "SELECT CAST(7 AS BIGINT) AS run_id, sku_id, mape_prophet, CAST(NULL AS DOUBLE) AS mape_xgboost, mape_ens AS mape_ensemble, mape_naive, best_model, "
    "DATE '2002-01-01'::TIMESTAMP AS created_at FROM evaluation",
)
def load_metrics(spark, sf):
    path, dim = run_folder(spark, "metrics"), run_folder(spark, "skus")
    sku_dim(spark, sf).where("is_active").write.parquet(dim)
    rows = kept(evaluation(spark, sf), "evaluation")
    for _ in range(2):
        store.load_metrics(rows, 7, path, dim, F.lit("2002-01-01").cast("timestamp"))
    return files.read_artifact(spark, path, schema.METRIC)


@query(
    "load_predictions",
    "WITH " + PREDICTIONS_SQL + " SELECT run_id + 6 AS run_id, sku_id, date, round(prophet, 4) AS prophet, round(xgb, 4) AS xgb, round(lgbm, 4) AS lgbm, round(ensemble, 4) AS ensemble, "
    "round(p_low, 4) AS p_low, round(p_high, 4) AS p_high, CAST(NULL AS DOUBLE) AS actual, DATE '2002-01-01'::TIMESTAMP AS created_at FROM pred",
)
def load_predictions(spark, sf):
    """Each stand-in run loaded under a new id, the last one twice. The forecasts are made once, for all loads."""
    path, dim, rows = run_folder(spark, "predictions"), run_folder(spark, "skus"), kept(predictions(spark, sf), "forecasts")
    sku_dim(spark, sf).where("is_active").write.parquet(dim)
    for run in (1, 2, 3, 3):
        store.load_predictions(rows.where(F.col("run_id") == run), run + 6, path, dim, F.lit("2002-01-01").cast("timestamp"))
    return rounded(files.read_artifact(spark, path, schema.PREDICTION))


RETENTION_SQL = """
WITH """ + RUNS_SQL.strip() + """,
r AS (SELECT count(*) FILTER (status <> 'running' AND started_at < TIMESTAMP '1996-06-01' - INTERVAL 90 DAY) AS d, count(*) AS n FROM runs),
j AS (SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-20' - INTERVAL 30 DAY) AS d, count(*) AS n FROM events)
SELECT 'runs' AS table_name, d AS deleted, n - d AS kept, n - d AS rows_left FROM r UNION ALL SELECT 'jobs', d, n - d, n - d FROM j
"""


@query("retention", RETENTION_SQL)
def retention(spark, sf):
    """Runs (90 days, ended ones only) and log records as jobs (30 days): written by month, expired, counted again."""
    out = []
    ended = F.col("status") != "running"
    jobs = audit_log(spark, sf).select("id", "created_at")
    for name, rows, column, as_of, days, which in (
        ("runs", runs(spark, sf), "started_at", "1996-06-01", run_ops.KEEP_DAYS, ended),
        ("jobs", jobs, "created_at", "2024-01-20", run_ops.KEEP_JOB_DAYS, F.lit(True)),
    ):
        path = run_folder(spark, f"retention-{name}")
        rows.withColumn("month", F.date_format(column, "yyyy-MM")).hint("rebalance", "month").write.partitionBy("month").parquet(path)
        gone = store.expire(spark, path, "month", run_ops.expired(column, F.lit(as_of), days) & which)
        left = spark.read.parquet(path).agg(F.count("*").alias("rows_left"))
        out.append(left.select(F.lit(name).alias("table_name"), F.lit(gone[0]).cast("long").alias("deleted"), F.lit(gone[1]).cast("long").alias("kept"), "rows_left"))
    return out[0].unionByName(out[1])


@query(
    "retention_counts",
    "SELECT 'runs' AS table_name, count(*) FILTER (o_orderdate < TIMESTAMP '2000-06-01' - INTERVAL 90 DAY) AS deleted, "
    "count(*) FILTER (NOT o_orderdate < TIMESTAMP '2000-06-01' - INTERVAL 90 DAY) AS kept FROM orders UNION ALL SELECT 'audit', "
    "count(*) FILTER (ts < TIMESTAMP '2024-04-20' - INTERVAL 90 DAY), count(*) FILTER (NOT ts < TIMESTAMP '2024-04-20' - INTERVAL 90 DAY) FROM events",
)
def retention_counts(spark, sf):
    old_runs = run_ops.expired_counts({"runs": (runs(spark, sf), "started_at")}, F.lit("2000-06-01"))
    old_log = run_ops.expired_counts({"audit": (audit_log(spark, sf), "created_at")}, F.lit("2024-04-20"))
    return old_runs.unionByName(old_log)


@query(
    "retained",
    "WITH " + RUNS_SQL + " SELECT run_id, status FROM runs WHERE started_at >= TIMESTAMP '2000-06-01' - INTERVAL 90 DAY",
)
def retained(spark, sf):
    return run_ops.retained(runs(spark, sf), "started_at", F.lit("2000-06-01")).select("run_id", "status")


@query(
    "cascade_delete",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')",
)
def cascade_delete(spark, sf):
    gone = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return run_ops.cascade_delete(lines, gone, "l_orderkey")


@query(
    "unique_keys",
    "WITH " + RAW_SQL + " SELECT count(*) - count(DISTINCT (date, sku_id)) AS repeats FROM raw",
)
def unique_keys(spark, sf):
    counted = duplicate_counts(sales_raw(spark, sf).select("date", "sku_id"), ["date", "sku_id"])
    return counted.select(F.col("key_duplicates").alias("repeats"))


# ---- documented lookups -------------------------------------------------------------------------------------------


@query("lookup_active_skus", "WITH " + DIM_SQL + " SELECT sku_id, category, store_id FROM dim WHERE is_active AND category = 'ECONOMY'")
def lookup_active_skus(spark, sf):
    return lookups.active_skus(sku_dim(spark, sf), category="ECONOMY").select("sku_id", "category", "store_id")


@query(
    "lookup_predictions_from",
    "WITH " + PREDICTIONS_SQL + " SELECT run_id, sku_id, date FROM pred WHERE date >= DATE '2001-11-10'",
)
def lookup_predictions_from(spark, sf):
    return lookups.predictions_from(predictions(spark, sf), "2001-11-10").select("run_id", "sku_id", "date")


@query("lookup_running_runs", "WITH " + RUNS_SQL + " SELECT run_id, started_at FROM runs WHERE status = 'running'")
def lookup_running_runs(spark, sf):
    return lookups.runs_with_status(runs(spark, sf), "running").select("run_id", "started_at")


@query(
    "lookup_recent_runs",
    "WITH " + RUNS_SQL + " SELECT run_id, started_at FROM runs WHERE status = 'completed' ORDER BY started_at DESC, run_id DESC LIMIT 10",
)
def lookup_recent_runs(spark, sf):
    return lookups.runs_with_status(runs(spark, sf), "completed", 10).select("run_id", "started_at")


@query("lookup_best_by_model", EVALUATION_SQL + "SELECT sku_id, mape_prophet FROM evaluation WHERE best_model = 'prophet'")
def lookup_best_by_model(spark, sf):
    return lookups.best_by_model(evaluation(spark, sf), "prophet").select("sku_id", "mape_prophet")


@query("lookup_promo_sales", "WITH " + SALES_SQL + " SELECT date, sku_id, store_id, units FROM sales WHERE promo_flag = 1")
def lookup_promo_sales(spark, sf):
    return lookups.promo_sales(sales(spark, sf)).select("date", "sku_id", "store_id", "units")


@query(
    "sales_history_filter",
    "WITH " + SKU_SQL + " SELECT sku_id, date, units FROM sku WHERE sku_id = 'SKU010' AND date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' ORDER BY 1, 2",
)
def sales_history_filter(spark, sf):
    return lookups.sales_history(sales_sku(spark, sf), " sku010", "1997-01-01", "1998-12-31").select("sku_id", "date", "units")


@query(
    "lookup_failed_logins",
    "WITH " + AUDIT_SQL + " SELECT id, user_id, created_at FROM audit WHERE event_type = 'login_failed' ORDER BY created_at DESC, id DESC LIMIT 100",
)
def lookup_failed_logins(spark, sf):
    return lookups.recent_events(audit_log(spark, sf), "login_failed").select("id", "user_id", "created_at")


@query("lookup_critical_events", "WITH " + AUDIT_SQL + " SELECT id, event_type, created_at FROM audit WHERE severity = 'critical'")
def lookup_critical_events(spark, sf):
    return lookups.events_of_severity(audit_log(spark, sf), "critical").select("id", "event_type", "created_at")


@query("lookup_expired_keys", "SELECT o_orderkey AS id, o_orderdate AS expires_at FROM orders WHERE o_orderdate < TIMESTAMP '1996-06-01'")
def lookup_expired_keys(spark, sf):
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("expires_at"))
    return lookups.expired_keys(keys, F.lit("1996-06-01").cast("timestamp"))


@query(
    "lookup_locked_accounts",
    "WITH " + AUDIT_SQL + ", a AS (SELECT user_id, max(created_at) + INTERVAL 24 HOUR AS locked_until FROM audit WHERE event_type = 'login_failed' GROUP BY 1) "
    "SELECT user_id, locked_until, CAST(floor((epoch_us(locked_until) - epoch_us(as_of)) / 60000000) AS BIGINT) + 1 AS remaining_minutes "
    "FROM a, newest WHERE locked_until > as_of",
)
def lookup_locked_accounts(spark, sf):
    """Accounts taken as locked for a day from their newest failure."""
    log = audit_log(spark, sf)
    last = log.where(F.col("event_type") == "login_failed").groupBy("user_id").agg(F.max("created_at").alias("t"))
    accounts = last.select("user_id", F.timestamp_add("HOUR", F.lit(24), F.col("t")).alias("locked_until"))
    return lookups.locked_accounts(accounts, audit.newest_time(log))


# ---- audit log ----------------------------------------------------------------------------------------------------


@query(
    "audit_filter",
    "WITH " + AUDIT_SQL + " SELECT id, event_type, user_email, severity, created_at FROM audit WHERE severity = 'warning' "
    "AND lower(user_email) LIKE '%user1%' AND created_at >= TIMESTAMP '2024-01-05' AND created_at <= TIMESTAMP '2024-01-25' "
    "ORDER BY created_at DESC, id DESC LIMIT 50 OFFSET 20",
)
def audit_filter(spark, sf):
    rows = audit.audit_filter(
        audit_log(spark, sf), severity="warning", user_email="USER1", start="2024-01-05", end="2024-01-25", skip=20, limit=50
    )
    return rows.select("id", "event_type", "user_email", "severity", "created_at")


@query(
    "audit_stats",
    "WITH " + AUDIT_SQL + ", r AS (SELECT audit.* FROM audit, newest WHERE created_at >= as_of - INTERVAL 96 HOUR) "
    "SELECT 'event_type' AS kind, event_type AS name, count(*) AS n FROM r GROUP BY 2 UNION ALL "
    "SELECT 'severity', severity, count(*) FROM r GROUP BY 2 UNION ALL SELECT 'total', NULL, count(*) FROM r UNION ALL "
    "SELECT 'suspicious_ip', ip_address, count(*) FROM r WHERE event_type = 'login_failed' GROUP BY 2 HAVING count(*) >= 5",
)
def audit_stats(spark, sf):
    log = audit_log(spark, sf)
    return audit.audit_stats(log, audit.newest_time(log), 96)


@query(
    "suspicious_sources",
    "WITH " + AUDIT_SQL + " SELECT ip_address, count(*) AS attempts FROM audit, newest WHERE event_type = 'login_failed' "
    "AND created_at >= as_of - INTERVAL 240 HOUR GROUP BY 1 HAVING count(*) >= 3",
)
def suspicious_sources(spark, sf):
    log = audit_log(spark, sf)
    return audit.suspicious_sources(log, audit.newest_time(log), 240)


@query(
    "export_audit",
    "WITH " + AUDIT_SQL + " SELECT id, event_type, user_id, user_email, ip_address, severity, details, "
    "strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS created_at FROM audit, newest WHERE created_at >= as_of - INTERVAL 720 HOUR",
)
def export_audit(spark, sf):
    log = audit_log(spark, sf)
    return audit.audit_export(log, audit.newest_time(log))


# ---- telemetry ----------------------------------------------------------------------------------------------------


@query(
    "request_rollup",
    "WITH " + REQUESTS_SQL + " SELECT endpoint, method, status, count(*) AS requests, round(sum(duration), 4) AS duration_sum, "
    "round(avg(duration), 4) AS duration_avg FROM requests GROUP BY 1, 2, 3",
)
def request_rollup(spark, sf):
    return rounded(telemetry.request_rollup(requests(spark, sf)))


NEWEST_SQL = "WITH " + REQUESTS_SQL + ", kept AS (SELECT * FROM requests QUALIFY row_number() OVER (PARTITION BY endpoint ORDER BY ts DESC, id DESC) <= 1000)"


def _quantile_sql(rows: str) -> str:
    return (
        "SELECT endpoint, count(*) AS count, round(sum(duration), 4) AS sum, round(quantile_cont(duration, 0.5), 4) AS p50, "
        f"round(quantile_cont(duration, 0.95), 4) AS p95, round(quantile_cont(duration, 0.99), 4) AS p99 FROM {rows} GROUP BY 1"
    )


def _newest():
    return [F.col("ts").desc(), F.col("id").desc()]


@query("keep_newest", NEWEST_SQL + " SELECT endpoint, id, duration FROM kept")
def keep_newest(spark, sf):
    kept = telemetry.keep_newest(requests(spark, sf), ["endpoint"], _newest(), telemetry.KEEP_REQUESTS)
    return kept.select("endpoint", "id", "duration")


@query("latency_quantiles", "WITH " + REQUESTS_SQL + " " + _quantile_sql("requests"))
def latency_quantiles(spark, sf):
    return rounded(telemetry.latency_quantiles(requests(spark, sf), ["endpoint"], _newest()))


@query("latency_quantiles_newest", NEWEST_SQL + " " + _quantile_sql("kept"))
def latency_quantiles_newest(spark, sf):
    keep = telemetry.KEEP_REQUESTS
    return rounded(telemetry.latency_quantiles(requests(spark, sf), ["endpoint"], _newest(), keep=keep))


@query("latency_quantiles_all", "WITH " + REQUESTS_SQL + " " + _quantile_sql("requests"))
def latency_quantiles_all(spark, sf):
    return rounded(telemetry.latency_quantiles(requests(spark, sf), ["endpoint"], _newest(), keep=None))


@query("latency_estimates")
def latency_estimates(spark, sf):
    return telemetry.latency_estimates(requests(spark, sf), ["endpoint"])


def _model_calls(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("model"), scalars.normalize_sku((F.col("user_id") % 25 + 1).cast("string")).alias("sku_id"),
        F.col("value").alias("duration"), (F.col("value") <= 15).alias("success"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("id"),
    )


CALLS_SQL = (
    "WITH o AS (SELECT event_type AS model, 'SKU' || lpad(CAST(user_id % 25 + 1 AS VARCHAR), 3, '0') AS sku_id, value, ts, event_id FROM events) "
)


@query(
    "prediction_counters",
    CALLS_SQL + "SELECT model, sku_id, count(*) AS predictions, count(*) FILTER (value > 15) AS errors, "
    "round(avg(value), 4) AS latency_avg FROM o GROUP BY 1, 2",
)
def prediction_counters(spark, sf):
    return rounded(telemetry.prediction_counters(_model_calls(spark, sf)))


@query(
    "prediction_counters_newest",
    CALLS_SQL + ", k AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY model, sku_id ORDER BY ts DESC, event_id DESC) <= 100) "
    "SELECT model, sku_id, count(*) AS predictions, count(*) FILTER (value > 15) AS errors, "
    "(SELECT round(avg(value), 4) FROM k WHERE k.model = o.model AND k.sku_id = o.sku_id) AS latency_avg FROM o GROUP BY 1, 2",
)
def prediction_counters_newest(spark, sf):
    return rounded(telemetry.prediction_counters(_model_calls(spark, sf), _newest(), keep=telemetry.KEEP_PREDICTIONS))


@query(
    "mape_gauge",
    "SELECT event_type AS model, 'SKU' || lpad(CAST(user_id % 25 + 1 AS VARCHAR), 3, '0') AS sku_id, max_by(value, event_id) AS mape FROM events GROUP BY 1, 2",
)
def mape_gauge(spark, sf):
    gauges = table(spark, sf, "events").select(
        F.col("event_type").alias("model"), scalars.normalize_sku((F.col("user_id") % 25 + 1).cast("string")).alias("sku_id"),
        F.col("value").alias("mape"), F.col("event_id").alias("at"),
    )
    return telemetry.mape_gauge(gauges)

