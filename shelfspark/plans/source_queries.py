"""Sources and sinks, checked by writing a table that is derived from the given ones and reading it back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shelfspark import schema
from shelfspark.operators import audit, clean, features, quality, runs as run_ops, segment, summary
from shelfspark.operators.prepare import CLASSES
from shelfspark.plans.forecast_queries import EVALUATION_SQL, evaluation
from shelfspark.plans.prepare_queries import CLASSES_SQL, features_sql
from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import (
    AUDIT_SQL, PREDICTIONS_SQL, RAW_SQL, SALES_SQL, audit_log, predictions, sales, sales_raw, table,
)
from shelfspark.session import run_folder
from shelfspark.sources import files, sinks

AT = datetime(2024, 1, 31, 12, 0, 0)


def sales_csv(spark, sf, name: str) -> str:
    """The daily facts as a CSV folder with untidy headers and promo flags in words."""
    path = run_folder(spark, name)
    sales(spark, sf).select(
        F.col("date").alias("Date "), F.col("sku_id").alias("SKU_ID"), "store_id", "category",
        F.col("units").alias("qty"), F.col("price").alias(" Price"),
        (F.col("promo_flag") == 1).alias("promo_flag"),
    ).write.option("header", True).csv(path)
    return path


@query("read_sales", "WITH " + SALES_SQL + " SELECT date, sku_id, store_id, category, units, price, promo_flag FROM sales")
def read_sales(spark, sf):
    return files.read_sales(spark, sales_csv(spark, sf, "read-sales"))


@query(
    "rescued",
    "SELECT 'date' AS column_name, count(*) FILTER (o_orderpriority = '5-LOW') AS lost FROM orders "
    "UNION ALL SELECT 'units', count(*) FILTER (o_orderstatus = 'P') FROM orders",
)
def rescued(spark, sf):
    """Orders as a sales file with some text that is no date or number."""
    path = run_folder(spark, "rescued")
    table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") == "5-LOW", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.col("o_custkey").alias("sku_id"),
        F.when(F.col("o_orderstatus") == "P", "many").otherwise(F.col("o_totalprice").cast("string")).alias("sales"),
    ).write.option("header", True).csv(path)
    return files.rescued(files.read_raw(spark, path))


@query(
    "stage_upload",
    "WITH " + SALES_SQL + " SELECT count(*) AS \"rows\", 7 AS columns, count(DISTINCT sku_id) AS skus, count(DISTINCT store_id) AS stores, "
    "min(date) AS min_date, max(date) AS max_date, sum(units) AS units, count(*) FILTER (date IS NULL) AS missing_date, "
    "count(*) FILTER (units IS NULL) AS missing_units, count(*) FILTER (price IS NULL) AS missing_price, "
    "1 AS uploads, true AS first_new, false AS second_new FROM sales",
)
def stage_upload(spark, sf):
    """One upload staged twice, the second time in other files: it is known by its rows. The profile is its row."""
    zone = run_folder(spark, "zone")
    upload, split = sales_csv(spark, sf, "upload"), run_folder(spark, "upload-split")
    files.read_raw(spark, upload).repartition(3).write.option("header", True).csv(split)
    _, first, profile = files.stage_upload(spark, upload, zone)
    _, second, _ = files.stage_upload(spark, split, zone)
    known = files.read_zone(spark, zone).agg(F.count_distinct("ingest_id").cast("int")).first()[0]
    return profile.withColumns({"uploads": F.lit(known), "first_new": F.lit(first), "second_new": F.lit(second)})


@query(
    "dataset_catalogue",
    "WITH " + SALES_SQL + ", f AS (SELECT store_id, count(*) AS n FROM sales GROUP BY 1) "
    "SELECT store_id || ' sales.csv' AS name, n AS \"rows\", NULL::VARCHAR AS error FROM f "
    "UNION ALL SELECT 'header only.csv', 0, NULL UNION ALL SELECT 'broken.csv.gz', NULL, 'cannot be read' "
    "UNION ALL SELECT 'no byte.csv', NULL, 'is empty'",
)
def dataset_catalogue(spark, sf):
    """A file for each store with a blank in its name, one with a header only, one without a byte, and a broken archive."""
    folder, parts = run_folder(spark, "catalogue"), run_folder(spark, "catalogue-parts")
    rows = sales(spark, sf).withColumn("store", F.col("store_id"))
    rows.repartition("store").write.partitionBy("store").option("header", True).csv(parts)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(conf)
    fs.mkdirs(path(folder))
    for store in fs.listStatus(path(parts)):
        name = store.getPath().getName()
        for part in fs.listStatus(store.getPath()) if name.startswith("store=") else ():
            if part.getPath().getName().startswith("part-"):
                fs.rename(part.getPath(), path(folder, f"{name.removeprefix('store=')} sales.csv"))
    for name, text in (("header only.csv", b"date,sku_id,units\n"), ("broken.csv.gz", b"no archive at all"), ("no byte.csv", b"")):
        out = fs.create(path(folder, name))
        out.write(bytearray(text))
        out.close()
    return files.dataset_catalogue(spark, folder).select("name", "rows", "error")


@query("dataset_rows", "WITH " + SALES_SQL + ' SELECT count(*) AS "rows" FROM sales')
def dataset_rows(spark, sf):
    """The row counts of the catalogue add up to the table."""
    listed = files.dataset_catalogue(spark, sales_csv(spark, sf, "catalogue"))
    return listed.agg(F.sum("rows").alias("rows"))


@query(
    "rescued_dates",
    "SELECT count(*) AS \"rows\", count(*) FILTER (o_orderpriority = '5-LOW') AS unreadable, count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority <> '5-LOW') AS missing FROM orders",
)
def rescued_dates(spark, sf):
    """Orders as a sales file in which some dates are no dates and some are missing."""
    low, open_ = F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus") == "P"
    day = F.when(low, "03.01.2024").when(~open_, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return clean.rescued_dates(table(spark, sf, "orders").select(day.alias("date")))


@query(
    "read_artifact",
    "WITH " + PREDICTIONS_SQL + " SELECT run_id, sku_id, date, round(prophet, 4) AS prophet, round(lgbm, 4) AS lgbm, round(ensemble, 4) AS ensemble FROM pred",
)
def read_artifact(spark, sf):
    path = f"{run_folder(spark, 'artifact')}/predictions.csv"
    rows = predictions(spark, sf)
    rows.select("run_id", "sku_id", "date", "prophet", "lgbm", "ensemble").write.option("header", True).csv(path)
    columns = "run_id BIGINT, sku_id STRING, date DATE, prophet DOUBLE, lgbm DOUBLE, ensemble DOUBLE"
    return rounded(files.read_artifact(spark, path, columns))


@query(
    "write_features",
    "WITH " + SALES_SQL + " " + features_sql("sales"),
)
def write_features(spark, sf):
    path = run_folder(spark, "features")
    sinks.write_features(features.build_features(sales(spark, sf)), path)
    return rounded(spark.read.parquet(path).drop("sku_bucket"))


@query("write_classes", "WITH " + SALES_SQL + CLASSES_SQL.format(rows="sales"))
def write_classes(spark, sf):
    path = f"{run_folder(spark, 'classes')}/classes.csv"
    sinks.write_classes(segment.abc_order(segment.abc_xyz(sales(spark, sf))), path)
    return rounded(files.read_artifact(spark, path, CLASSES).select("sku_id", "units_sum", "cv", "ABCXYZ"))


@query("write_predictions", "WITH " + PREDICTIONS_SQL + " SELECT run_id, sku_id, date, round(ensemble, 4) AS ensemble FROM pred")
def write_predictions(spark, sf):
    """All runs are written, and one of them a second time: it replaces itself."""
    path = run_folder(spark, "predictions")
    rows = predictions(spark, sf)
    sinks.write_predictions(rows, path)
    sinks.write_predictions(rows.where(F.col("run_id") == 2), path)
    stored = files.read_artifact(spark, path, schema.PREDICTION)
    return rounded(stored.select("run_id", "sku_id", "date", "ensemble"))


@query(
    "write_metrics",
    EVALUATION_SQL + "SELECT CAST(4 AS BIGINT) AS run_id, sku_id, mape_prophet, mape_naive, best_model FROM evaluation",
)
def write_metrics(spark, sf):
    path = run_folder(spark, "metrics")
    sinks.write_metrics(run_ops.load_metrics(evaluation(spark, sf), 4), path)
    stored = files.read_artifact(spark, path, schema.METRIC)
    return stored.select("run_id", "sku_id", "mape_prophet", "mape_naive", "best_model")


EXPORT_SQL = "WITH " + PREDICTIONS_SQL + " SELECT fmt, run_id, sku_id, date, round(prophet, 4) AS prophet FROM pred, (VALUES ('csv'), ('json'), ('parquet')) t(fmt)"


@query("export_table", EXPORT_SQL)
def export_table(spark, sf):
    """The predictions exported in each format and read back."""
    folder, columns = run_folder(spark, "exports"), "run_id BIGINT, sku_id STRING, date DATE, prophet DOUBLE"
    rows = predictions(spark, sf).select("run_id", "sku_id", "date", "prophet")
    back = [
        files.read_artifact(spark, sinks.export_table(rows, folder, "predictions", fmt, AT), columns).withColumn("fmt", F.lit(fmt))
        for fmt in sinks.EXPORT_FORMATS
    ]
    return rounded(summary.concat_results(*back))


@query(
    "export_forecast_file",
    "WITH " + PREDICTIONS_SQL + " SELECT sku_id, date, round(xgb, 4) AS xgb FROM pred WHERE run_id = 3 AND sku_id = 'SKU006' ORDER BY date LIMIT 5",
)
def export_forecast_file(spark, sf):
    path = f"{run_folder(spark, 'export')}/forecast.csv"
    rows = predictions(spark, sf).where(F.col("run_id") == 3).select("sku_id", "date", "xgb")
    sinks.export_forecast(rows, path, "sku-6", 5)
    return rounded(files.read_artifact(spark, path, "sku_id STRING, date DATE, xgb DOUBLE"))


@query(
    "export_sales",
    "WITH " + RAW_SQL + " SELECT date, sku_id, sum(units) AS units, round(sum(units * price), 2) AS revenue, "
    "round(avg(price) + 1e-7, 3) AS price, max(promo_flag) AS promo_flag FROM raw GROUP BY 1, 2",
)
def export_sales(spark, sf):
    path = f"{run_folder(spark, 'export')}/sales.csv"
    sinks.export_sales(run_ops.load_sales(sales_raw(spark, sf)), path)
    columns = "date DATE, sku_id STRING, units DOUBLE, revenue DOUBLE, price DOUBLE, promo_flag INT"
    back = files.read_artifact(spark, path, columns)
    return back.withColumns({"revenue": F.round("revenue", 2), "price": F.round(F.col("price") + 1e-7, 3)})


@query(
    "export_audit_file",
    "WITH " + AUDIT_SQL + " SELECT id, event_type, user_id, user_email, ip_address, severity, details FROM audit, newest WHERE created_at >= as_of - INTERVAL 48 HOUR",
)
def export_audit_file(spark, sf):
    path = f"{run_folder(spark, 'export')}/audit.csv"
    log = audit_log(spark, sf)
    sinks.export_audit(audit.audit_export(log, audit.newest_time(log), 48), path)
    columns = (
        "id BIGINT, event_type STRING, user_id BIGINT, user_email STRING, ip_address STRING, severity STRING, "
        "details STRING, created_at STRING"
    )
    back = spark.read.schema(columns).option("header", True).option("escape", "\\").csv(path)
    return back.drop("created_at")


@query(
    "json_records",
    "SELECT '{\"o_orderkey\":' || o_orderkey || ',\"date\":\"' || strftime(o_orderdate, '%Y-%m-%d') || '\",\"status\":\"' || o_orderstatus "
    "|| '\",\"ratio\":' || CASE WHEN o_orderstatus = 'O' THEN '1.5' ELSE 'null' END || '}' AS record FROM orders",
)
def json_records(spark, sf):
    status = F.col("o_orderstatus")
    ratio = F.when(status == "F", float("nan")).when(status == "P", float("-inf")).otherwise(1.5)
    return sinks.json_records(
        table(spark, sf, "orders").select(
            "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), status.alias("status"), ratio.alias("ratio")
        )
    )


@query(
    "write_quality_report",
    "WITH " + RAW_SQL + " SELECT 'duplicates' AS category, count(*) - count(DISTINCT (date, sku_id, store_id)) AS affected_rows FROM raw",
)
def write_quality_report(spark, sf):
    """A report written as JSON and read back; the repeated keys are compared."""
    path = f"{run_folder(spark, 'report')}/findings.json"
    facts = sales_raw(spark, sf).select("date", "sku_id", "store_id", "units", "price")
    sinks.write_quality_report(quality.quality_report(facts, as_of="2030-01-01"), path)
    back = files.read_artifact(spark, path, schema.FINDING)
    keyed = (F.col("category") == "duplicates") & (F.col("severity") == "critical")
    return back.where(keyed).select("category", "affected_rows")
