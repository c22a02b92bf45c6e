"""Writing tables and exports. Partitioned writes replace exactly their own partitions, so a retry does not double rows."""

from __future__ import annotations

import math
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfspark.functions.scalars import finite_or_null, normalize_sku
from shelfspark.operators.runs import require_unique

# What can be exported, in which formats, and the sales columns of an export.
EXPORT_KINDS, EXPORT_FORMATS = ("predictions", "metrics"), ("csv", "json", "parquet")
SALES_EXPORT = ["date", "sku_id", "units", "revenue", "price", "promo_flag"]
SKU_BUCKETS = 32
#: Size of a file of the bucketed layout.
BUCKET_BYTES = 128 * 1024 * 1024


def write_features(features: DataFrame, path: str, buckets: int = SKU_BUCKETS) -> None:
    """Parquet by SKU bucket. The rebalance hint evens out file sizes: a large bucket is split, small ones are merged."""
    bucketed = features.withColumn("sku_bucket", F.pmod(F.xxhash64("sku_id"), F.lit(buckets)).cast("int"))
    bucketed.hint("rebalance", "sku_bucket").write.mode("overwrite").partitionBy("sku_bucket").parquet(path)


def bucket_count(total_bytes: int, months: int = 1, bytes_per_file: int = BUCKET_BYTES) -> int:
    """Buckets for a table of that size, so that the part of a bucket in a month is about a file of ``bytes_per_file``."""
    return max(1, math.ceil(total_bytes / max(months, 1) / bytes_per_file))


def save_features(features: DataFrame, table: str, path: str, buckets: int) -> None:
    """Features as a table of the session catalog that is laid out for what reads it: months, and in them SKU buckets.

    Rows of a SKU lie in the same bucket in every month, sorted by SKU, store and day, so work per SKU needs no exchange,
    and a range of days reads its months only (:func:`read_features`). One shuffle brings a bucket's rows together.
    ``buckets`` follows from the size of the table (:func:`bucket_count`).
    """
    placed = features.withColumn("sales_month", F.date_format("date", "yyyy-MM")).repartition(buckets, "sku_id")
    (
        placed.sortWithinPartitions("sales_month", "sku_id", "store_id", "date").write.mode("overwrite").format("parquet")
        .option("path", path).partitionBy("sales_month").bucketBy(buckets, "sku_id").sortBy("sku_id", "store_id", "date").saveAsTable(table)
    )


def read_features(spark: SparkSession, table: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The stored features of a range of days; months outside it are not read."""
    rows = spark.table(table)
    if first is not None:
        rows = rows.where((F.col("sales_month") >= f"{first:%Y-%m}") & (F.col("date") >= F.lit(first)))
    if last is not None:
        rows = rows.where((F.col("sales_month") <= f"{last:%Y-%m}") & (F.col("date") <= F.lit(last)))
    return rows.drop("sales_month")


def write_classes(classes: DataFrame, path: str) -> None:
    classes.write.mode("overwrite").option("header", True).csv(path)


def _write_run(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Replaces the runs that ``rows`` hold. A repeated key is refused before anything is written."""
    require_unique(rows, keys)
    rows.hint("rebalance", "run_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id"
    ).parquet(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Add runs to the prediction table. "Current" is a query over the newest run, not a second copy."""
    _write_run(predictions, path, ["run_id", "sku_id", "date"])


def write_metrics(metrics: DataFrame, path: str) -> None:
    _write_run(metrics, path, ["run_id", "sku_id"])


def _write_text(df: DataFrame, path: str, fmt: str) -> str:
    writer = df.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def export_table(df: DataFrame, folder: str, kind: str, fmt: str, at: datetime) -> str:
    """Predictions or metrics as csv, json or parquet under a name with the time; returns the path."""
    if kind not in EXPORT_KINDS:
        raise ValueError(f"cannot export {kind}")
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"unknown format {fmt}")
    return _write_text(df, f"{folder.rstrip('/')}/{kind}_{at:%Y%m%d_%H%M%S}.{fmt}", fmt)


def export_forecast(predictions: DataFrame, path: str, sku: str, horizon: int = 30) -> str:
    """The first days of one SKU as CSV."""
    rows = predictions.where(F.col("sku_id") == normalize_sku(F.lit(sku))).orderBy("date").limit(horizon)
    return _write_text(rows, path, "csv")


def export_sales(history: DataFrame, path: str) -> str:
    return _write_text(history.select(*SALES_EXPORT), path, "csv")


def export_audit(rows: DataFrame, path: str) -> str:
    """Rows of ``audit_export``; the shuffle that sorts them also cuts the files, so the parts are in order."""
    return _write_text(rows, path, "csv")


def json_records(df: DataFrame) -> DataFrame:
    """One JSON text per row: NaN and infinity become null, dates ISO text."""
    cols = []
    for f in df.schema:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(finite_or_null(f.name).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("record"))


def write_quality_report(findings: DataFrame, path: str) -> None:
    findings.write.mode("overwrite").json(path)
