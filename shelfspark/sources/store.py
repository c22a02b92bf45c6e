"""Tables that are written to again and again: the run log, loads with their SKUs, and retention.

Every write can be repeated: records say the same twice, loads replace their own keys, retention finds nothing left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfspark import schema
from shelfspark.operators import runs
from shelfspark.session import exists, kept, run_folder
from shelfspark.sources import sinks

# ---- run log ------------------------------------------------------------------------------------------------------


def _log(records: DataFrame, status: str, path: str) -> None:
    record = SparkSession.active().createDataFrame([], schema.RUN_RECORD)
    rows = record.unionByName(records.withColumn("status", F.lit(status)), allowMissingColumns=True)
    rows.select(*[F.col(f.name).cast(f.dataType) for f in record.schema]).write.mode("append").parquet(path)


def start_runs(starts: DataFrame, path: str) -> None:
    """Appends the start of runs (``run_id``, ``at``, and as known ``horizon``, ``model_type``) to the log."""
    _log(starts, "running", path)


def complete_runs(ends: DataFrame, path: str) -> None:
    """Appends the end of runs (``run_id``, ``at``, ``records_count``)."""
    _log(ends, "completed", path)


def fail_runs(ends: DataFrame, path: str) -> None:
    """Appends the failure of runs (``run_id``, ``at``, ``error_message``)."""
    _log(ends, "failed", path)


# ---- loads --------------------------------------------------------------------------------------------------------


def get_or_create_skus(rows: DataFrame, dim_path: str) -> DataFrame:
    """Appends a row for each SKU that the dimension lacks; returns the dimension as it then is."""
    spark = rows.sparkSession
    dim = spark.read.parquet(dim_path)
    added = runs.new_skus(rows, dim).withColumn("is_active", F.lit(True))
    dim.limit(0).unionByName(added, allowMissingColumns=True).write.mode("append").parquet(dim_path)
    return spark.read.parquet(dim_path)


def load_sales(sales: DataFrame, path: str, dim_path: str, created_at: Column | None = None) -> None:
    """Facts into the history table, which is partitioned by month and unique on (sku, date).

    A day of a SKU that is loaded again replaces what was there. Only the months that the load touches are read and
    written; they are written aside first, as they are read from the same table.
    """
    spark = sales.sparkSession
    month = F.date_format("date", "yyyy-MM")
    rows = runs.load_sales(sales, created_at).withColumn("month", month)
    aside = run_folder(spark, "load")
    rows.write.parquet(aside)
    rows = spark.read.parquet(aside)
    runs.require_unique(rows, ["sku_id", "date"])
    get_or_create_skus(rows, dim_path)
    if exists(spark, path):
        there = spark.read.parquet(path).withColumn("month", month)
        touched = there.join(rows.select("month").distinct(), "month", "left_semi")
        merged = run_folder(spark, "load")
        touched.join(rows.select("sku_id", "date"), ["sku_id", "date"], "left_anti").unionByName(rows).write.parquet(merged)
        rows = spark.read.parquet(merged)
    rows.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def load_predictions(forecast: DataFrame, run_id: int, path: str, dim_path: str, created_at: Column | None = None) -> None:
    """The forecast of one run; loading it again replaces it. SKUs that the dimension lacks are added.

    The rows are written aside first, as they are read for their SKUs, for repeated keys and for the write.
    """
    rows = kept(runs.load_predictions(forecast, run_id, created_at), "load")
    get_or_create_skus(rows, dim_path)
    sinks.write_predictions(rows, path)


def load_metrics(evaluation: DataFrame, run_id: int, path: str, dim_path: str, created_at: Column | None = None) -> None:
    """The metrics of one run; loading them again replaces them. SKUs that the dimension lacks are added.

    Written aside first, as :func:`load_predictions` does.
    """
    rows = kept(runs.load_metrics(evaluation, run_id, created_at), "load")
    get_or_create_skus(rows, dim_path)
    sinks.write_metrics(rows, path)


# ---- retention ----------------------------------------------------------------------------------------------------


def expire(spark: SparkSession, path: str, partition: str, gone: Column) -> tuple[int, int]:
    """Deletes the rows for which ``gone`` is true from a partitioned table: (deleted, kept).

    A partition without any row left is dropped, one with some is written anew, the others are not touched. One row per
    partition that changes reaches the driver.
    """
    df = spark.read.parquet(path)
    lost = F.coalesce(gone, F.lit(False))
    counted = df.groupBy(partition).agg(F.count_if(lost).alias("gone"), F.count("*").alias("n"))
    total = counted.agg(F.coalesce(F.sum("gone"), F.lit(0)), F.coalesce(F.sum(F.col("n") - F.col("gone")), F.lit(0))).first()
    changed = counted.where("gone > 0").collect()
    some = [r[partition] for r in changed if r.gone < r.n]
    if some:
        aside = run_folder(spark, "expire")
        df.where(F.col(partition).isin(some) & ~lost).write.parquet(aside)
        spark.read.parquet(aside).hint("rebalance", partition).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(partition).parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for r in changed:
        if r.gone == r.n:
            name = "__HIVE_DEFAULT_PARTITION__" if r[partition] is None else r[partition]
            target = hadoop.Path(path, f"{partition}={name}")
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    spark.catalog.refreshByPath(path)
    return int(total[0]), int(total[1])

