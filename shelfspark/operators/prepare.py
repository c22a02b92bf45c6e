"""From sales files to written features and classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from shelfspark.operators import clean, features, segment
from shelfspark.session import kept
from shelfspark.sources import files, sinks

CLASSES = "sku_id STRING, units_sum DOUBLE, ABC STRING, cv DOUBLE, XYZ STRING, ABCXYZ STRING"


def prepare_dataset(
    spark: SparkSession, source: str, target: str, order: Sequence[Column | str] = (), drop: Sequence[str] = (),
    on_bad_dates: str = "raise",
) -> tuple[DataFrame, DataFrame]:
    """Read, clean, build features, classify; writes ``features`` and ``classes.csv`` below ``target`` and returns both as read back.

    The file's dates are kept as text until the cleaning, which refuses what it cannot read. The classes come from the
    written features, so files are read and cleaned once.
    """
    raw = files.read_raw(spark, source)
    facts = files.typed_sales(raw, dates=False)
    if not files.is_columnar(source):
        # cleaning reads its input for the calendar's bounds and for the facts; text is parsed once
        facts = kept(facts, "prepare-facts")
    daily = clean.clean_sales(facts, order=order, drop=drop, on_bad_dates=on_bad_dates)
    path = f"{target.rstrip('/')}/features"
    sinks.write_features(features.build_features(daily), path)
    written = spark.read.parquet(path).drop("sku_bucket")
    classes = f"{target.rstrip('/')}/classes.csv"
    sinks.write_classes(segment.abc_order(segment.abc_xyz(written)), classes)
    return written, files.read_artifact(spark, classes, CLASSES)
