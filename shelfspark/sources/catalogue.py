"""Versioned catalogue of models: a fit is written apart, and its registry row makes it visible by one rename.

    <folder>/attempts/<type>-<version>-<id>/model      what was fitted, a model or a table of parameters
    <folder>/registry/<type>/<version>/                the registry row of the attempt that was published

Nothing below ``attempts`` is looked at unless a registry row names it, so a writer that dies leaves nothing behind that
could be loaded. The rename never replaces a row: of several writers of one version the first stays and the others take
its model. Each row has a folder of its own, so writers of different versions share no folder and lose nothing.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections import defaultdict
from collections.abc import Callable
from typing import Any, TypeVar
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfspark import schema
from shelfspark.session import exists

Model = TypeVar("Model")

# the rename is exclusive in a distributed store; a local file system looks first and renames then, so threads take turns
_RENAMES = threading.Lock()
_FITS: dict[tuple[str, str, str], threading.Lock] = defaultdict(threading.Lock)


def _name(part: str) -> str:
    """A name as one step of a path."""
    return quote(part, safe="").replace(".", "%2E")


def _row_path(folder: str, model_type: str, version: str) -> str:
    return f"{folder.rstrip('/')}/registry/{_name(model_type)}/{_name(version)}"


def _read(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(schema.MODEL_REGISTRY).option("recursiveFileLookup", "true").json(path)
    return rows.where(F.col("file_path").isNotNull())


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """One row per published model type and version; empty where nothing is published."""
    path = f"{folder.rstrip('/')}/registry"
    return _read(spark, path) if exists(spark, path) else spark.createDataFrame([], schema.MODEL_REGISTRY)


def current(rows: DataFrame) -> DataFrame:
    """The newest active registry row of each model type; of rows of one moment the larger version."""
    rest = [c for c in rows.columns if c != "model_type"]
    newest = F.max_by(F.struct(*rest), F.struct("created_at", "version"))
    return rows.where("is_active").groupBy("model_type").agg(newest.alias("_r")).select("model_type", "_r.*")


def published(spark: SparkSession, folder: str, model_type: str, version: str) -> str | None:
    """Where the model of a published version lies, else None."""
    path = _row_path(folder, model_type, version)
    if not exists(spark, path):
        return None
    row = _read(spark, path).first()
    return row.file_path if row else None


def _rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Moves a folder to a name that is not taken; False where it is taken."""
    jvm = spark._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    conf = spark._jsc.hadoopConfiguration()
    dst.getFileSystem(conf).mkdirs(dst.getParent())
    never_replace = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    with _RENAMES:
        if exists(spark, target):
            return False
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.getFileSystem(conf).getUri(), conf).rename(src, dst, never_replace)
        except Exception:
            if exists(spark, target):
                return False
            raise
    return True


def publish(
    spark: SparkSession, folder: str, model_type: str, version: str, write: Callable[[str], None], facts: dict[str, Any | Column],
    details: DataFrame | None = None,
) -> str:
    """Writes a model by ``write(path)`` and publishes it with its registry row; the path of the version that counts.

    ``facts`` are columns of the registry row, taken over ``details`` (one row) where they are columns. If the version is
    there by then, this attempt is removed and the path of the first one returned.
    """
    attempt = f"{folder.rstrip('/')}/attempts/{_name(model_type)}-{_name(version)}-{uuid.uuid4().hex}"
    path = f"{attempt}/model"
    write(path)
    given = {"model_type": model_type, "version": version, "file_path": path, "is_active": True, **facts}
    given.setdefault("created_at", F.current_timestamp())
    one = details if details is not None else spark.range(1)
    empty = spark.createDataFrame([], schema.MODEL_REGISTRY)
    columns = [
        (given[f.name] if isinstance(given.get(f.name), Column) else F.lit(given.get(f.name))).cast(f.dataType).alias(f.name)
        for f in empty.schema
    ]
    one.select(*columns).coalesce(1).write.json(f"{attempt}/row")
    if _rename_new(spark, f"{attempt}/row", _row_path(folder, model_type, version)):
        return path
    lost = spark._jvm.org.apache.hadoop.fs.Path(attempt)
    lost.getFileSystem(spark._jsc.hadoopConfiguration()).delete(lost, True)
    return published(spark, folder, model_type, version)


def load_or_fit(
    spark: SparkSession, folder: str, model_type: str, version: str, fit: Callable[[], Model], write: Callable[[Model, str], None],
    read: Callable[[str], Model], facts: Callable[[Model], tuple[dict[str, Any | Column], DataFrame | None]],
) -> Model:
    """The published model, or a new fit that is published. Threads of one driver that ask for one version fit it once."""
    with _FITS[folder.rstrip("/"), model_type, version]:
        path = published(spark, folder, model_type, version)
        if path is None:
            start = time.time()
            model = fit()
            seconds = time.time() - start
            told, details = facts(model)
            path = publish(
                spark, folder, model_type, version, lambda p: write(model, p), {"training_duration_sec": seconds, **told}, details
            )
    return read(path)


def as_json(**values: Any) -> str:
    return json.dumps(values, sort_keys=True, separators=(",", ":"))
