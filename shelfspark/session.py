"""Session helpers: a local builder for tests and the shared folder for checkpoints and run output."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter owns these settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfspark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Where it is unset, a local session gets a fresh temporary folder; a cluster session is refused, because a
    machine-local folder is lost together with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="shelfspark-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and not lost with an executor."""
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
