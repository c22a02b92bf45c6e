"""Reading a sales table over JDBC, split on a numeric or date column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.functions.text import identifier
from shelfspark.sources.files import typed_sales


def jdbc_options(
    table: str,
    database: str,
    user: str,
    password: str,
    host: str = "localhost",
    port: int = 5432,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of the JDBC reader. Names are checked, because they become part of the statement.

    Without a partition column the whole table is one task; give one, with its bounds, for anything large.
    """
    if not 1 <= port <= 65535:
        raise ValueError(f"not a port: {port}")
    options = {
        "url": f"jdbc:postgresql://{host}:{port}/{identifier(database)}",
        "driver": "org.postgresql.Driver",
        "dbtable": identifier(table),
        "user": user,
        "password": password,
        "fetchsize": str(fetch_size),
    }
    if (partition_column is None) != (bounds is None):
        raise ValueError("a partition column needs bounds, and bounds need a column")
    if partition_column is not None and bounds is not None:
        options |= {
            "partitionColumn": identifier(partition_column),
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_sales(spark: SparkSession, **settings) -> DataFrame:
    return typed_sales(spark.read.format("jdbc").options(**jdbc_options(**settings)).load())
