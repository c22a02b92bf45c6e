"""Reading sales files, artifacts and the raw zone."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfspark import schema
from shelfspark.functions.scalars import nan_to_null
from shelfspark.operators.columns import ColumnError, normalize_headers, parse_date, require_columns
from shelfspark.session import exists

READERS = {"": "csv", ".csv": "csv", ".parquet": "parquet", ".json": "json"}


def _format(path: str) -> str:
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension not in READERS:
        raise ValueError(f"cannot read {extension} files")
    return READERS[extension]


def is_columnar(path: str) -> bool:
    """Whether a column can be read without the others."""
    return _format(path) == "parquet"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Columns as they are in the file: CSV as text, nothing is inferred."""
    kind = _format(path)
    if kind == "csv":
        return spark.read.option("header", True).csv(path)
    if kind == "json":
        return spark.read.option("primitivesAsString", True).json(path)
    return spark.read.parquet(path)


def _typed(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    if dict(df.dtypes)[column] != "string":
        return c.cast({"date": "date", "promo_flag": "int"}.get(column, "double"))
    if column == "date":
        return parse_date(column)
    if column == "promo_flag":
        return F.coalesce(c.try_cast("double").cast("int"), c.try_cast("boolean").cast("int"))
    return c.try_cast("double")


TYPED = ("date", "units", "price", "promo_flag")


def typed_sales(raw: DataFrame, dates: bool = True) -> DataFrame:
    """Normalized headers and fixed types; text that does not fit becomes NULL (count it with ``rescued``).

    Without ``dates`` the date column stays as it is, for a later step that must see what cannot be read.
    """
    df = require_columns(normalize_headers(raw), schema.REQUIRED)
    return nan_to_null(df.withColumns({c: _typed(df, c) for c in TYPED if c in df.columns and (dates or c != "date")}))


def rescued(raw: DataFrame) -> DataFrame:
    """Per typed column, how many values the cast loses: rows (column_name, lost)."""
    df = normalize_headers(raw)
    lost = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNotNull() & _typed(df, c).isNull()).alias("lost"))
        for c in TYPED
        if c in df.columns
    ]
    return df.agg(F.array(*lost).alias("_l")).select(F.inline("_l"))


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sales facts from a CSV, Parquet or JSON file or folder."""
    return typed_sales(read_raw(spark, path))


def read_artifact(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A written table of this package with its fixed schema (DDL text of ``schema``).

    Tables are Parquet folders without an extension; exports carry theirs.
    """
    kind = _format(path) if os.path.splitext(path.rstrip("/"))[1] else "parquet"
    reader = spark.read.schema(table)
    if kind == "csv":
        reader = reader.option("header", True)
    return nan_to_null(reader.format(kind).load(path))


def content_id(rows: DataFrame) -> str:
    """Identity of a table by its rows: equal rows give an equal id, whatever their order, file names or split.

    Two hashes of each row are combined by sums, so a table of any size is read by many tasks. Column names and order
    count; the whole digest is given, as it decides that an upload is known.
    """
    row = F.struct(*rows.columns)
    hashed = rows.select(F.xxhash64(row).alias("h"), F.xxhash64(F.lit("second"), row).alias("g"))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    sums = hashed.agg(F.count("*").alias("n"), total("h").alias("h"), total("g").alias("g"), F.bit_xor("h").alias("x"))
    names = F.lit(",".join(f"{n} {t}" for n, t in rows.dtypes))
    return sums.select(F.sha2(F.concat_ws("|", names, "n", "h", "g", "x"), 256).alias("id")).first().id


def _empty_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder that have no byte; names and lengths only, as in any listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listLocatedStatus(path)
    found = []
    while listed.hasNext():
        file = listed.next()
        name = file.getPath().getName()
        if file.isFile() and file.getLen() == 0 and not name.startswith(("_", ".")):
            found.append((name, file.getPath().toString(), file.getModificationTime()))
    rows = spark.createDataFrame(found, "name string, path string, at long")
    return rows.select(
        "name", "path", F.lit(0).cast("long").alias("size_bytes"), F.timestamp_millis("at").alias("modified"), F.lit("is empty").alias("error")
    )


def dataset_catalogue(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """Files of a folder with size, rows and time, newest first; a file that cannot be read is kept with an error.

    Spark leaves files without a byte out of a listing; they are found by their length and listed with an error.

    The listing does not open the files. Rows are lines less the header, counted in one read of the folder in which an
    unreadable file (a broken archive) counts as none, and its own columns do not matter.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "modificationTime", "length")
    lines = spark.read.option("ignoreCorruptFiles", True).text(folder)
    counted = lines.select(F.col("_metadata.file_path").alias("_path")).groupBy("_path").agg(F.count("*").alias("_lines"))
    # one reader writes file:/, the other file:///, and one of them encodes blanks
    plain = lambda c: F.url_decode(F.regexp_replace(F.regexp_replace(c, "^file:/+", "/"), r"\+", "%2B"))
    once = lambda c: F.regexp_replace(c, "^file:/+", "/")
    out = files.join(counted, once(F.col("path")) == plain(F.col("_path")), "left").select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.col("length").alias("size_bytes"),
        (F.col("_lines") - 1).alias("rows"), F.col("modificationTime").alias("modified"),
        F.when(F.col("_lines").isNull(), "cannot be read").alias("error"),
    ).unionByName(_empty_files(spark, folder), allowMissingColumns=True).orderBy(F.col("modified").desc(), "name")
    return out if limit is None else out.limit(limit)


def upload_profile(upload: DataFrame) -> DataFrame:
    """One row: rows, columns, SKUs, stores, first and last day, units, missing values of the main columns."""
    absent = lambda c: F.count_if(F.col(c).isNull()).alias(f"missing_{c}") if c in upload.columns else F.lit(None).cast("long").alias(f"missing_{c}")
    stores = F.count_distinct("store_id") if "store_id" in upload.columns else F.lit(None).cast("long")
    return upload.agg(
        F.count("*").alias("rows"), F.lit(len(upload.columns)).alias("columns"), F.count_distinct("sku_id").alias("skus"),
        stores.alias("stores"), F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.sum("units").alias("units"),
        *[absent(c) for c in ("date", "units", "price")],
    )


def stage_upload(spark: SparkSession, path: str, zone: str) -> tuple[str, bool, DataFrame]:
    """Append an upload to the raw zone under its content id: (id, whether it is new, its profile).

    An upload that is already there is skipped. The partition is written as a whole, so a repeated run replaces its own
    unfinished output; the profile is read from what was written.
    """
    upload = read_sales(spark, path)
    if "units" not in upload.columns:
        raise ColumnError("no units column (units, qty, quantity or sales)")
    ingest = content_id(upload)
    target = f"{zone.rstrip('/')}/ingest_id={ingest}"
    new = not exists(spark, f"{target}/_SUCCESS")
    if new:
        upload.write.mode("overwrite").parquet(target)
    return ingest, new, upload_profile(spark.read.parquet(target))


def read_zone(spark: SparkSession, zone: str) -> DataFrame:
    return spark.read.option("basePath", zone).parquet(f"{zone.rstrip('/')}/ingest_id=*")
