"""Exact duplicates by progressive refinement: length, then hash of the prefix, then hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfspark.llm.common import column, keep_marked, stored, whole_row

#: Runs of white space that are not already a single space: the same result as replacing every run, with few matches.
BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
PREFIX = 128
#: Parts into which the rows of one key are dealt before a join.
SALTS = 16


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _salt() -> Column:
    return F.pmod("row", F.lit(SALTS))


def _salts() -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose ``keys`` others share. Counts are combined before they move; the rows of a hot key go to ``SALTS`` tasks."""
    many = rows.groupBy(*keys).count().filter("count > 1").drop("count").withColumn("salt", _salts())
    return rows.withColumn("salt", _salt()).join(many, [*keys, "salt"], "left_semi").drop("salt")


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are read once, into a table of small rows (length, prefix hash, digest). Rows are then refined: those alone in
    their length are done, those alone in (length, prefix) are done, and only the rest are grouped by digest. The digest
    is a result column of every row, so it is taken in that same read; texts never move between executors.

    Of equal texts the row with the smallest id stays; a null id counts as larger than any. Among repeated rows of that
    id exactly one has ``kept``. Null text equals empty text. An empty table gives no rows. Other columns are ignored.
    """
    text = normalised(column(text_col))
    rows = docs.select(column(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id",
        F.length("text").alias("len"),
        F.xxhash64(F.substring("text", 1, prefix)).alias("head"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )
    # the row number is fixed by being written, so that both sides of the last join see the same one
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "exact-dedup")
    left = _shared(_shared(rows, ["len"]), ["len", "head"])
    groups = (
        left.groupBy("digest")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "row")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    return rows.withColumn("salt", _salt()).join(groups.withColumn("salt", _salts()), ["digest", "salt"], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.col("n").isNull() | (F.col("row") == F.col("first.row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with their own columns.

    Only rows that share their text, and few others, move (:func:`keep_marked`); each task passes on one of equal rows, so
    a group that holds a third of the table is small before the shuffle.
    """
    found = exact_dedup(docs, id_col=id_col, text_col=text_col)
    keys = lambda sha, i: {"k1": F.xxhash64(sha, i), "k2": F.hash(i, sha)}
    marked = found.select(*[c.alias(k) for k, c in keys(F.col("text_sha256"), F.col("doc_id")).items()], "kept").groupBy("k1", "k2").agg(
        F.max("kept").alias("keep"), F.count("*").alias("n")
    )
    sha = F.sha2(normalised(column(text_col)), 256)
    rows = docs.select(whole_row(docs), *[c.alias(k) for k, c in keys(sha, column(id_col)).items()])
    return keep_marked(rows, marked)
