"""What the operators of this folder share: reading a table, keeping an intermediate table, the learning split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfspark.session import run_folder

HELD_OUT_PARTS = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and not lost with an executor."""
    spark = df.sparkSession
    path = run_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents whose labels nothing is learnt from; a null id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_PARTS == 0, F.lit(True))


def column(name: str) -> Column:
    """A column by its whole name, which may hold dots and blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns of a table as one struct, so that helper columns beside it cannot meet them; ``select("row.*")`` gives them back."""
    return F.struct(*[column(c) for c in df.columns]).alias("row")


#: Hashes are compared with a bound on this scale, fine enough for any number of rows.
HASH_SCALE = 1 << 62


def _hash_share(purpose: str, *keys: Column) -> Column:
    """A number below ``HASH_SCALE`` that depends on the keys and on what it is drawn for."""
    return F.xxhash64(F.lit(purpose), *keys).bitwiseAND(F.lit(HASH_SCALE - 1))


def sampled(rows: DataFrame, id_col: str, bound: int, purpose: str = "sample") -> DataFrame:
    """About ``bound`` of the rows at most, chosen by a hash of the id and the purpose; all of them where there are fewer.

    Only for fitting models, whose samples are bounded by a documented parameter. Samples for other purposes are drawn
    independently, so one may be taken of another.
    """
    n = rows.count()
    if n <= bound:
        return rows
    return rows.filter(_hash_share(purpose, F.col(id_col)) < HASH_SCALE * bound // n)


def sampled_by(rows: DataFrame, id_col: str, group: str, bound: int, purpose: str = "sample") -> DataFrame:
    """As :func:`sampled`, with a part of ``bound`` of its own for each value of ``group``, so rare values keep all their rows."""
    counts = stored(rows.groupBy(group).agg(F.count("*").alias("n")).withColumnRenamed(group, "of"), "group-counts")
    total, groups = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    if total <= bound:
        return rows
    share = F.lit(float(bound) / groups) / F.col("n")
    few = _hash_share(purpose, F.col(id_col)) < (F.least(share, F.lit(1.0)) * F.lit(float(HASH_SCALE))).cast("long")
    return rows.join(counts, F.col(group).eqNullSafe(F.col("of"))).filter(few | (share >= 1)).drop("of", "n")


def row_key(id_col: str, text_col: str) -> dict[str, Column]:
    """96 bits that name a row by its id and text; equal for repeated rows, and defined for null ids and texts."""
    text = F.coalesce(column(text_col), F.lit(""))
    return {"__k1": F.xxhash64(column(id_col), text), "__k2": F.hash(F.length(text), text, column(id_col))}


#: Bits of the filter by which rows that surely stay are told; 2 MB at any number of rows.
FILTER_BITS = 1 << 24


def _bits_of(key: Column) -> Column:
    """The two bits of a 64-bit key in the filter."""
    return F.array(key.bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(FILTER_BITS - 1)))


def _filter_of(keys: DataFrame) -> Column:
    """A Bloom filter of the keys (``k1``) as a constant array of words; its size does not depend on their number."""
    bit = keys.select(F.explode(_bits_of(F.col("k1"))).alias("p"))
    words = bit.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("b"))
    every = keys.sparkSession.range(FILTER_BITS // 64).withColumnRenamed("id", "w").join(words, "w", "left")
    dense = every.agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("a"))
    # one row, written: the filter is read wherever it is named, and worked out once
    return stored(dense.select(F.col("a.b").alias("words")), "key-filter").scalar()


def _may_hold(held: Column, key: Column) -> Column:
    """Whether the filter may hold a key: surely where it does, and for a few others the more it holds."""
    def set_at(p: Column) -> Column:
        word = F.get(held, F.shiftright(p, 6).cast("int"))
        return F.call_function("getbit", word, p.bitwiseAND(F.lit(63)).cast("int")) == 1

    places = _bits_of(key)
    return set_at(places[0]) & set_at(places[1])


def keep_marked(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows (``row``, ``k1``, ``k2``) whose key is marked ``keep``, one of each key, as they were.

    ``marked`` has each key once: ``k1``, ``k2``, ``keep``, and ``n``, how many rows have it. Most rows are alone with a key
    that stays. A filter of all other keys, of a fixed size, tells them, and they do not move. What the filter may hold is
    shuffled by key: each task first passes on one row per key, and the rows of keys that go are taken out by an exact
    join. A filter that is too full for the number of keys only makes more rows move.
    """
    others = stored(marked.filter(~(F.col("keep") & (F.col("n") == 1))).select("k1", "k2", "keep"), "special-keys")
    doubtful = _may_hold(_filter_of(others), F.col("k1"))
    one = Window.partitionBy("k1", "k2").orderBy(F.lit(0))
    moved = rows.filter(doubtful).withColumn("n", F.row_number().over(one)).filter("n = 1")
    left = moved.join(others.filter(~F.col("keep")), ["k1", "k2"], "left_anti")
    return rows.filter(~doubtful).select("row.*").union(left.select("row.*"))


def kept_rows(docs: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key (``__k1``, ``__k2``) is marked ``keep``, repeated rows once, with the columns of ``docs``."""
    k1, k2 = row_key(id_col, text_col).values()
    rows = docs.select(whole_row(docs), k1.alias("k1"), k2.alias("k2"))
    return keep_marked(rows, marked.select(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), "keep", "n"))
