"""Secrets in texts: strong patterns, and weak credential parts that count only beside a part that completes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

REACH = 200

# The three strong kinds, in the order in which spans of one start are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Weak parts: each means little alone.
LOGIN = r"""(?i)\b(client_?id|account_?id|key_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})"""
VALUE = r"""(?i)\b(private_?key|access_?key|signing_?key|passphrase|pass|pwd|credential|auth)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{8,})"""
BLOB = r"[A-Za-z0-9+/]{40,}"
ENDPOINT = r"(?i)(https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:@/?#%&=+-]+"

#: kind -> (rank, role, strong, pattern, group whose length is tested, least length)
KINDS = {
    "assign": (0, "secret", True, ASSIGN, 2, 8),
    "access": (1, "identifier", True, ACCESS, 0, 16),
    "hex": (2, "secret", True, HEX, 0, 32),
    "login": (3, "identifier", False, LOGIN, 2, 3),
    "value": (4, "secret", False, VALUE, 2, 8),
    "blob": (5, "secret", False, BLOB, 0, 40),
    "endpoint": (6, "endpoint", False, ENDPOINT, 0, 8),
}
#: The roles of which one must lie in the scope of a weak part of the given role.
COMPLETES = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}


def _pieces(text: Column, kind: str) -> Column:
    """The matches of a kind as (kind rank, number, length of the text since the match before, length, tested length)."""
    rank, _, _, pattern, group, _ = KINDS[kind]
    found = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("size"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length).alias("tested"),
    )
    # the piece after the last match has no size
    rows = F.transform(
        F.filter(found, lambda x: x["size"].isNotNull()),
        lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("no"), x["gap"].alias("gap"), x["size"].alias("size"), x["tested"].alias("tested")),
    )
    none = F.array().cast("array<struct<rank:int,no:int,gap:int,size:int,tested:int>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def _by_rank(field: int, of: Column) -> Column:
    """A property of the kinds, looked up by rank."""
    return F.element_at(F.array(*[F.lit(v[field]) for v in KINDS.values()]), of + 1)


def secret_parts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Credential parts with their places: key columns, ``rank``, ``begin``, ``end``, ``strong``, ``linked``.

    A row without any part comes back once with a null rank. ``linked`` tells that a part which completes this one lies
    at most ``reach`` code points before or after it; this is an interval join of each part with the nearest ends of the
    others, made in two passes over the parts of a text in order, so a text with many parts gives no pairs. A weak part
    that overlaps a strong one is no part of its own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = ["doc_id", "h1", "h2"]
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("h1"),
        F.hash(text, F.length(text)).alias("h2"),
        F.explode_outer(F.concat(*[_pieces(text, k) for k in KINDS])).alias("p"),
    )
    found = found.select(*key, "p.*").repartition(*key)
    # repeated rows of a table give the same parts; they are counted here and given back at the end
    found = found.groupBy(*key, "rank", "no", "gap", "size", "tested").agg(F.count("*").alias("copies"))
    so_far = Window.partitionBy(*key, "rank").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    parts = found.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
    parts = parts.withColumn("begin", F.col("end") - F.col("size"))
    parts = parts.withColumn("long_enough", F.col("tested") >= _by_rank(5, F.col("rank")))
    # a text all of whose parts are too short keeps one row, without a part
    first = F.min(F.when(F.col("long_enough"), 0).otherwise(1)).over(Window.partitionBy(*key))
    least = F.row_number().over(Window.partitionBy(*key).orderBy("rank", "no"))
    parts = parts.withColumns({"none": first == 1, "nth": least}).filter(F.col("long_enough") | (F.col("none") & (F.col("nth") == 1)))
    parts = parts.withColumn("rank", F.when(F.col("none"), None).otherwise(F.col("rank")))
    parts = parts.withColumns({"strong": _by_rank(2, F.col("rank")), "role": _by_rank(1, F.col("rank"))})
    before = Window.partitionBy(*key).orderBy("begin", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*key).orderBy(F.desc("begin"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, -1)
    strong_near = (F.max(F.when(F.col("strong"), F.col("end"))).over(before) > F.col("begin")) | (
        F.min(F.when(F.col("strong"), F.col("begin"))).over(after) < F.col("end")
    )
    parts = parts.filter("rank IS NULL OR strong IS NOT NULL").withColumn("inside", F.coalesce(strong_near, F.lit(False)))
    parts = parts.filter(F.col("rank").isNull() | F.col("strong") | ~F.col("inside"))
    near = {
        role: F.coalesce(F.max(F.when(F.col("role") == role, F.col("end"))).over(before) >= F.col("begin") - reach, F.lit(False))
        | F.coalesce(F.min(F.when(F.col("role") == role, F.col("begin"))).over(after) <= F.col("end") + reach, F.lit(False))
        for role in COMPLETES
    }
    linked = F.lit(False)
    for role, others in COMPLETES.items():
        any_near = near[others[0]]
        for other in others[1:]:
            any_near = any_near | near[other]
        linked = F.when(F.col("role") == role, any_near).otherwise(linked)
    return parts.select(*key, "copies", "rank", "begin", "end", "strong", linked.alias("linked"))


def secret_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per input row: id, counts and digest of the strong spans, ``spans`` with the linked weak ones too.

    A span is ``kind:start:end`` in code points, end exclusive, listed by start and then by kind. Null text counts as
    empty; a text without a find has zero counts, the digest of nothing and an empty ``spans``. Repeated rows come
    back as often as they stand. An empty table gives no rows. Other columns are ignored.
    """
    parts = secret_parts(docs, id_col=id_col, text_col=text_col, reach=reach)
    kept = F.col("strong") | F.col("linked")
    span = F.struct("begin", "rank", "end")
    names = F.array(*[F.lit(k) for k in KINDS])
    listed = lambda spans: F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["begin"], s["end"])), ","
    )
    count = lambda kind: F.count(F.when(F.col("rank") == KINDS[kind][0], 1))
    rows = parts.groupBy("doc_id", "h1", "h2").agg(
        F.max("copies").alias("copies"),
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.collect_list(F.when(F.col("strong"), span)).alias("base"),
        F.collect_list(F.when(kept, span)).alias("every"),
    )
    return rows.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("every")).alias("spans"),
        F.size(F.col("every")).cast("long").alias("n_spans"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")
