"""Near duplicates by SimHash: covering masks bring every pair within the radius together in some table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shelfspark.llm.common import column, kept_rows, row_key, stored
from shelfspark.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Members of one bucket that one task compares; a larger bucket is cut into blocks that are compared two by two.
BLOCK = 8192


def shingle_hashes(raw: bytes, words: int) -> list[int]:
    """XXH64 of each run of ``words`` words of a text (ASCII lower case, single spaces); all words where there are fewer."""
    parts = raw.lower().split()
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(parts), SEED)] if parts else []
    line = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    digest = xxhash.xxh64_intdigest
    return [digest(line[i:j], SEED) for i, j in zip(begins[: 1 - words].tolist(), ends[words - 1 :].tolist())]


def fingerprints(texts: list[bytes | None], words: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints: a bit is set if it is set in over half of the shingle hashes; 0 without words."""
    out = np.zeros(len(texts), dtype=np.uint64)
    for i, raw in enumerate(texts):
        hashes = shingle_hashes(raw or b"", words)
        if not hashes:
            continue
        set_in = np.zeros(64, dtype=np.int64)
        for k in range(0, len(hashes), 1 << 16):  # a very long text is counted piece by piece
            part = np.array(hashes[k : k + (1 << 16)], dtype="<u8")
            set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out


def _fingerprint_column(text: Column, words: int) -> Column:
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(fingerprints([None if t is None else t for t in texts], words).view(np.int64))

    return run(F.encode(text, "utf-8"))


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """Masks such that any set of at most ``radius`` bits is missed by at least one of them.

    Each bit gets a non-zero vector of ``radius + 1`` binary digits; the mask of a vector v holds the bits whose vectors
    have an odd product with v. At most ``radius`` vectors leave some v at an even product with all of them.
    """
    size = (1 << (radius + 1)) - 1
    vector = [1 + i % size for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, size + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _tree(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links within ``radius`` connect: a search from each unseen member, not all pairs."""
    left = members
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    while left.size:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            here = queue.pop()
            near = np.bitwise_count(left ^ here) <= radius
            if near.any():
                found = left[near]
                a.append(found)
                b.append(np.full(found.size, here, dtype=np.uint64))
                queue.extend(found)
                left = left[~near]
    none = np.zeros(0, dtype=np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


LINKS = "a long, b long, t int, bucket long"


def _bucket_links(radius: int, block: int):
    """Walks through buckets in order: edges of those up to ``block`` members; members of larger ones, for later."""

    def rows(a: np.ndarray, b: np.ndarray | None, t: int, bucket: int) -> pa.RecordBatch:
        n = a.size
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a.view(np.int64)),
                pa.nulls(n, pa.int64()) if b is None else pa.array(b.view(np.int64)),
                pa.array(np.full(n, t, dtype=np.int32)),
                pa.array(np.full(n, bucket, dtype=np.int64)),
            ],
            names=["a", "b", "t", "bucket"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, put_off = None, np.zeros(0, dtype=np.uint64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch.column(0).to_numpy(zero_copy_only=False)
            bucket = batch.column(1).to_numpy(zero_copy_only=False)
            prints = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = np.flatnonzero((t[1:] != t[:-1]) | (bucket[1:] != bucket[:-1])) + 1
            begins, ends = np.append(0, cuts), np.append(cuts, t.size)
            # only buckets of several members, and those at the edges of the batch, are looked at one by one
            several = np.flatnonzero((ends - begins > 1) | (begins == 0) | (ends == t.size))
            for s in several.tolist():
                lo, hi = begins[s], ends[s]
                now = (int(t[lo]), int(bucket[lo]))
                if now != key:
                    if key is not None and held.size > 1 and not put_off:
                        a, b = _tree(held, radius)
                        if a.size:
                            yield rows(a, b, *key)
                    elif held.size and put_off:
                        yield rows(held, None, *key)
                    key, held, put_off = now, prints[lo:hi], False
                else:
                    held = np.concatenate([held, prints[lo:hi]])
                if held.size > block or put_off:
                    put_off = True
                    yield rows(held, None, *key)
                    held = held[:0]
        if key is not None and held.size > 1 and not put_off:
            a, b = _tree(held, radius)
            if a.size:
                yield rows(a, b, *key)

    return run


def links(classes: DataFrame, *, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) that connect all that links of ``radius`` connect."""
    tables = F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("bucket"))
        for t, m in enumerate(covering_masks(radius))
    ])
    members = classes.select("fp", F.explode(tables).alias("x")).select("x.t", "x.bucket", "fp")
    walked = members.repartition("t", "bucket").sortWithinPartitions("t", "bucket").mapInArrow(_bucket_links(radius, block), LINKS)
    walked = stored(walked, "links")
    large = walked.filter("b IS NULL").select("t", "bucket", F.col("a").alias("fp"))
    blocks = large.groupBy("t", "bucket").agg(F.ceil(F.count("*") / (block // 4)).cast("int").alias("n"))
    cut = large.join(blocks, ["t", "bucket"]).withColumn("i", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    # each pair of blocks is one unit of work: a member goes to every unit that its block takes part in
    units = cut.select("t", "bucket", "fp", "i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j")).select(
        "t", F.xxhash64("bucket", F.least("i", "j"), F.greatest("i", "j")).alias("bucket"), "fp"
    )
    units = units.repartition("t", "bucket").sortWithinPartitions("t", "bucket")
    pairs = units.mapInArrow(_bucket_links(radius, 1 << 62), LINKS)
    return walked.filter("b IS NOT NULL").select("a", "b").unionByName(pairs.select("a", "b"))


def simhash_groups(docs: DataFrame, *, words: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row key, ``doc_id``, ``fp`` (64 bits as a long), ``root`` (names the group), ``component_id``.

    Documents link if their fingerprints differ in at most ``radius`` bits. Equal fingerprints are one node, so copies
    are never compared with each other. ``component_id`` is the smallest id that can be reached (null ids only if there is
    no other). Null and empty texts have the fingerprint zero and link like any other. Repeated rows come back as often
    as they stand; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    rows = stored(
        rows.select("doc_id", row_key("doc_id", "text")["__k1"].alias("__k1"), row_key("doc_id", "text")["__k2"].alias("__k2"),
                    _fingerprint_column(F.col("text"), words).alias("fp")),
        "fingerprints",
    )
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes, radius=radius))
    tied = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(tied.join(least, "root").select("fp", "root", "component_id"), "fp").select("__k1", "__k2", "doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, *, words: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, that of the smallest id, with the columns of ``docs``; a group without any id keeps one row."""
    groups = simhash_groups(docs, words=words, radius=radius, id_col=id_col, text_col=text_col)
    firsts = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    one = firsts.groupBy("root").agg(F.min(F.struct("__k1", "__k2")).alias("k")).select("k.*", F.lit(True).alias("keep"))
    marked = groups.groupBy("__k1", "__k2").agg(F.count("*").alias("n")).join(one, ["__k1", "__k2"], "left")
    return kept_rows(docs, marked.withColumn("keep", F.coalesce("keep", F.lit(False))), id_col, text_col)
