"""Interaction of document filters: which filter removes what under every order of them, by min-plus removal ranks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfspark.llm.common import stored

FILTERS = "ABCDE"
#: Cost of a filter that a document passes: larger than any position, so it never is the minimum.
NEVER = 99

# Fixed values of the filters A to D: least words, least share of distinct words, largest share of capitals, marks.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, MARKS = 200, 50, 3, "[#$%&*|]"
BLANKS = r"[\x20\x09-\x0D]+"


def failures(text: Column) -> Column:
    """Bits 0 to 3 for filters A to D, of a text without nulls: 1 where the text fails."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = [
        n < LEAST_WORDS,
        F.lit(100) * distinct < F.lit(DISTINCT_PERCENT) * n,
        F.lit(100).cast("long") * capitals > F.lit(CAPITAL_PERCENT).cast("long") * F.length(text),
        text.rlike(MARKS),
    ]
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(failed)), F.lit(0))


def masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per document: id, ``part``, ``mask`` with the bits of all five filters.

    Texts are read once, into a table of small rows; copies are found on digests of the whole texts. The first of equal
    texts is looked up by digest and id together, so the rows of a text that fills a third of the table spread by their
    ids. A null id is larger than any; among rows with a copy's smallest id none fails E.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = stored(
        rows.select("doc_id", "part", failures(F.col("text")).alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "filter-masks"
    )
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first")).withColumnRenamed("digest", "of")
    mine = (F.col("digest") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first"))
    copy = F.when(F.col("of").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return rows.join(firsts, mine, "left").select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def mask_counts(found: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Documents, good and toxic ones per part and mask: at most 32 rows per part. A document is good if any of its labels says so."""
    said = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    joined = found.join(said, "doc_id", "left")
    return joined.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0).cast("long"))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0).cast("long"))).alias("toxic"),
    )


def removal_steps(n_filters: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders, and for each order and mask the step (from 0) that removes such documents; ``n_filters`` for none.

    The matrix of masks holds 0 where a mask has a filter and ``NEVER`` elsewhere; the matrix of positions is the inverse
    of each order. Their min-plus product is the smallest position of a filter in the mask.
    """
    orders = list(permutations(range(n_filters)))
    position = np.argsort(np.array(orders).reshape(len(orders), n_filters), axis=1)  # order x filter
    bits = np.arange(1 << n_filters)[:, None] >> np.arange(n_filters) & 1
    cost = np.where(bits == 1, 0, NEVER)  # mask x filter
    return orders, np.minimum((position[:, None, :] + cost[None, :, :]).min(axis=2), n_filters)


def audit_rows(weights: np.ndarray, n_filters: int) -> dict[str, np.ndarray]:
    """Counts of one part for all orders and steps, from the weights (documents, good, toxic) x mask."""
    orders, step_of = removal_steps(n_filters)
    filters = np.array(orders)
    n_masks = 1 << n_filters
    removed = np.zeros((3, len(orders), n_filters + 1), dtype=np.int64)
    at = np.broadcast_to(np.arange(len(orders))[:, None], step_of.shape)
    for i in range(3):
        np.add.at(removed[i], (at, step_of), np.broadcast_to(weights[i], step_of.shape))
    removed = removed[:, :, :n_filters]
    bits = np.arange(n_masks)[:, None] >> np.arange(n_filters) & 1
    failing = (weights[0][:, None] * bits).sum(axis=0)  # per filter
    alone = weights[0][1 << np.arange(n_filters)]
    shapley = np.zeros(n_filters, dtype=np.int64)
    np.add.at(shapley, filters, removed[0])
    return {
        "filters": filters, "kept": weights[0].sum() - removed[0].cumsum(axis=1), "removed": removed[0],
        "redundant": failing[filters] - removed[0], "unique_fails": alone[filters], "good_lost": removed[1],
        "toxic_lost": removed[2], "shapley": shapley[filters],
    }


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def interactions(counts: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order and step from the counts by mask; parts spread over the tasks, 32 rows each."""
    one = F.struct("mask", "n", "good", "toxic")
    parts = counts.groupBy("part").agg(F.collect_list(one).alias("masks"))
    names = np.array(list(filters))

    def audited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, found in zip(batch["part"], batch["masks"]):
                weights = np.zeros((3, 1 << len(names)), dtype=np.int64)
                for m in found:
                    weights[:, m["mask"]] += (m["n"], m["good"], m["toxic"])
                out = audit_rows(weights, len(names))
                n_orders, n_steps = out["filters"].shape
                order = ["".join(names[o]) for o in out["filters"]]
                yield pd.DataFrame({
                    "part": part, "filter_order": np.repeat(order, n_steps), "step": np.tile(np.arange(1, n_steps + 1), n_orders),
                    **{c: out[c].reshape(-1) for c in COUNTS},
                })

    return parts.mapInPandas(audited, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def filter_audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part (value of ``lang``, null as empty), order of the five filters and step, zeros included.

    ``kept`` documents after the step, ``removed`` at it, ``redundant`` (failing this filter but removed before),
    ``unique_fails`` (failing no other), ``good_lost`` and ``toxic_lost`` among the removed, and ``shapley``, what the
    filter removes summed over all orders.

    Null text is empty; null ids have no labels; repeated rows count each; a repeated label counts once; very long texts
    are handled whole; an empty table gives no rows. Other columns are ignored.
    """
    return interactions(mask_counts(masks(docs, **columns), labels))
