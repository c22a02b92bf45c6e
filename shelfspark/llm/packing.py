"""Sequences for training: pieces of documents go into bins of several permitted lengths by best fit."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfspark.llm.common import column, stored

CAPACITIES = (512, 1024, 2048, 4096)
#: What a bin costs besides its capacity, in tokens.
BIN_COST = 32
#: Pieces that one task packs together; a larger task packs one such group after the other.
GROUP = 1 << 14


def token_count(text: Column) -> Column:
    """Words and single marks of a text, and one for its end; null counts as empty."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")) + 1).cast("long")


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None, most: int = CAPACITIES[-1]) -> DataFrame:
    """(``doc_id``, ``piece``, ``begin``, ``tokens``): documents cut where they are longer than the largest bin.

    ``length`` is the number of tokens of a row (at least one is taken); by default :func:`token_count`.
    """
    n = F.greatest(F.coalesce(length if length is not None else token_count(column(text_col)), F.lit(1)).cast("long"), F.lit(1).cast("long"))
    rows = docs.select(column(id_col).alias("doc_id"), n.alias("n"))
    rows = rows.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most))).alias("piece"))
    begin = F.col("piece") * most
    return rows.select("doc_id", "piece", begin.alias("begin"), F.least(F.col("n") - begin, F.lit(most).cast("long")).alias("tokens"))


Offsets = Callable[[str], Sequence[tuple[int, int]]]

#: The tokens of :func:`token_count`, for Python.
TOKEN = regex.compile(r"[\p{L}\p{N}]+|[^ \t\n\x0b\f\r\p{L}\p{N}]")


def word_offsets(text: str) -> list[tuple[int, int]]:
    """(first code point, end) of each word and mark."""
    return [m.span() for m in TOKEN.finditer(text)]


def text_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", offsets: Offsets = word_offsets, most: int = CAPACITIES[-1]) -> DataFrame:
    """:func:`pieces` with the code points ``first`` to ``last`` (exclusive) of each piece, whether it ``ends`` its text, and its ``text``.

    ``offsets`` gives the places of the tokens of a text and runs in the tasks; a tokeniser's own fits, and what it needs
    goes there with it. The pieces of a text join to the whole of it, blanks between tokens included. The last piece has
    one token more, the end mark.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.select(column(id_col)).schema.fields[0].dataType),
        *[T.StructField(n, T.LongType()) for n in ("piece", "begin", "tokens", "first", "last")],
        T.StructField("ends", T.BooleanType()), T.StructField("text", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for n, text in enumerate(batch.column(1).to_pylist()):
                text = text or ""
                places = offsets(text)
                total = len(places) + 1
                for piece, begin in enumerate(range(0, total, most)):
                    end = min(begin + most, total)
                    # what stands before the first token belongs to the first piece, what follows a token to its own
                    first = 0 if not begin else places[begin][0] if begin < len(places) else len(text)
                    last = places[end][0] if end < len(places) else len(text)
                    at.append(n)
                    rows.append((piece, begin, end - begin, first, last, end == total, text[first:last]))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.string()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=schema.fieldNames())

    return docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text")).mapInArrow(run, schema)


def sequences(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", offsets: Offsets = word_offsets, end_mark: str = "\n", **options
) -> DataFrame:
    """One row per bin: ``bin_id``, ``capacity``, ``bin_tokens``, ``text`` and the ``parts`` it is joined from.

    Pieces stand by their offsets, each end of a document is followed by ``end_mark``. ``parts`` names for each piece the
    document, its code points and its offset in the bin. A bin holds at most the largest capacity in tokens, so its row is
    bounded; texts move once to be packed and once to meet in their bin. Null and empty texts, repeated rows and empty
    tables are treated as in :func:`pack_documents`.
    """
    most = max(options.get("capacities", CAPACITIES))
    whole = text_pieces(docs, id_col=id_col, text_col=text_col, offsets=offsets, most=most)
    rows = packed(whole, **options)
    part = F.struct("bin_offset", "doc_id", "piece", "first", "last", "tokens", "ends", "text")
    joined = rows.groupBy("bin_id").agg(
        F.max("capacity").alias("capacity"), F.max("bin_tokens").alias("bin_tokens"), F.array_sort(F.collect_list(part)).alias("p")
    )
    ends = lambda x: F.when(x["ends"], F.lit(end_mark)).otherwise(F.lit(""))
    return joined.select(
        "bin_id", "capacity", "bin_tokens",
        F.array_join(F.transform("p", lambda x: F.concat(x["text"], ends(x))), "").alias("text"),
        F.transform("p", lambda x: F.struct(*[x[c].alias(c) for c in ("doc_id", "piece", "first", "last", "bin_offset", "tokens")])).alias("parts"),
    )


def best_fit(sizes: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, bin_cost: float = BIN_COST) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin of each piece, its offset there, final capacity of each bin); no piece may be larger than the last capacity.

    Pieces go from long to short into the open bin with the least room that still holds them. Where none does, a bin is
    opened of the capacity that costs least for each token it can still get: the price of a capacity over what the piece
    and the shorter ones still to come can fill of it. So long bins are opened while there is enough to fill them, and
    short ones at the end. Last, each bin shrinks to the least capacity that holds its contents.
    """
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order]
    to_come = np.append(np.cumsum(falling[::-1])[::-1], 0).tolist()  # tokens from each place on
    rising = falling[::-1].tolist()
    total = len(rising)
    bins, offsets = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
    content: list[int] = []
    room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a bin with room r is open
    opened: list[int] = []
    for k, size in enumerate(falling.tolist()):
        fits = rooms >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                rooms ^= 1 << r
        else:
            best = None
            for cap in capacities:
                if cap >= size:
                    # pieces not longer than the room that would be left, among those still to come
                    first = max(k + 1, total - bisect_right(rising, cap - size))
                    price = (cap + bin_cost) / min(cap, size + to_come[first])
                    if best is None or price < best[0]:
                        best = (price, cap)
            b, r = len(content), best[1]
            content.append(0)
            opened.append(r)
        at = order[k]
        bins[at], offsets[at] = b, content[b]
        content[b] += size
        r -= size
        if r:
            room.setdefault(r, []).append(b)
            rooms |= 1 << r
    return bins, offsets, [next(c for c in capacities if c >= used) for used in content]


def packed(
    rows: DataFrame, *, capacities: tuple[int, ...] = CAPACITIES, bin_cost: float = BIN_COST, group: int = GROUP
) -> DataFrame:
    """Rows of :func:`pieces` with ``bin_id``, ``bin_offset``, ``capacity`` and ``bin_tokens``.

    Pieces are dealt evenly to tasks, whatever their ids and lengths are, so no value is hot; each task packs groups of a
    fixed size. What groups lose against one large group is less than a bin of each capacity per group.
    """
    capacities = tuple(sorted(capacities))
    rows = stored(rows, "pieces")
    parts = max(1, -(-rows.count() // group))
    names = ["bin_id", "bin_offset", "capacity", "bin_tokens"]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, T.LongType()) for n in names]])
    at_tokens = rows.columns.index("tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 36
        held: list[pa.RecordBatch] = []
        count = 0

        def pack() -> pa.RecordBatch:
            nonlocal first
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bins, offsets, caps = best_fit(batch.column(at_tokens).to_numpy(), capacities, bin_cost)
            used = np.bincount(bins, weights=batch.column(at_tokens).to_numpy()).astype(np.int64)
            new = [bins + first, offsets, np.array(caps)[bins], used[bins]]
            first += len(caps)
            return pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x, pa.int64()) for x in new]], names=schema.fieldNames())

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, group - count)
                held.append(part)
                count += part.num_rows
                batch = batch.slice(part.num_rows)
                if count == group:
                    yield pack()
                    held, count = [], 0
        if count:
            yield pack()

    return rows.repartition(parts).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None, **options) -> DataFrame:
    """One row per piece of each row of ``docs``: where it stands in which bin, and what the bin holds.

    Every document is packed whole; null and empty texts are a single end mark. Repeated rows are packed as often as they
    stand. An empty table gives no rows; other columns are ignored.
    """
    most = max(options.get("capacities", CAPACITIES))
    return packed(pieces(docs, id_col=id_col, text_col=text_col, length=length, most=most), **options)
