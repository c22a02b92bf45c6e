"""Benchmark passages in documents: CGK walks turn edits into differing positions, sampled positions are hashed, hits verified.

A passage of n words is looked for within ``edit_share`` of n word edits. Item-sized windows of a document and the items
are cut into pieces of a fixed number of words. A random walk copies a piece into a longer string: at each step it writes
the word it stands on, and a random bit that depends on step and word tells whether it moves on. Two pieces that differ
in few edits fall into step again soon, so their walks agree in most places. Each repetition has its own bits and samples
a few steps; a piece whose sampled words equal those of an item's piece is a candidate. The number of repetitions follows
from the target recall, by trying edits on the items themselves. Candidates are checked by exact edit distance.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfspark.llm.common import column, row_key, stored, whole_row

EDIT_SHARE = 0.15
RECALL = 0.97
SAMPLES = 4
PIECE_WORDS = 12
#: Repetitions after which items of a size are cut by the number of their edits and looked up exactly instead.
MOST_ROUNDS = 24
#: Items that may share a piece before it is left to items without another one.
COMMON = 8
#: Candidates that are held at a time before they are checked.
CANDIDATES = 1 << 19
#: Bits of the set of words by which a region is compared with an item before their distance is worked out.
BAG_BITS = 1 << 10
#: Items whose index one pass over the documents carries, and the characters they may have in all.
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16 << 20
CHUNK = 1 << 20
PAD = 16
SEED = 5

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Names of characters of scripts that are written without blanks begin so.
UNSPACED = ("CJK UNIFIED", "CJK COMPAT", "HIRAGANA", "KATAKANA", "THAI", "LAO", "KHMER", "MYANMAR")


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Of each code point: 0 stands between words, 1 in a word, 2 is a word."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] in "LNM":
            out[c] = 2 if c > 0x7F and unicodedata.name(chr(c), "").startswith(UNSPACED) else 1
    return out


@lru_cache(1)
def _powers(digits: int) -> np.ndarray:
    out = np.full(1 << digits, _P, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, first character) of each word of a lower-case text: runs of letters, digits and marks, or one unspaced character."""
    data = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _kinds()[data]
    inside = np.flatnonzero(kinds)
    if not inside.size:
        return np.zeros(0, dtype=np.uint64), inside
    starts = kinds == 2
    starts[1:] |= (kinds[1:] == 1) & (kinds[:-1] != 1)
    starts[0] |= kinds[0] == 1
    first = np.flatnonzero(starts[inside])
    sizes = np.diff(np.append(first, inside.size))
    place = np.arange(inside.size) - np.repeat(first, sizes)
    up = _powers(max(8, int(sizes.max()).bit_length()))
    value = np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * up[place], first)
    value = (value ^ (value >> np.uint64(29))) * _MIX
    return (value ^ (value >> np.uint64(32))) | np.uint64(1), inside[first]


# ---- the index of a block of items ----------------------------------------------------------------------------------


@dataclass
class Round:
    """One repetition for pieces of one size: bits of the walk, sampled steps, and the keys of the items' pieces."""

    size: int
    bits: np.ndarray  # step x low byte of the word -> 0 or 1
    steps: list[int]
    maps: list[np.ndarray]  # after each sampled step: which hashed keys are still those of some piece
    keys: np.ndarray  # sorted
    piece: np.ndarray  # piece of each key


@dataclass
class Index:
    ids: list[list]  # the ids of each distinct item
    tokens: list[np.ndarray]
    limits: np.ndarray  # edits allowed
    pieces: np.ndarray  # (item, first word) of each piece
    rounds: list[Round]
    longest: int

    @property
    def reach(self) -> int:
        """Words of a document that a match may take."""
        return self.longest + int(self.limits.max(initial=0)) + 1


MAP_BITS = 16


def _mixed(key: np.ndarray, token: np.ndarray) -> np.ndarray:
    key = (key ^ token) * _MIX
    return key ^ (key >> np.uint64(31))


def _walk(tokens: np.ndarray, low: np.ndarray, at: np.ndarray, r: Round, prune: bool) -> tuple[np.ndarray, np.ndarray]:
    """Walks from all places ``at``; (places, keys) of those whose sampled words still fit an item's piece."""
    starts, here = at, at.copy()
    key = np.zeros(at.size, dtype=np.uint64)
    done = 0
    for n, step in enumerate(r.steps):
        while done < step:
            here += r.bits[done][low[here]]
            done += 1
        key = _mixed(key, tokens[here])
        if prune:
            live = r.maps[n][(key >> np.uint64(64 - MAP_BITS)).astype(np.intp)]
            starts, here, key = starts[live], here[live], key[live]
    return starts, key


def _sizes(n: int, piece: int) -> int:
    """The piece size for an item of n words: the largest of piece, piece/2, ... that fits."""
    size = piece
    while size > n:
        size //= 2
    return max(1, size)


def _round(size: int, exact: bool, samples: int, rng: np.random.Generator) -> Round:
    if exact:
        return Round(size, np.ones((size, 256), dtype=np.int64), list(range(size)), [], np.zeros(0), np.zeros(0))
    length = max(samples, int(1.6 * size))
    cuts = np.linspace(0, length, samples + 1)
    steps = [int(rng.integers(int(cuts[k]), max(int(cuts[k]) + 1, int(cuts[k + 1])))) for k in range(samples)]
    return Round(size, rng.integers(0, 2, (length, 256)), sorted(set(steps)), [], np.zeros(0), np.zeros(0))


def _edited(tokens: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    out = tokens.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(out)))
        new = int(rng.integers(1, 1 << 62))
        if kind == 0:
            out[at] = new
        elif kind == 1:
            out.insert(at, new)
        elif len(out) > 1:
            del out[at]
    return np.array(out, dtype=np.uint64)


def _keyed(r: Round, tokens: list[np.ndarray], pieces: np.ndarray) -> np.ndarray:
    """The key of each piece in one repetition."""
    out = np.zeros(len(pieces), dtype=np.uint64)
    flat = np.concatenate([np.append(t, np.zeros(2 * r.size + PAD, dtype=np.uint64)) for t in tokens])
    base = np.cumsum([0] + [t.size + 2 * r.size + PAD for t in tokens[:-1]])
    at = base[pieces[:, 0]] + pieces[:, 1]
    _, out = _walk(flat, (flat & np.uint64(255)).astype(np.intp), at, r, False)
    return out


def _own_pieces(tokens: list[np.ndarray], pieces: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which pieces look for their item: those that few items share, or the least shared one of an item that has no other."""
    names = [hash(tokens[i][at : at + sizes[i]].tobytes()) for i, at in pieces.tolist()]
    holders: dict[int, set[int]] = {}
    for name, (i, _) in zip(names, pieces.tolist(), strict=True):
        holders.setdefault(name, set()).add(i)
    shared = np.array([len(holders[n]) for n in names], dtype=np.int64)
    least = np.full(len(tokens), np.iinfo(np.int64).max)
    np.minimum.at(least, pieces[:, 0], shared)
    return shared <= np.maximum(COMMON, least[pieces[:, 0]])


def _exact_cuts(n: int, edits: int, own: np.ndarray) -> list[tuple[int, int]]:
    """(first word, size) of ``edits + 1`` pieces of an item that do not overlap: ``edits`` edits leave one of them whole.

    They are cut from the words of its own if there are enough, so that a shared prompt is not looked for.
    """
    runs = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
    for begins, ends in ((runs[0::2], runs[1::2]), (np.array([0]), np.array([n]))):
        size = int((ends - begins).sum()) // (edits + 1)
        while size:
            cuts = [(int(b) + k * size, size) for b, e in zip(begins, ends) for k in range((int(e) - int(b)) // size)]
            if len(cuts) > edits:
                return cuts[: edits + 1]
            size -= 1
    return [(at, 1) for at in range(n)]


def build(items: list[tuple], *, edit_share: float, recall: float, samples: int, piece: int) -> Index:
    """The index of (id, text) items; items without a word are left out, they match nothing. Equal items are one."""
    named: dict[bytes, tuple[list, np.ndarray]] = {}
    for item_id, text in items:
        t, _ = words((text or "").lower())
        if t.size:
            named.setdefault(t.tobytes(), ([], t))[0].append(item_id)
    ids, tokens = [x for x, _ in named.values()], [t for _, t in named.values()]
    limits = np.array([int(edit_share * t.size) for t in tokens], dtype=np.int64)
    size = np.array([t.size if limits[i] == 0 and t.size < piece else _sizes(t.size, piece) for i, t in enumerate(tokens)], dtype=np.int64)
    cut = [(i, at) for i, t in enumerate(tokens) for at in sorted({*range(0, t.size - size[i] + 1, int(size[i])), t.size - int(size[i])})]
    pieces = np.array(cut, dtype=np.int64).reshape(-1, 2)
    if len(pieces):
        pieces = pieces[_own_pieces(tokens, pieces, size)]
    rng = np.random.default_rng(SEED)
    rounds: list[Round] = []

    def add(s: int, exact: bool, mine: np.ndarray) -> None:
        r = _round(s, exact, min(samples, s), rng)
        keys = _keyed(r, tokens, pieces[mine])
        order = np.argsort(keys, kind="stable")
        r.keys, r.piece = keys[order], mine[order]
        _fill_maps(r, tokens, pieces[mine])
        rounds.append(r)

    exact_cuts: dict[int, list[tuple[int, int]]] = {}
    for s, exact in sorted({(int(size[i]), bool(limits[i] == 0)) for i in range(len(tokens))}):
        of = np.flatnonzero((size == s) & ((limits == 0) == exact))
        mine = np.flatnonzero(np.isin(pieces[:, 0], of))
        many = 1 if exact else _rounds_for(tokens, limits, pieces[mine], s, samples, recall, rng)
        if many is not None:
            for _ in range(many):
                add(s, exact, mine)
            continue
        for i in of.tolist():
            own = np.zeros(tokens[i].size, dtype=bool)
            for at in pieces[mine[pieces[mine, 0] == i], 1].tolist():
                own[at : at + s] = True
            for at, length in _exact_cuts(tokens[i].size, int(limits[i]), own):
                exact_cuts.setdefault(length, []).append((i, at))
    for length, cuts in sorted(exact_cuts.items()):
        more = np.arange(len(pieces), len(pieces) + len(cuts))
        pieces = np.concatenate([pieces, np.array(cuts, dtype=np.int64)])
        add(length, True, more)
    return Index(ids, tokens, limits, pieces, rounds, max((t.size for t in tokens), default=0))


def _fill_maps(r: Round, tokens: list[np.ndarray], pieces: np.ndarray) -> None:
    for n in range(1, len(r.steps) + 1):
        part = Round(r.size, r.bits, r.steps[:n], [], r.keys, r.piece)
        seen = np.zeros(1 << MAP_BITS, dtype=bool)
        seen[(_keyed(part, tokens, pieces) >> np.uint64(64 - MAP_BITS)).astype(np.intp)] = True
        r.maps.append(seen)


def _rounds_for(
    tokens: list[np.ndarray], limits: np.ndarray, pieces: np.ndarray, size: int, samples: int, recall: float, rng: np.random.Generator
) -> int | None:
    """Repetitions after which an item with as many edits as allowed has collided with probability ``recall``, or None.

    Up to 300 of the items are edited at random and walked between other words, as a document would be, with one
    repetition after the other until that share of them has collided; one more is added, as the trial is a sample.
    ``pieces`` are those that look for the items. None says that ``MOST_ROUNDS`` repetitions are not enough.
    """
    tried = []
    for k in rng.permutation(np.unique(pieces[:, 0]))[:300]:
        around = rng.integers(1, 1 << 62, 2 * size + PAD + 8).astype(np.uint64)
        text = np.concatenate([around[:8], _edited(tokens[k], int(limits[k]), rng), around[8:]])
        firsts = pieces[pieces[:, 0] == k, 1]
        tried.append((tokens[k], np.column_stack([np.zeros(len(firsts), dtype=np.int64), firsts]), text, np.arange(max(1, text.size - 2 * size - PAD))))
    missed = tried
    for n in range(1, MOST_ROUNDS):
        r = _round(size, False, min(samples, size), rng)
        missed = [
            x for x in missed
            if not np.isin(_keyed(r, [x[0]], x[1]), _walk(x[2], (x[2] & np.uint64(255)).astype(np.intp), x[3], r, False)[1]).any()
        ]
        if len(missed) <= (1 - recall) * len(tried):
            return n + 1
    return None


# ---- looking through documents --------------------------------------------------------------------------------------


def edit_distances(pattern: np.ndarray, sizes: np.ndarray, region: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: the least edits that turn its pattern into some run of words of its region, and where that run ends.

    ``pattern`` rows are padded beyond ``sizes``; all rows go through the table of the dynamic program together.
    """
    count, width = region.shape
    ramp = np.arange(width + 1)
    row = np.zeros((count, width + 1), dtype=np.int32)
    best, end = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
    for i in range(int(sizes.max(initial=0))):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (region != pattern[:, i : i + 1]), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - ramp, axis=1) + ramp
        full = np.flatnonzero(sizes == i + 1)
        end[full] = row[full].argmin(axis=1)
        best[full] = row[full, end[full]]
    return best, end


CELLS = 1 << 22


def _bag_bit(tokens: np.ndarray) -> np.ndarray:
    """The bit of each word; 0 is the bit of what is no word."""
    return np.where(tokens == 0, 0, (tokens >> np.uint64(20)) % np.uint64(BAG_BITS - 1) + np.uint64(1)).astype(np.intp)


def _verified(index: Index, tokens: np.ndarray, item: np.ndarray, start: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(row, edits, end) of the candidates within the limit; lo and hi bound the document of each."""
    sizes = np.array([index.tokens[i].size for i in item], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < order.size:
        to = at + 1
        while to < order.size and (to - at) * sizes[order[to]] * 2 < CELLS // 16:
            to += 1
        rows = order[at:to]
        at = to
        n = sizes[rows]
        slack = index.limits[item[rows]]
        width = int((n + 2 * slack).max())
        first = start[rows] - slack
        where = first[:, None] + np.arange(width)
        inside = (where >= lo[rows][:, None]) & (where < np.minimum(hi[rows], first + n + 2 * slack)[:, None])
        region = np.where(inside, tokens[np.clip(where, 0, tokens.size - 1)], np.uint64(0))
        pattern = np.zeros((rows.size, int(n.max())), dtype=np.uint64)
        for k, i in enumerate(item[rows]):
            pattern[k, : index.tokens[i].size] = index.tokens[i]
        # each word of the item that is nowhere in the region takes an edit
        bag = np.zeros((rows.size, BAG_BITS), dtype=bool)
        np.put_along_axis(bag, _bag_bit(region), True, axis=1)
        bag[:, 0] = False
        absent = ((pattern != 0) & ~np.take_along_axis(bag, _bag_bit(pattern), axis=1)).sum(axis=1)
        near = absent <= slack
        rows, n, slack, first, region, pattern = rows[near], n[near], slack[near], first[near], region[near], pattern[near]
        if not rows.size:
            continue
        edits, end = edit_distances(pattern, n, region)
        good = edits <= slack
        yield rows[good], edits[good], first[good] + end[good]


def search(index: Index, texts: list[str]) -> list[tuple[int, int, int, int]]:
    """(text, item, edits, end word) of the best match of each item in each of some lower-case texts."""
    parts, begins, at = [], [], 0
    for raw in texts:
        t, _ = words(raw)
        parts += [t, np.zeros(PAD, dtype=np.uint64)]
        begins.append((at, at + t.size))
        at += t.size + PAD
    if not index.rounds or not at:
        return []
    most = max(r.bits.shape[0] for r in index.rounds)
    tokens = np.concatenate([*parts, np.zeros(most + PAD, dtype=np.uint64)])
    low = (tokens & np.uint64(255)).astype(np.intp)
    places = np.flatnonzero(tokens[:at])
    bounds = np.array(begins)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    held: list[np.ndarray] = []
    count = 0

    def check() -> None:
        nonlocal count
        if not held:
            return
        doc, item, start = np.unique(np.concatenate(held), axis=0).T
        held.clear()
        count = 0
        for rows, edits, end in _verified(index, tokens, item, start, bounds[doc, 0], bounds[doc, 1]):
            for d, i, e, x in zip(doc[rows].tolist(), item[rows].tolist(), edits.tolist(), end.tolist(), strict=True):
                now = (e, x - begins[d][0])
                if (d, i) not in best or now < best[d, i]:
                    best[d, i] = now

    for r in index.rounds:
        start, key = _walk(tokens, low, places, r, True)
        left, right = np.searchsorted(r.keys, key, "left"), np.searchsorted(r.keys, key, "right")
        many = right - left
        start, left, many = start[many > 0], left[many > 0], many[many > 0]
        upto = np.cumsum(many)
        at = 0
        while at < start.size:
            # so many places that their candidates fit what may be held; of a single place all
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CANDIDATES, "right")))
            take = many[at:to]
            hit = np.repeat(np.arange(at, to), take)
            # the pieces of a key lie side by side
            offset = np.arange(hit.size) - np.repeat(np.cumsum(take) - take, take)
            piece = index.pieces[r.piece[left[hit] + offset]]
            doc = np.searchsorted(bounds[:, 0], start[hit], "right") - 1
            held.append(np.column_stack([doc, piece[:, 0], start[hit] - piece[:, 1]]))
            count += hit.size
            at = to
            if count >= CANDIDATES:
                check()
    check()
    return [(d, i, e, x) for (d, i), (e, x) in sorted(best.items())]


def _cut(text: str, reach: int) -> Iterator[tuple[int, str]]:
    """(words before, piece) of a text; pieces of a long one overlap by ``reach`` words and begin at a word.

    A longer run of letters is not cut, and words with much between them make a longer overlap.
    """
    limit = CHUNK * 4
    kinds = _kinds()
    within = lambda p: p < len(text) and kinds[ord(text[p])] == 1 and kinds[ord(text[p - 1])] == 1
    at = before = 0
    while True:
        step = limit
        while step > limit // 4 and within(at + step):
            step -= 1
        while within(at + step):
            step += 1
        more = 16 * reach
        while at + step + more < len(text) and words(text[at + step : at + step + more])[0].size <= reach:
            more *= 2
        to = at + step + more
        yield before, text[at:to]
        if to >= len(text):
            return
        before += words(text[at : at + step])[0].size
        at += step


def _searched(index: Index, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            texts, owners, held = [], [], 0

            def flush():
                best: dict[tuple[int, int], tuple[int, int]] = {}
                for d, i, e, x in search(index, texts):
                    row, before = owners[d]
                    best[row, i] = min(best.get((row, i), (1 << 60, 0)), (e, before + x))
                rows.extend((row, i, e, x) for (row, i), (e, x) in best.items())
                texts.clear()
                owners.clear()

            for n, text in enumerate(batch.column(1).to_pylist()):
                for before, piece in _cut((text or "").lower(), index.reach):
                    texts.append(piece)
                    owners.append((n, before))
                    held += len(piece)
                    if held > CHUNK:
                        flush()
                        held = 0
            flush()
            best: dict[tuple[int, int], tuple[int, int]] = {}
            for row, i, e, x in rows:
                best[row, i] = min(best.get((row, i), (1 << 60, 0)), (e, x))
            # a row for each of the equal items
            each = [(row, i, name, e, x) for (row, i), (e, x) in best.items() for name in index.ids[i]]
            at = pa.array([x[0] for x in each], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array([x[2] for x in each], id_type),
                    pa.array([x[3] for x in each], pa.int64()),
                    pa.array([index.tokens[x[1]].size for x in each], pa.int64()),
                    pa.array([x[4] for x in each], pa.int64()),
                    *[batch.column(c).take(at) for c in range(2, batch.num_columns)],
                ],
                names=["doc_id", "item_id", "edits", "item_words", "end_word", *batch.schema.names[2:]],
            )

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    edit_share: float = EDIT_SHARE, recall: float = RECALL, samples: int = SAMPLES, piece: int = PIECE_WORDS,
    block_items: int = BLOCK_ITEMS, keys: bool = False,
) -> DataFrame:
    """One row per document row and item found in it: ids, ``edits``, ``item_words``, ``end_word``; the best place counts.

    The index of at most ``block_items`` items goes to every task; a larger benchmark is looked for block by block, each
    with a pass over the documents. Whole texts are read where they lie and nothing is shuffled, so passages that many
    documents share and hot sources cost what their rows cost. Case and everything between words do not count. Null or
    empty texts and items match nothing; an item shorter than ``1 / edit_share`` words is found exactly. Repeated
    documents and items give repeated rows (items by id); empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(column(item_col).alias("id"), column(text_col).alias("text")).filter("text IS NOT NULL")
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-chars // BLOCK_CHARS))
    rows = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"), *[v.alias(k) for k, v in (row_key(id_col, text_col) if keys else {}).items()])
    kind = benchmark.select(column(item_col)).schema.fields[0].dataType
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("item_id", kind),
        *[T.StructField(c, T.LongType()) for c in ("edits", "item_words", "end_word")],
        *[f for f in rows.schema.fields if f.name.startswith("__")],
    ])
    out = spark.createDataFrame([], schema)
    for b in range(blocks):
        of_block = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        index = build([tuple(r) for r in of_block.collect()], edit_share=edit_share, recall=recall, samples=samples, piece=piece)
        found = rows.mapInArrow(_searched(index, to_arrow_type(kind)), schema)
        out = found if b == 0 else out.unionByName(found)
    return out


def clean_rows(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their own columns."""
    found = stored(contaminated(docs, benchmark, id_col=id_col, text_col=text_col, keys=True, **options).select("__k1", "__k2").distinct(), "leaks")
    keys = [c.alias(k) for k, c in row_key(id_col, text_col).items()]
    return docs.select(whole_row(docs), *keys).join(found, ["__k1", "__k2"], "left_anti").select("row.*")
