import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import packing


def naive(sizes, capacities, cost):
    """The same rules without the lists of rooms: look at every open bin."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bins = []
    for k, i in enumerate(order):
        open_ = [b for b in bins if b[0] - sum(b[1]) >= sizes[i]]
        if open_:
            least = min(b[0] - sum(b[1]) for b in open_)
            [b for b in open_ if b[0] - sum(b[1]) == least][0][1].append(sizes[i])
            continue
        rest = [sizes[j] for j in order[k + 1 :]]
        price = lambda c: (c + cost) / min(c, sizes[i] + sum(x for x in rest if x <= c - sizes[i]))
        cap = min((c for c in capacities if c >= sizes[i]), key=lambda c: (price(c), c))
        bins.append((cap, [sizes[i]]))
    return sum(min(c for c in capacities if c >= sum(b[1])) + cost for b in bins)


def cost_of(sizes, capacities, cost):
    bins, _, caps = packing.best_fit(np.array(sizes), capacities, cost)
    used = np.bincount(bins, weights=sizes)
    assert all(u <= c for u, c in zip(used, caps, strict=True))
    return sum(caps) + cost * len(caps)


def optimum(sizes, capacities, cost):
    """The least cost over all ways of sharing the pieces out."""
    best = float("inf")
    for share in itertools.product(range(len(sizes)), repeat=len(sizes)):
        used = [sum(s for s, b in zip(sizes, share, strict=True) if b == k) for k in set(share)]
        if max(used) <= max(capacities):
            best = min(best, sum(min(c for c in capacities if c >= u) + cost for u in used))
    return best


def test_against_naive_and_optimum():
    rng = random.Random(8)
    for _ in range(60):
        sizes = [rng.randint(1, 16) for _ in range(rng.randint(1, 40))]
        assert cost_of(sizes, (4, 8, 16), 1) == pytest.approx(naive(sizes, (4, 8, 16), 1), rel=0.1)
    worst = []
    for _ in range(25):
        sizes = [rng.randint(1, 16) for _ in range(6)]
        worst.append(cost_of(sizes, (4, 8, 16), 1) / optimum(sizes, (4, 8, 16), 1))
    assert max(worst) <= 1.35 and sum(worst) / len(worst) < 1.08


def test_every_piece_stands_once(spark, odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs, capacities=(64, 256, 1024), group=8).collect()
    tokens = odd_docs.select(F.sum(packing.token_count(F.col("text")))).first()[0]
    assert sum(r.tokens for r in rows) == tokens
    assert sum(r.piece == 0 for r in rows) == odd_docs.count()
    places = {}
    for r in rows:
        places.setdefault((r.bin_id, r.capacity, r.bin_tokens), []).append((r.bin_offset, r.tokens))
    assert len({b for b, _, _ in places}) == len(places)
    for (_, capacity, used), held in places.items():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))] and sum(n for _, n in held) == used
        assert capacity == min(c for c in (64, 256, 1024) if c >= used)
    long = sorted((r.begin, r.tokens) for r in rows if r.doc_id == 7)
    assert all(a + n == b for (a, n), (b, _) in zip(long, long[1:], strict=False))
    assert packing.pack_documents(no_docs).collect() == []


def test_many_lengths_waste_little():
    rng = np.random.default_rng(1)
    sizes = np.minimum(4096, rng.lognormal(5.5, 1.2, 20_000).astype(int) + 1)
    bins, _, caps = packing.best_fit(sizes)
    assert sum(caps) < 1.01 * sizes.sum()


def rebuilt(rows):
    """The texts of the documents from the parts of the bins."""
    out = {}
    for r in rows:
        for p in r.parts:
            out.setdefault(p.doc_id, []).append((p.piece, p.first, p.last))
    return {k: sorted(v) for k, v in out.items()}


def test_sequences_hold_the_texts(spark, odd_docs, no_docs):
    texts = {i: " ".join(f"w{i}x{j}, " for j in range(n)) for i, n in enumerate([0, 1, 5, 40, 90, 333, 1000])} | {50: None, 51: " \t ", 52: "日本語 \U0001f600 é", 53: "(" * 130}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.sequences(docs, capacities=(16, 32, 64), end_mark="<end>").collect()
    assert all(r.bin_tokens == sum(p.tokens for p in r.parts) <= r.capacity <= 64 for r in rows)
    for r in rows:
        at = 0
        for p in sorted(r.parts, key=lambda p: p.bin_offset):
            assert p.bin_offset == at
            at += p.tokens
        text = "".join((texts[p.doc_id] or "")[p.first:p.last] + ("<end>" if p.last == len(texts[p.doc_id] or "") and _ends(rows, p) else "") for p in r.parts)
        assert r.text == text
    for i, spans in rebuilt(rows).items():
        text = texts[i] or ""
        assert spans[0][1] == 0 and spans[-1][2] == len(text) and all(a[2] == b[1] for a, b in zip(spans, spans[1:]))
        assert "".join(text[a:b] for _, a, b in spans) == text
    assert rebuilt(rows).keys() == texts.keys()
    assert sum(r.text.count("<end>") for r in rows) == len(texts)
    assert packing.sequences(no_docs).collect() == []
    assert sum(len(r.parts) for r in packing.sequences(odd_docs).collect()) == packing.pack_documents(odd_docs).count()


def _ends(rows, part):
    return part.piece == max(p.piece for r in rows for p in r.parts if p.doc_id == part.doc_id)


def test_pieces_with_texts_are_the_pieces(spark, odd_docs):
    key = lambda df: sorted(str((r.doc_id, r.piece, r.begin, r.tokens)) for r in df.collect())
    assert key(packing.text_pieces(odd_docs, most=500)) == key(packing.pieces(odd_docs, most=500))


TOKENISER = os.environ.get("TOKENISER", "/opt/tokenizers/byte_bpe_50k.json")


@pytest.mark.skipif(not os.path.isfile(TOKENISER), reason="no tokeniser")
def test_a_real_tokeniser_measures_the_pieces(spark):
    path = TOKENISER

    def offsets(text):
        global _tokeniser
        if "_tokeniser" not in globals():
            from tokenizers import Tokenizer

            _tokeniser = Tokenizer.from_file(path)
        return [(a, b) for a, b in _tokeniser.encode(text, add_special_tokens=False).offsets]

    from tokenizers import Tokenizer

    mine = Tokenizer.from_file(path)
    texts = {i: "Tokenisers cut unbelievable words into parts, don't they? " * n for i, n in enumerate((1, 3, 40))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.sequences(docs, offsets=offsets, capacities=(32, 128)).collect()
    total = sum(len(mine.encode(t, add_special_tokens=False).ids) + 1 for t in texts.values())
    assert sum(r.bin_tokens for r in rows) == total and all(r.bin_tokens <= r.capacity for r in rows)
    for i, spans in rebuilt(rows).items():
        assert "".join(texts[i][a:b] for _, a, b in spans) == texts[i]
