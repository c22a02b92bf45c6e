"""SimHash groups against a direct computation of all pairs."""

import random
import re

import xxhash

from shelfspark.llm import simhash


def brute(rows, words=4, radius=4):
    def fp(text):
        parts = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        if not parts:
            return 0
        grams = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
        hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    fps = [fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = d if least.get(r) is None else min(d, least[r])
    return sorted(((d, fps[i], least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def texts():
    rng = random.Random(3)
    vocabulary = ["alpha", "beta", "Gamma", "delta", "été", "zeta", "eta", "x"]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))) for _ in range(12)]
    out = [t for t in base for _ in range(2)] + ["", None, "   \n", "one", "ONE", "a b c", "a\tB  c"]
    for t in base:
        w = t.split()
        for _ in range(6):
            v = list(w)
            v[rng.randrange(len(v))] = rng.choice(vocabulary)
            out.append(" ".join(v))
    out.append("word " * 30_000)
    rng.shuffle(out)
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, fp int")
    got = simhash.simhash_groups(df, **kw).collect()
    return sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=str)


def test_groups_equal_all_pairs(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [rows[5], rows[5], (None, rows[7][1]), (None, "quite alone here by itself and with no id")]
    assert run(spark, rows) == brute(rows)


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts())]
    whole = simhash.links
    monkeypatch.setattr(simhash, "links", lambda c, radius: whole(c, radius=radius, block=4))
    assert run(spark, rows) == brute(rows)


def test_masks_cover():
    rng = random.Random(1)
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    for _ in range(3000):
        differs = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not m & differs for m in masks)


def test_empty_and_kept(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(empty).collect() == []
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (1, "other words stand in this row here"), (None, None), (None, "")]
    df = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, root string")
    kept = sorted(map(tuple, simhash.keep_one(df).collect()), key=str)
    assert kept[0] == (1, "a b c d e f", "s") and kept[1][1].startswith("other") and len(kept) == 3 and kept[2][0] is None
