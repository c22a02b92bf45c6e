"""Passages against a direct search of every window by edit distance."""

import random
import re
import time

import numpy as np

from shelfspark.llm import decontaminate as d


def tokens(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def infix_edits(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def brute(docs, items):
    out = {}
    for i, t in docs:
        for k, x in items:
            item = tokens(x)
            if item:
                e = infix_edits(item, tokens(t))
                if e <= int(d.EDIT_SHARE * len(item)):
                    out[i, k] = e
    return out


def material():
    rng = random.Random(4)
    vocabulary = ["the", "of", "and"] * 6 + [f"w{i}" for i in range(300)] + ["été", "über"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(13, 60)))) for i in range(40)]
    items += [(90, "one two three"), (91, ""), (92, None), (93, "!!!"), (94, "Solo-word"), (95, items[0][1])]
    docs = []
    for n in range(160):
        w = text(rng.randint(20, 200))
        if n % 2:
            item = tokens(items[n % 40][1])
            for _ in range(rng.randint(0, max(1, int(0.15 * len(item))))):
                at = rng.randrange(len(item))
                item[at : at + rng.randint(0, 1)] = [rng.choice(["new", "old", "the"])]
            at = rng.choice([0, len(w), rng.randrange(len(w))])
            w[at:at] = item
        docs.append((n, " ".join(w)))
    docs += [(500, items[3][1].upper().replace(" ", ", ")), (501, "xx one two\nthree yy"), (502, None), (503, ""), (504, "a SOLO word")]
    docs.append((505, "x " * (d.CHUNK * 2 - 20) + items[5][1] + " y" * 100))
    return docs, items


def test_recall_and_precision(spark):
    docs, items = material()
    want = brute([x for x in docs if x[0] != 505], items)
    got = d.contaminated(
        spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, item_id string, edits int"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    found = {(r.doc_id, r.item_id): r.edits for r in got}
    assert found.pop((505, 5)) == 0
    assert {k: v for k, v in found.items() if k[0] != 505 and want.get(k) != v} == {}  # each hit is right, with its distance
    assert len(found) >= 0.95 * len(want)
    assert all(k in found for k, e in want.items() if e == 0)
    assert (500, 3) in found and (501, 90) in found and (504, 94) in found


def test_blocks_give_the_same(spark):
    docs, items = material()
    docs = [x for x in docs if x[0] != 505]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    one = {(r.doc_id, r.item_id): r.edits for r in d.contaminated(a, b).collect()}
    many = {(r.doc_id, r.item_id): r.edits for r in d.contaminated(a, b, block_items=9).collect()}
    assert all(many[k] == one[k] for k in set(one) & set(many)) and len(set(one) ^ set(many)) <= 0.06 * len(one)


def test_odd_tables(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "this is a sentence in English")], "item_id long, text string")
    assert sorted(r.doc_id for r in d.contaminated(odd_docs, bench).collect()) == [1, 8]
    clean = d.clean_rows(odd_docs, bench)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count() - 2
    assert d.contaminated(no_docs, bench).collect() == [] and d.contaminated(odd_docs, bench.limit(0)).collect() == []


def found(docs, items):
    index = d.build(items, edit_share=d.EDIT_SHARE, recall=d.RECALL, samples=d.SAMPLES, piece=d.PIECE_WORDS)
    pieces = [(n, p) for n, t in enumerate(docs) for _, p in d._cut(t.lower(), index.reach)]
    return {(pieces[k][0], name) for k, i, _, _ in d.search(index, [p for _, p in pieces]) for name in index.ids[i]}


def test_unicode_marks_and_unspaced_scripts():
    items = [(1, "the cat sat"), (2, "le chat dort"), (3, "\u6211\u4eec\u5728\u5317\u4eac\u5b66\u4e60")]
    docs = ["he said \u201cthe cat sat\u201d\u2014and left", "\u00ab\u00a0le\u00a0chat\u00a0dort\u00a0\u00bb", "\u4eca\u5929\uff0c\u6211\u4eec\u5728\u5317\u4eac\u5b66\u4e60\u3002\u597d"]
    assert found(docs, items) == {(0, 1), (1, 2), (2, 3)}


def test_long_runs_without_blanks():
    run = "a1b2c3d4" * (6 << 17)
    assert found([run + " and one two three", "x " + run[:-1]], [(1, run), (2, "one two three")]) == {(0, 1), (0, 2)}


def build(items, **options):
    return d.build(items, **({"edit_share": d.EDIT_SHARE, "recall": d.RECALL, "samples": d.SAMPLES, "piece": d.PIECE_WORDS} | options))


PROMPT = "answer the following question by choosing the best of the four options that are given below it"


def prompted(n, seed=8, words=30):
    rng = random.Random(seed)
    return [(i, PROMPT + " " + " ".join(f"v{rng.randrange(5000)}" for _ in range(words))) for i in range(n)]


def test_a_prompt_that_many_items_share_costs_little():
    """Two thousand items behind one prompt, and a text that repeats it: the same hits as the direct search, at once."""
    items = prompted(2000)
    rng = random.Random(9)
    filler = lambda n: " ".join(f"u{rng.randrange(900)}" for _ in range(n))
    edited = items[7][1].split()
    edited[20], edited[33] = "other", "words"
    docs = [" ".join(f"{PROMPT} {filler(6)}" for _ in range(300)), f"{filler(40)} {items[3][1]} {filler(9)}", " ".join(edited), f"{PROMPT} {filler(30)}"]
    index = build(items)
    begin = time.time()
    got = {(t, index.ids[i][0]): e for t, i, e, _ in d.search(index, docs)}
    assert time.time() - begin < 2
    assert got == {k: e for k, e in brute(list(enumerate(docs)), items[:20]).items()} == {(1, 3): 0, (2, 7): 2}


def test_items_of_shared_pieces_only_are_found():
    parts = [" ".join(f"p{k}x{j}" for j in range(12)) for k in range(4)]
    items = [(10 * a + b, f"{parts[a]} {parts[b]}") for a in range(4) for b in range(4)] * 3
    index = build(items)
    assert len(index.ids) == 16 and all(len(x) == 3 for x in index.ids)
    got = {index.ids[i][0] for _, i, _, _ in d.search(index, [f"so {parts[2]} {parts[1]} it is", parts[0]])}
    assert got == {21}


def test_equal_items_each_have_a_row(spark):
    docs = spark.createDataFrame([(1, "x one two three y")], "doc_id long, text string")
    bench = spark.createDataFrame([("mmlu/1", "one two three"), ("mmlu/2", "One, two, three!"), (None, "two three y")], "item_id string, text string")
    rows = d.contaminated(docs, bench).collect()
    assert sorted((str(r.item_id), r.edits, r.end_word) for r in rows) == [("None", 0, 5), ("mmlu/1", 0, 4), ("mmlu/2", 0, 4)]


def test_where_repetitions_do_not_reach_the_target_pieces_are_exact(monkeypatch):
    """With a third of the words edited a few walks are not enough; cutting by the number of edits finds every item."""
    monkeypatch.setattr(d, "MOST_ROUNDS", 4)
    rng = random.Random(3)
    items = [(i, " ".join(f"v{rng.randrange(4000)}" for _ in range(rng.randint(20, 50)))) for i in range(60)] + [(100 + i, t) for i, t in prompted(12)]
    docs = []
    for i, text in items:
        w = text.split()
        for _ in range(int(0.3 * len(w))):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = [f"new{rng.randrange(99)}"] * rng.randint(0, 1)
        docs.append(" ".join(["a", "b", *w, "c"]))
    assert d._rounds_for([d.words(t)[0] for _, t in items], _limits(items, 0.3), _pieces(items), 12, 4, 0.999, np.random.default_rng(1)) is None
    index = build(items, edit_share=0.3, recall=0.999)
    got = {(t, index.ids[i][0]) for t, i, _, _ in d.search(index, docs)}
    monkeypatch.setattr(d, "EDIT_SHARE", 0.3)
    assert {k for k in brute(list(enumerate(docs)), items)} <= got
    assert {(n, i) for n, (i, _) in enumerate(items)} <= got


def _limits(items, share):
    return np.array([int(share * d.words(t)[0].size) for _, t in items])


def _pieces(items):
    return np.array([(k, at) for k, (_, t) in enumerate(items) for at in range(0, d.words(t)[0].size - 11, 12)])


def test_pieces_of_a_long_text_overlap_by_words(monkeypatch):
    """Words with long stretches between them: a passage over a cut is found wherever the cut falls."""
    monkeypatch.setattr(d, "CHUNK", 500)
    gap = " ... " + "*" * 150 + " ... "
    passage = [f"word{i}" for i in range(16)]
    for shift in range(0, 3000, 370):
        text = "x" * 10 + " y" * (shift // 2 + 700) + " " + gap.join(passage) + " z" * 900
        assert found([text], [(1, " ".join(passage))]) == {(0, 1)}


def test_rows_come_back_as_they_were(spark):
    docs = spark.createDataFrame([(1, "one two three", 5, "a", 7), (2, "clean text", 6, "b", 8)], "doc_id long, text string, __k1 long, `meta.lang` string, __k2 int")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    kept = d.clean_rows(docs, bench)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "clean text", 6, "b", 8)]
