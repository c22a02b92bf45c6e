"""Filter audit: min-plus steps against running every order, document by document."""

import random
from itertools import permutations

import numpy as np
import pytest

from shelfspark.llm import filter_audit as fa


def failing(rows):
    """Letters of the filters each row fails, in plain Python."""
    smallest = {}
    for doc_id, text, *_ in rows:
        t = text or ""
        if doc_id is not None:
            smallest[t] = min(smallest.get(t, doc_id), doc_id)
    blanks = " \t\n\x0b\x0c\r"
    out = []
    for doc_id, text, *_ in rows:
        t = text or ""
        words = "".join(" " if c in blanks else c for c in t).split(" ")
        words = [w for w in words if w]
        bad = set()
        if len(words) < 200:
            bad.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            bad.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t):
            bad.add("C")
        if any(c in "#$%&*|" for c in t):
            bad.add("D")
        if t in smallest and (doc_id is None or doc_id > smallest[t]):
            bad.add("E")
        out.append(bad)
    return out


def by_hand(rows, labels):
    """Every order run over the documents, one filter after the other."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    parts = {}
    for row, bad in zip(rows, failing(rows)):
        parts.setdefault(row[2] or "", []).append((row[0], bad))
    out = {}
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(docs)
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                fails = sum(letter in bad for _, bad in docs)
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), fails - len(gone), sum(bad == {letter} for _, bad in docs),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter,
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row[-1] = shapley[order[step - 1]]
    return {k: tuple(v) for k, v in out.items()}


def result(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in fa.COUNTS) for r in rows}
    assert len(out) == len(rows)
    return out


LABELS = "doc_id long, quality int, toxic int"


def test_all_orders_against_running_them(spark):
    rng = random.Random(7)
    rows, texts = [], []
    for i in range(120):
        words = [rng.choice(["of", "the", "Sentence", "THING", "cost$", f"w{rng.randrange(400)}"]) if rng.random() < 0.4 else f"w{rng.randrange(4000)}"
                 for _ in range(rng.choice([3, 150, 220, 400]))]
        text = rng.choice([" ", "\t", " \n", "  "]).join(words)
        texts.append(text if rng.random() < 0.7 or not texts else rng.choice(texts))
        rows.append((rng.randrange(1000), texts[-1], rng.choice(["en", "de", None]), "s"))
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows[::2]] + [(None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = result(fa.filter_audit(docs, spark.createDataFrame(labels, LABELS)))
    assert got == by_hand(rows, labels)
    assert len(got) == 3 * 600


def test_odd_rows(spark, odd_docs, no_docs):
    labels = [(1, 1, 0), (1, 0, 1), (5, None, None), (None, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame(labels, LABELS)
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text", "lang").collect()]
    assert result(fa.filter_audit(odd_docs, table)) == by_hand(rows, labels)
    assert fa.filter_audit(no_docs, table).count() == 0
    assert result(fa.filter_audit(odd_docs, table.limit(0))) == by_hand(rows, [])


def test_null_lang_and_empty_lang_are_one_part(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, "b", "x")], "doc_id long, text string, lang string")
    got = result(fa.filter_audit(docs, spark.createDataFrame([], LABELS)))
    assert {k[0] for k in got} == {"", "x"}
    # document 2 repeats 1 across parts and rows removed before
    assert got["", "AEBCD", 2][2] == 1 and got["", "EABCD", 1][1] == 1


def test_a_null_id_is_larger_than_any(spark):
    docs = spark.createDataFrame([(None, "a", "x"), (4, "a", "x"), (None, "b", "x"), (None, "b", "x"), (4, "a", "x")], "doc_id long, text string, lang string")
    masks = sorted((str(r.doc_id), r.mask >> 4) for r in fa.masks(docs).collect())
    assert masks == [("4", 0), ("4", 0), ("None", 0), ("None", 0), ("None", 1)]


@pytest.mark.parametrize("n", [1, 3, 5])
def test_steps_are_the_first_failing_position(n):
    orders, steps = fa.removal_steps(n)
    for o, order in enumerate(orders):
        for mask in range(1 << n):
            first = next((i for i, f in enumerate(order) if mask >> f & 1), n)
            assert steps[o, mask] == first


def test_shares_of_all_orders_add_up():
    weights = np.random.default_rng(3).integers(0, 50, (3, 32))
    out = fa.audit_rows(weights, 5)
    per_filter = dict(zip(out["filters"].reshape(-1).tolist(), out["shapley"].reshape(-1).tolist()))
    assert sum(per_filter.values()) == 120 * weights[0][1:].sum()
    assert (out["kept"][:, -1] == weights[0][0]).all()
