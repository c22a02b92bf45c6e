import hashlib
import re
from collections import defaultdict

from shelfspark.llm.exact_dedup import exact_dedup, keep_first


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def test_equals_grouping_of_whole_texts(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    groups = defaultdict(list)
    for d, t in rows:
        groups[normal(t)].append(d)
    want = sorted(
        (str(d), str(min((x for x in groups[normal(t)] if x is not None), default=None)), len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest())
        for d, t in rows
    )
    got = exact_dedup(odd_docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    # exactly one row of each group stays
    assert sorted(r.text_sha256 for r in got if r.kept) == sorted({w[3] for w in want})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_same_length_and_prefix_are_not_enough(spark):
    df = spark.createDataFrame([(i, "p" * 200 + x) for i, x in enumerate(["aa", "ab", "aa", "ba"])], "doc_id long, text string")
    assert sorted((r.doc_id, r.keep_id) for r in exact_dedup(df).collect()) == [(0, 0), (1, 1), (2, 0), (3, 3)]


def test_keep_first(spark, odd_docs, no_docs):
    kept = keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(normal(r.text) for r in rows) == sorted({normal(r.text) for r in odd_docs.collect()})
    assert {r.doc_id for r in rows if r.text and "quick" in r.text} == {1}
    assert exact_dedup(no_docs).collect() == [] and keep_first(no_docs).collect() == []
