"""Stages of the pipeline on a small fixture, and queries against their SQL twins."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from oracle_check import compare, connect  # noqa: E402
from shelfspark.llm import common, exact_dedup  # noqa: E402
from shelfspark.llm.catalog import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES[name]) == []


def test_stages(spark, tmp_path, odd_docs):
    passage = " ".join(f"passage{i}" for i in range(20))
    rows = [
        (1, "the cat and the dog are in the house and they are happy there", "en"),
        (2, "the  cat and the dog\nare in the house and they are happy there", "en"),
        (3, "der Hund und die Katze sind in dem Haus und sie sind sehr froh", "de"),
        (4, "the text begins and then " + passage + " and it ends here", "en"),
        (5, "der Text beginnt und dann kommt etwas anderes und endet", "de"),
        (6, "12 34 !!", None), (7, None, None), (7, None, None), (8, "the cat and the dog are in the house and they are happy there", "en"),
    ]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        kept[name] = sorted(r.doc_id for r in now.collect())
        if name != "best_fit_packing":
            assert now.columns == docs.columns
    assert kept["language_id"] == [1, 2, 3, 4, 5, 8]
    assert kept["exact_dedup"] == kept["simhash_near_dedup"] == [1, 3, 4, 5]
    assert kept["decontamination"] == kept["best_fit_packing"] == [1, 3, 5]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [1, 3, 5]


def test_odd_and_empty_documents(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        now = docs
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
        now.collect()


def test_rows_come_out_as_they_went_in(spark, tmp_path):
    """Columns named as the stages' helpers are, and names with dots and blanks: whole rows are compared."""
    names = ["__n", "__sha", "__keep", "__k1", "__k2", "row", "n", "sha", "id", "keep_id", "fp", "meta.lang", "a b", "x`y"]
    texts = ["the cat and the dog are in the house", "the cat  and the dog are in the house", "der Hund und die Katze sind im Haus", "a third one about nothing", None]
    rows = [(i, t, "en" if i != 2 else "de", "s", len(t or ""), *[f"{n}-{i}" for n in names]) for i, t in enumerate(texts)]
    fields = ["doc_id long", "text string", "lang string", "source string", "n_chars long"]
    docs = spark.createDataFrame(rows, ", ".join(fields + ["`" + n.replace("`", "``") + "` string" for n in names]))
    spark.createDataFrame([(1, "a third one about nothing")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = [tuple(r) for r in out.collect()]
        assert set(got) <= given and len(got) == len(set(got)), name
        left = {"language_id": 4, "exact_dedup": 4, "simhash_near_dedup": 4, "decontamination": 4}[name]
        assert len(got) == left, (name, [r[:2] for r in got])


@pytest.mark.parametrize("bits", [1 << 24, 1 << 6])
def test_rows_stay_by_their_marks_at_any_size_of_the_filter(spark, monkeypatch, bits):
    """Kept keys, dropped keys, repeated rows and null columns; a filter that is full moves all rows and changes nothing."""
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    rows = [(i // 2 if i % 10 == 0 else 1000 + i, None if i % 7 == 0 else f"v{i % 50}") for i in range(400)] + [(5, "again")] * 3 + [(None, None)] * 2
    df = spark.createDataFrame(rows, "a long, `k1` string")
    keyed = df.select(common.whole_row(df), F.xxhash64("a", "k1").alias("x1"), F.hash("k1", "a").alias("k2")).withColumnRenamed("x1", "k1")
    marked = keyed.groupBy("k1", "k2").agg(F.count("*").alias("n")).withColumn("keep", F.pmod("k1", F.lit(3)) != 0)
    kept = {(r.k1, r.k2) for r in marked.filter("keep").collect()}
    want = {tuple(r.row) for r in keyed.collect() if (r.k1, r.k2) in kept}
    got = common.keep_marked(keyed, marked)
    assert got.columns == ["a", "k1"]
    found = [tuple(r) for r in got.collect()]
    assert set(found) == want and len(found) == len(want) > 200


def test_few_texts_move_in_the_copy_stages(spark):
    rows = [(i, f"text number {i} of many with words that differ {i * i}", None) for i in range(3000)] + [(5000 + i, "a copy of one text", None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = exact_dedup.keep_first(docs)
    assert out.count() == 3001 and out.filter("text = 'a copy of one text'").first().doc_id == 5000
