import itertools
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import common, language_id, quality, toxicity
from shelfspark.llm.catalog import QUERIES

FOLDER = "/root/testdata/sf0.01"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(2)
    terms = ["clown", "idiot", "scum", "worthless", "disgusting", "réeuxan", "loser", "closer"]
    machine = toxicity.automaton(terms)
    seen = set()
    for _ in range(4000):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "s", "1", "é", "漢"])
        if w:
            seen.add("".join(w))
    for w in seen:
        near = [(edits(t, w), t) for t in terms if edits(t, w) <= toxicity.allowed_edits(t)]
        _, _, which, found, cost = toxicity.find_terms(f"x {w} y", machine)
        hits = [(int(c), terms[t]) for k, t, c in zip(which, found, cost, strict=True) if k == 1]
        assert bool(hits) == bool(near) and (not hits or hits[0][0] == min(near)[0]), w


def test_context_separates_quotation():
    lexicon = toxicity.Lexicon(["idiot"], np.array([2.0]))
    plain = toxicity.features("you are an idiot today", lexicon)
    quoted = toxicity.features('he wrote "an idiot" there', lexicon)
    assert plain[3] > quoted[3] and plain[7] == 1 and quoted[6] == 1 and plain[6] == 0
    assert toxicity.features(None, lexicon) == toxicity.features("", lexicon) == [0.0] * 8
    long = toxicity.features("word " * 600_000 + "idiiot", lexicon)
    assert long[2] > 0 and long[1] == 0


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 9):
        code = language_id.codewords(n)
        assert all((code[i] != code[j]).any() for i, j in itertools.combinations(range(n), 2))
    assert language_id.codewords(1).shape == (1, 1)


def test_ngrams_of_pieces_add_up(monkeypatch):
    text = "Ein kurzer Text über alles, und noch mehr. " * 50
    whole = language_id.ngram_counts(text)
    monkeypatch.setattr(language_id, "PIECE", 100)
    assert abs(language_id.ngram_counts(text).sum() / whole.sum() - 1) < 0.1


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    model = language_id.fit(odd_docs)
    got = {r.doc_id: r for r in language_id.identify(odd_docs, model).collect()}
    assert {got[i].lang_pred for i in (3, 4, 5, 6)} == {"und"} and got[1].lang_pred == "en" and got[2].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = language_id.known_language(odd_docs, model)
    assert kept.columns == odd_docs.columns and {3, 4, 5, 6}.isdisjoint({r.doc_id for r in kept.collect()})
    assert language_id.identify(no_docs, model).collect() == []
    nothing = language_id.fit(no_docs)
    assert {r.lang_pred for r in language_id.identify(odd_docs, nothing).collect()} == {"und"}


def test_isotonic():
    out = quality.isotonic(np.arange(5), np.array([0, 3, 1, 4, 4.0]), np.array([4, 4, 4, 4, 4.0]))
    assert np.allclose(out, [0, 0.5, 0.5, 1, 1])


def test_kernel_is_approximated():
    rng = np.random.default_rng(0)
    dims = len(quality.STATISTICS)
    waves = rng.normal(0, 1 / np.sqrt(dims), (dims, 6000))
    model = quality.Model(np.zeros(dims), np.ones(dims), waves, rng.uniform(0, 2 * np.pi, 6000), np.zeros(6001), (np.zeros(2), np.zeros(2)))
    x = rng.normal(size=(6, dims))
    z = model.lifted(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * dims))
    assert np.abs(z @ z.T - exact).max() < 0.06


def test_partition_sums_equal_one_fit(spark):
    rng = np.random.default_rng(3)
    rows = [(rng.normal(size=len(quality.STATISTICS)).tolist(), int(rng.random() < 0.5)) for _ in range(120)]
    df = spark.createDataFrame(rows, "stats array<double>, label int")
    one = quality.fit(df.coalesce(1), features=20)
    many = quality.fit(df.repartition(7), features=20)
    z, y = one.lifted(np.array([r[0] for r in rows])), np.array([r[1] for r in rows])
    exact = np.linalg.solve(z.T @ z + quality.RIDGE * 120 / 20 * np.eye(21), z.T @ y)
    assert np.allclose(one.weight, exact) and np.allclose(one.weight, many.weight)


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, 1), (7, 0, 1), (99, 1, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        for known in (labels, labels.limit(0)):
            rows = scores(odd_docs, known).collect()
            assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert scores(no_docs, labels).collect() == []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize(("name", "label", "least"), [("op5_toxicity", "toxic", 0.9), ("op9_quality_classifier", "quality", 0.9), ("op10_language_id", "lang", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    truth = spark.read.parquet(f"{FOLDER}/{'documents' if label == 'lang' else 'labels'}.parquet").select("doc_id", label)
    guess = "lang_pred" if label == "lang" else "predicted"
    rows = QUERIES[name](spark, FOLDER).filter("held_out").join(truth.filter(F.col(label).isNotNull()), "doc_id")
    assert rows.agg(F.avg((F.col(guess) == F.col(label)).cast("int"))).first()[0] >= least


def toxic_rows(words, copies=8):
    rows = [f"{w} a{i}x{n} b{i}x{n} c{i}x{n}" for i, w in enumerate(words) for n in range(copies)]
    return [(i, t, 1) for i, t in enumerate(rows)]


def test_every_term_that_passes_is_learnt(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(420)})[:400]
    rows = spark.createDataFrame(toxic_rows(words), "doc_id long, text string, label int")
    lexicon = toxicity.learn_lexicon(rows, rows.select("doc_id", "label"))
    assert set(words) <= set(lexicon.terms) and len(lexicon.machines) == 3
    assert all(toxicity.features(f"so {w} it is", lexicon)[1] > 0 for w in words)


def test_more_automata_find_the_same():
    rng = random.Random(3)
    terms = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(3, 10))) for _ in range(200)})
    text = " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(2, 11))) for _ in range(3000))
    lexicon = toxicity.Lexicon(terms, np.ones(len(terms)))
    assert len(lexicon.machines) == 2
    for a, b in zip(toxicity.find_terms(text, toxicity.automaton(terms)), toxicity.find_all(text, lexicon.machines), strict=True):
        assert np.array_equal(a, b)


def test_lexicon_counts_all_labelled_rows(spark, monkeypatch):
    clean = [(1000 + i, f"k{i} l{i} m{i} n{i}", 0) for i in range(400)]
    docs = spark.createDataFrame(toxic_rows(["grubby"]) + clean, "doc_id long, text string, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda *given, f=toxicity.learn_lexicon: seen.append(f(*given)) or seen[0])
    toxicity.toxicity_scores(docs.drop("toxic"), docs.select("doc_id", "toxic"), train_rows=20)
    assert "grubby" in seen[0].terms


def test_texts_with_a_common_pair_all_count(spark):
    pair = min(((f"u{i}", f"v{i}") for i in range(50_000)), key=lambda p: zlib.crc32(p[1].encode(), zlib.crc32(p[0].encode())))
    rows = [(i, " ".join(["grubby", *[f"w{i}x{n}" for n in range(60)], *pair, f"z{i}"]), 1) for i in range(8)]
    copies = [(100 + i, " ".join(f"copied{n}" for n in range(60)), 1) for i in range(20)]
    table = spark.createDataFrame(rows + copies + copies, "doc_id long, text string, label int")
    lexicon = toxicity.learn_lexicon(table, table.select("doc_id", "label"))
    assert "grubby" in lexicon.terms and "copied7" not in lexicon.terms


def test_pieces_of_a_text_see_the_words_around_them(monkeypatch):
    lexicon = toxicity.Lexicon(["idiot", "grubby"], np.array([2.0, 1.0]))
    parts = ['he said "what an idiot that man is" and', "you grubby idiiot you", "plain words stand here and there", "the word idiot in a book", "  ", "an idiot"]
    text = " ".join(parts[(i * 7 + i // 5) % 6] for i in range(400))
    whole = toxicity.features(text, lexicon)
    assert whole[6] > 0 and whole[7] > 0
    for piece in (60, 97, 500, 4000):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        assert toxicity.features(text, lexicon) == pytest.approx(whole)
        assert toxicity.features("x" * 1000 + " idiot", lexicon)[1] > 0
        assert [(a, b) for _, a, b, _ in toxicity._pieces("y" * 3 * piece)][-1][1] == 3 * piece


def test_the_filter_of_ids_holds_all_of_them(spark, monkeypatch):
    ids = spark.range(0, 6000, 3).withColumnRenamed("id", "doc_id")
    for bits in (1 << 25, 1 << 10):
        monkeypatch.setattr(toxicity, "FILTER_BITS", bits)
        held = toxicity.id_filter(ids)
        assert held.nbytes == bits // 8
        rows = spark.range(6000).selectExpr("id", "xxhash64(id) AS h").toPandas()
        may = toxicity._may_hold(held, rows["h"].to_numpy())
        assert may[rows["id"] % 3 == 0].all()
        # a filter that is too small lets others pass, and never drops one
        assert may.mean() < 0.35 if bits == 1 << 25 else may.mean() > 0.9
    assert not toxicity.id_filter(ids.limit(0)).any()


def test_a_full_filter_changes_no_lexicon(spark, monkeypatch):
    words = ["grubby", "mouldy", "festering"]
    rows = spark.createDataFrame(toxic_rows(words), "doc_id long, text string, label int")
    others = spark.createDataFrame([(10_000 + i, f"unlabelled {w} text {i}") for i, w in enumerate(words * 20)], "doc_id long, text string")
    texts = rows.select("doc_id", "text").unionByName(others)
    one = toxicity.learn_lexicon(texts, rows.select("doc_id", "label"))
    monkeypatch.setattr(toxicity, "_may_hold", lambda held, hashes: np.ones(len(hashes), dtype=bool))
    two = toxicity.learn_lexicon(texts, rows.select("doc_id", "label"))
    assert one.terms == two.terms and one.weights == pytest.approx(two.weights) and one.plain == two.plain


def test_language_model_equals_a_plain_computation(spark):
    """Counts, odds, bit weights, losses and the chosen language of a fitted model, from the definitions by plain loops."""
    rows = [(i, text, lang) for i, (text, lang) in enumerate([
        ("the cat and the dog", "en"), ("this is the house", "en"), ("der hund und die katze", "de"), ("das ist ein haus", "de"),
        ("le chat et le chien", "fr"), ("voici une maison", "fr"), ("12 !!", "en"), ("un gato", None),
    ])]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "fr"]
    share = {}
    for lang in model.languages:
        total = np.zeros(language_id.BINS)
        for _, text, of in rows:
            if of == lang and language_id.has_letter(text):
                counts = language_id.ngram_counts(text)
                total += counts / counts.sum()
        share[lang] = (total / total.sum() + 1e-6) / (1 + 1e-6 * language_id.BINS)
    code = language_id.codewords(3)
    for b in range(code.shape[1]):
        ones = [share[x] for x, c in zip(model.languages, code[:, b]) if c > 0]
        others = [share[x] for x, c in zip(model.languages, code[:, b]) if c < 0]
        want = np.log(sum(ones) / len(ones)) - np.log(sum(others) / len(others))
        assert model.odds[:, b] == pytest.approx(want)

    def margins(text):
        counts = language_id.ngram_counts(text)
        return [language_id.SCALE * sum(counts[g] / counts.sum() * model.odds[g, b] for g in np.flatnonzero(counts)) for b in range(code.shape[1])]

    for k, lang in enumerate(model.languages):
        mine = [t for _, t, of in rows if of == lang and language_id.has_letter(t)]
        hits = [sum(np.sign(margins(t)[b]) == code[k, b] for t in mine) / len(mine) + 1e-3 for b in range(code.shape[1])]
        assert model.weight[k] == pytest.approx([h / sum(hits) for h in hits])
    for text in ["the dog", "die katze", "le chien et", "gato perro", "THE HOUSE!"]:
        losses = [sum(w * np.log1p(np.exp(-c * m)) for w, c, m in zip(model.weight[k], code[k], margins(text))) for k in range(3)]
        lang, score, doubt = model.decide(text)
        order = np.argsort(losses, kind="stable")
        assert lang == model.languages[order[0]] and doubt == (losses[order[1]] - losses[order[0]] < language_id.AMBIGUOUS)
        assert score == pytest.approx(1 / sum(np.exp(-(x - min(losses)) * code.shape[1]) for x in losses))


def test_grams_of_pieces_are_counted_once(monkeypatch):
    text = "Über den  Wolken -- the cat's 12 chats, été " * 40
    whole = language_id.ngram_counts(text)
    for piece in (70, 101, 333):
        monkeypatch.setattr(language_id, "PIECE", piece)
        assert (language_id.ngram_counts(text) == whole).all()


def test_without_a_learnt_language_texts_with_letters_stay(spark):
    rows = [(i, f"an English sentence number {i}", None) for i in range(20)] + [(90, "12 34", None), (91, None, None), (92, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    assert model.languages == []
    assert sorted(r.doc_id for r in language_id.known_language(docs, model).collect()) == list(range(20))
    assert {r.lang_pred for r in language_id.identify(docs, model).collect()} == {"und"}


def test_rare_languages_are_learnt_from_all_their_rows(spark):
    texts = {"en": "the cat and the dog", "de": "der hund und die katze", "xx": "qoph zayin lamedh"}
    rows = [(i, texts["en"] + f" {i}", "en") for i in range(3000)] + [(5000 + i, texts["de"], "de") for i in range(500)] + [(9000 + i, texts["xx"], "xx") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    part = common.sampled_by(docs, "doc_id", "lang", 300).groupBy("lang").count().collect()
    counts = {r.lang: r["count"] for r in part}
    assert counts["xx"] == 4 and 60 < counts["en"] < 140 and 60 < counts["de"] < 140
    assert language_id.fit(docs, train_rows=300).languages == ["de", "en", "xx"]


def test_samples_are_bounded_and_independent(spark):
    rows = spark.range(40_000).withColumnRenamed("id", "doc_id")
    one = common.sampled(rows, "doc_id", 4000, "first")
    assert 3600 < one.count() < 4400
    # a sample of a sample is a new draw
    assert 300 < common.sampled(one, "doc_id", 400, "second").count() < 500
    assert common.sampled(rows, "doc_id", 1).count() < 12 and common.sampled(rows, "doc_id", 40_000).count() == 40_000
