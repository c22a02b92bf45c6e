"""Language of a text by error-correcting output codes over binary character n-gram classifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfspark.llm.common import column, held_out, sampled_by

UNDECIDED = "und"
ORDERS = (1, 2, 3, 4)
BINS = 1 << 14
#: Labelled documents that the n-gram counts are learnt from at most, and those the bit weights are measured on: equal parts
#: for each language, so a rare one keeps all its documents.
TRAIN_ROWS = 60_000
WEIGHT_ROWS = 10_000
#: Gap between the losses of the two nearest codewords under which a decision is called ambiguous.
AMBIGUOUS = 0.05
#: Mean log odds are small numbers; this turns them into margins on the scale of the logistic loss.
SCALE = 8.0
PIECE = 1 << 20
CONTEXT = 64
LETTER = re.compile(r"[^\W\d_]")

_alpha = np.fromiter((chr(c).isalpha() for c in range(0x10000)), dtype=bool, count=0x10000)


def has_letter(text: str | None) -> bool:
    return bool(text) and LETTER.search(text) is not None


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed character n-grams; case is folded and what is no letter becomes a single blank mark.

    A very long text is read in pieces, each with some characters before it that are only context.
    """
    total = np.zeros(BINS, dtype=np.float64)
    for at in range(0, len(text), PIECE):
        before = text[max(0, at - CONTEXT) : at].lower()
        piece = before + text[at : at + PIECE].lower()
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = np.where(points < 0x10000, _alpha[np.minimum(points, 0xFFFF)], True)
        points = np.where(letter, points, np.uint32(32))
        # blanks in a row count once
        seen = np.append(True, letter[1:] | letter[:-1])
        fresh = (np.arange(points.size) >= len(before))[seen]
        points = points[seen]
        grams = np.zeros(points.size, dtype=np.uint32)
        for n in ORDERS:
            if points.size < n:
                break
            grams = grams[: points.size - n + 1] * np.uint32(0x01000193) + points[n - 1 :] * np.uint32(0x9E3779B1)
            mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n * 0x27D4EB2F)
            if before:
                mixed = mixed[fresh[n - 1 :]]
            total += np.bincount(mixed >> np.uint32(32 - 14), minlength=BINS)
    return total


def codewords(n: int) -> np.ndarray:
    """Rows of +1 and -1, one per language: every split in two for up to six languages, else a random code of wide distance."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        bits = [[1 if k == 0 or not (split >> (k - 1)) & 1 else -1 for k in range(n)] for split in range(1, 1 << (n - 1))]
        return np.array(bits, dtype=float).T
    length, rng = int(np.ceil(10 * np.log2(n))), np.random.default_rng(7)
    best, wide = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(n, length))
        apart = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        mixed = (np.abs(code.sum(axis=0)) < n).all()
        if mixed and apart > wide:
            best, wide = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    odds: np.ndarray  # bins x bits
    weight: np.ndarray  # languages x bits, rows sum to one

    def margins(self, text: str) -> np.ndarray:
        counts = ngram_counts(text)
        there = np.flatnonzero(counts)
        return SCALE * (counts[there] / counts.sum()) @ self.odds[there]

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether a second codeword is as near."""
        if not self.languages or not has_letter(text):
            return UNDECIDED, 0.0, True
        losses = (self.weight * np.logaddexp(0.0, -self.code * self.margins(text))).sum(axis=1)
        order = np.argsort(losses, kind="stable")
        near = np.exp(-(losses - losses[order[0]]) * self.code.shape[1])
        alone = losses.size == 1 or losses[order[1]] - losses[order[0]] >= AMBIGUOUS
        return self.languages[order[0]], float(1.0 / near.sum()), not alone


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language and bin that the task has seen."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = ngram_counts(text)
            # each document weighs the same, however long it is
            sums[lang] = sums.get(lang, 0.0) + counts / max(1.0, counts.sum())
    for lang, total in sums.items():
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * there.size), pa.array(there.astype(np.int32)), pa.array(total[there])], names=["lang", "bin", "share"]
        )


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", train_rows: int = TRAIN_ROWS) -> Model:
    """A model from rows with a language; null languages and texts without letters teach nothing.

    Counts are summed by Spark; a table of languages x bins reaches the driver. No rows give a model that decides nothing.
    """
    rows = labelled.select(column(id_col).alias("id"), column(lang_col).alias("lang"), column(text_col).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    train = sampled_by(rows, "id", "lang", train_rows, "language counts")
    sums = train.select("lang", "text").mapInArrow(_counts, "lang string, bin int, share double")
    sums = sums.groupBy("lang", "bin").agg(F.sum("share").alias("share")).toPandas()
    languages = sorted(sums["lang"].unique())
    code = codewords(len(languages))
    if not languages:
        return Model([], code, np.zeros((BINS, 1)), np.zeros((0, 1)))
    share = np.zeros((len(languages), BINS))
    share[sums["lang"].map({x: i for i, x in enumerate(languages)}), sums["bin"]] = sums["share"]
    share = (share / share.sum(axis=1, keepdims=True) + 1e-6) / (1 + 1e-6 * BINS)
    odds = np.zeros((BINS, code.shape[1]))
    for b in range(code.shape[1]):
        ones, others = code[:, b] > 0, code[:, b] < 0
        if ones.any() and others.any():
            odds[:, b] = np.log(share[ones].mean(axis=0)) - np.log(share[others].mean(axis=0))
    model = Model(languages, code, odds, np.full(code.shape, 1.0 / code.shape[1]))
    model.weight = _weights(model, sampled_by(train, "id", "lang", WEIGHT_ROWS, "bit weights"))
    return model


def _weights(model: Model, rows: DataFrame) -> np.ndarray:
    """How often each bit is right for the documents of each language, each row scaled to a sum of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            at = [model.languages.index(x) if x in model.languages else -1 for x in langs]
            right = [
                (np.sign(model.margins(t)) == model.code[k]).astype(float).tolist() if k >= 0 else None
                for k, t in zip(at, batch.column(1).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(right, pa.list_(pa.float64()))], names=["lang", "hit"])

    bits = range(model.code.shape[1])
    hits = rows.select("lang", "text").mapInArrow(run, "lang string, hit array<double>").filter("hit IS NOT NULL")
    means = {r[0]: r[1:] for r in hits.groupBy("lang").agg(*[F.avg(F.element_at("hit", b + 1)).alias(f"b{b}") for b in bits]).collect()}
    weight = np.array([means.get(x, [1.0] * len(bits)) for x in model.languages], dtype=float) + 1e-3
    return weight / weight.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``.

    Whole texts are read, in pieces where they are very long. Null texts, empty ones and those without a letter get
    ``und``, score 0 and ``ambiguous``; ties between codewords go to the first language by name. Repeated rows give
    repeated rows, an empty table none; other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.decide(t) for t in batch.column(1).to_pylist()]
            lang, score, doubt = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(doubt, pa.bool_())],
                names=schema.fieldNames(),
            )

    return docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text")).mapInArrow(run, schema)


def known_language(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language can be told: neither ``und`` nor ambiguous. Nothing is shuffled.

    A model without any language, learnt from a table without labels, can tell none apart: then all rows with a letter stay.
    """

    @F.pandas_udf("boolean")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([not model.decide(t)[2] if model.languages else has_letter(t) for t in texts], dtype=bool)

    return docs.filter(told(column(text_col)))


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the part of ``docs`` that is not held out."""
    return fit(docs.filter(~held_out(column(id_col))), id_col=id_col, text_col=text_col, lang_col=lang_col)


__all__ = ["Model", "codewords", "fit", "identify", "known_language", "learn", "ngram_counts"]
