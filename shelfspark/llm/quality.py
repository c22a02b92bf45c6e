"""Quality scores: document statistics, random Fourier features of a Gaussian kernel, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfspark.llm.common import stored

# The statistics of a text, in the order of their vector.
STATISTICS = [
    "log_chars", "log_words", "word_length", "upper", "digits", "marks", "symbols", "blanks", "lines", "distinct_words",
    "capital_words", "odd_words", "symbol_words", "repeated_lines", "repeated_runs", "top_word", "entropy", "closed_lines",
    "long_words", "line_words",
]
FEATURES = 384
WIDTH = 1.0
RIDGE = 1e-3
CELLS = 1000
RUN = 5
SEED = 11
PIECE = 1 << 22

_kind = np.zeros(256, dtype=np.int64)  # 0 letter and bytes beyond ASCII, 1 upper, 2 digit, 3 mark, 4 symbol, 5 blank, 6 line end
_kind[65:91] = 1
_kind[48:58] = 2
_kind[[ord(c) for c in ".,;:!?'\"()-"]] = 3
_kind[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 4
_kind[[9, 11, 12, 13, 32]] = 5
_kind[10] = 6


def _distinct_share(values: np.ndarray) -> float:
    return np.unique(values).size / values.size if values.size else 1.0


def statistics(raw: bytes | None) -> np.ndarray:
    """The statistics of a whole text in UTF-8; an empty one has zeros (and a share of one where nothing repeats)."""
    raw = raw or b""
    kinds, letters = np.zeros(7), np.zeros(256)
    for at in range(0, len(raw), PIECE):
        seen = np.bincount(np.frombuffer(raw, dtype=np.uint8, count=min(PIECE, len(raw) - at), offset=at), minlength=256)
        letters += seen
        kinds += np.bincount(_kind, weights=seen, minlength=7)
    n = max(1, len(raw))
    words = raw.split()
    count = len(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=count)
    names = np.fromiter(map(hash, words), dtype=np.int64, count=count)
    capital = symbol = odd = 0
    counted: dict[bytes, int] = {}
    for w in words:
        counted[w] = counted.get(w, 0) + 1
    for w, k in counted.items():
        if len(w) > 1 and w.isupper():
            capital += k
        if not any(48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123 or c > 127 for c in w):
            symbol += k
        elif len(w) > 2 and _kind[w[-1]] in (3, 4) and _kind[w[-2]] in (3, 4):
            odd += k
    lines = [x for x in raw.split(b"\n") if x.strip()]
    runs = np.zeros(max(0, count - RUN + 1), dtype=np.int64)
    for k in range(RUN if count >= RUN else 0):
        runs = runs * 1_000_003 + names[k : k + runs.size]
    shares = letters[letters > 0] / n
    w = max(1, count)
    return np.array([
        np.log1p(len(raw)), np.log1p(count), sizes.mean() if count else 0.0, kinds[1] / n, kinds[2] / n, kinds[3] / n, kinds[4] / n,
        kinds[5] / n, kinds[6] / n, len(counted) / w, capital / w, odd / w, symbol / w,
        1.0 - len(set(lines)) / max(1, len(lines)) if lines else 0.0, 1.0 - _distinct_share(runs), max(counted.values(), default=0) / w,
        float(-(shares * np.log2(shares)).sum()), sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / max(1, len(lines)),
        float((sizes > 12).mean()) if count else 0.0, np.log1p(count / max(1, len(lines))),
    ])


def document_statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``stats`` (array of double) of each row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stats, pa.list_(pa.float64()))], names=schema.fieldNames())

    return docs.select(F.col(id_col).alias("doc_id"), F.encode(F.col(text_col), "utf-8").alias("text")).mapInArrow(run, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]  # isotonic: raw scores in order, and their calibrated values

    def lifted(self, stats: np.ndarray) -> np.ndarray:
        """cos(Wx + b) with a constant: inner products approximate a Gaussian kernel of the scaled statistics."""
        x = np.clip((stats - self.mean) / self.spread, -6, 6)
        z = np.sqrt(2.0 / self.phase.size) * np.cos(x @ self.waves + self.phase)
        return np.hstack([z, np.ones((z.shape[0], 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.lifted(stats) @ self.weight, 0.0, 1.0)

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated, with a hundredth of the raw score so that the order inside a step is kept."""
        raw = self.raw(stats)
        return 0.99 * np.interp(raw, *self.steps) + 0.01 * raw


def _normal_equations(model: Model):
    """Per task one sum of z z' and z y, given on row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = model.phase.size + 1
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.lifted(_matrix(batch.column(0), model.mean.size))
            total += z.T @ np.column_stack([z, batch.column(1).to_numpy(zero_copy_only=False)])
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(list(total))], names=["i", "sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column(0).to_pylist(), _matrix(batch.column(1), len(batch.column(1)[0]) if batch.num_rows else 1), strict=True):
            sums[i] = sums[i] + row if i in sums else row.copy()
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()))], names=["i", "sums"])


def isotonic(at: np.ndarray, hits: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing means nearest to ``hits / counts``."""
    blocks: list[list[float]] = []
    for h, c in zip(hits, counts, strict=True):
        blocks.append([h, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            h1, c1, n1 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + h1, blocks[-1][1] + c1, blocks[-1][2] + n1]
    return np.concatenate([np.full(int(n), h / c) for h, c, n in blocks])


def fit(labelled: DataFrame, *, features: int = FEATURES, ridge: float = RIDGE, width: float = WIDTH) -> Model:
    """A model from all rows of (``stats``, ``label`` 0/1); rows without a label are left out.

    Sums of a fixed size reach the driver: moments, the normal equations, and counts of hits in cells of the raw score.
    Without any labelled row every score is one half.
    """
    rows = labelled.filter("label IS NOT NULL").select("stats", F.col("label").cast("double").alias("label"))
    dims = range(len(STATISTICS))
    item = [F.element_at("stats", i + 1) for i in dims]
    moments = rows.agg(F.count("*"), *[F.avg(c) for c in item], *[F.stddev_pop(c) for c in item]).first()
    n, mean, spread = moments[0], np.array(moments[1 : 1 + len(dims)], dtype=float), np.array(moments[1 + len(dims) :], dtype=float)
    rng = np.random.default_rng(SEED)
    waves = rng.normal(0.0, width / np.sqrt(len(dims)), (len(dims), features))
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), waves, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), (np.array([0.0, 1.0]), np.array([0.5, 0.5])))
    if not n:
        model.mean = np.zeros(len(dims))
        return model
    parts = rows.mapInArrow(_normal_equations(model), "i int, sums array<double>")
    total = parts.repartition("i").mapInArrow(_added, "i int, sums array<double>").toPandas().sort_values("i")
    sums = np.vstack(total["sums"].to_numpy())
    gram = sums[:, :-1]
    model.weight = np.linalg.solve(gram + ridge * n / features * np.eye(features + 1), sums[:, -1])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0), len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([pa.array((raw * CELLS).astype(np.int32)), batch.column(1)], names=["cell", "label"])

    seen = rows.mapInArrow(cells, "cell int, label double").groupBy("cell").agg(F.sum("label").alias("hits"), F.count("*").alias("n"))
    seen = seen.toPandas().sort_values("cell")
    model.steps = (seen["cell"].to_numpy() / CELLS, isotonic(seen["cell"].to_numpy(), seen["hits"].to_numpy(), seen["n"].to_numpy()))
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of rows of (``doc_id``, ``stats``)."""
    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(1), len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``score``, from labels (id, label) of which the caller chose the rows.

    Texts are read once, whole; their statistics are kept as a table, from which fitting and scoring read. Null text
    counts as empty; empty texts are scored like others. A label without a document and a null label teach nothing; an id
    that stands in both tables several times teaches as often as the pairs stand. Repeated rows give repeated rows, an
    empty table none. Other columns are ignored.
    """
    stats = stored(document_statistics(docs, id_col=id_col, text_col=text_col), "statistics")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
    # fitting reads the labelled rows three times: they are joined once
    labelled = stored(stats.join(known, "doc_id").filter("label IS NOT NULL").select("stats", "label"), "labelled-statistics")
    return scored(stats, fit(labelled))
