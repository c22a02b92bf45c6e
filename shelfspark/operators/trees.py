"""Gradient boosting of regression trees on binned rows: the squared error of ``pyspark.ml``'s ``GBTRegressor``, without its jobs.

The first tree is fitted to the labels, each later one to twice what the trees before it leave, and counts by the rate. A
level of a tree needs the sums of the rows by node, feature and bin. Rows that fit one task stay in it for all trees: one
job. More rows lie in parts over the cluster, and a level is one job of one stage; only the sums come to the driver, whose
size does not depend on the rows. Of two sister nodes one is summed, the other is what the parent has besides.

The model is a ``GBTRegressionModel``, read from the files that such a model is saved as.
"""

from __future__ import annotations

import json
import pickle
import time
import uuid
from collections.abc import Callable, Iterator
from functools import partial, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession

from shelfspark.session import run_folder

#: Impurities below this are those of equal labels (as in ``pyspark.ml``).
EQUAL = 2.0**-52
#: From so many parts on, their sums are added up on the executors.
PARTS_TO_DRIVER = 64

SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
NODE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", SPLIT),
])


class Paths(NamedTuple):
    """What rows need to walk a tree: nodes in heap order, feature -1 in leaves; ``step`` is what a leaf takes off a row's rest."""

    feature: np.ndarray
    cut: np.ndarray
    step: np.ndarray


class Sums(NamedTuple):
    """Weighted sums and weights by (node, feature, bin); squares and rows by node, of this tree and of the leaves of the one before."""

    sums: np.ndarray
    weights: np.ndarray
    squares: np.ndarray
    rows: np.ndarray
    leaf_squares: np.ndarray
    leaf_rows: np.ndarray


def added(a: Sums, b: Sums) -> Sums:
    return Sums(*(x + y for x, y in zip(a, b)))


class Part:
    """Rows of one task: bins (features x rows), weights, and the rest that the trees so far leave of the labels."""

    def __init__(self, bins: np.ndarray, weights: np.ndarray, rest: np.ndarray):
        self.bins, self.weights, self.rest = bins, weights, rest
        self.members, self.level = None, 0
        self.leaf_squares = self.leaf_rows = np.zeros(1)

    def _walk(self, paths: Paths, level: int) -> dict[int, np.ndarray]:
        """The rows of each node at ``level`` and of the leaves above; goes on from the level of the last call."""
        if self.members is None:
            self.members, self.level = {0: np.arange(len(self.rest))}, 0
        while self.level < level:
            below = {}
            for node, rows in self.members.items():
                if paths.feature[node] < 0:
                    below[node] = rows
                else:
                    right = self.bins[paths.feature[node]].take(rows) > paths.cut[node]
                    below[2 * node + 1], below[2 * node + 2] = rows.compress(~right), rows.compress(right)
            self.members = below
            self.level += 1
        return self.members

    def _squares_and_rows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        squares, count = np.zeros(size), np.zeros(size, dtype=np.int64)
        each = self.weights * self.rest * self.rest
        for node, rows in self.members.items():
            squares[node], count[node] = each.take(rows).sum(), len(rows)
        return squares, count

    def take(self, paths: Paths, depth: int) -> Part:
        """Takes a finished tree off the rest; the squares and rows of its leaves are those before."""
        members = self._walk(paths, depth)
        self.leaf_squares, self.leaf_rows = self._squares_and_rows(len(paths.feature))
        for node, rows in members.items():
            self.rest[rows] -= paths.step[node]
        self.members = None
        return self

    def measure(self, paths: Paths, level: int, wanted: np.ndarray, bins: int) -> Sums:
        if level == 0:
            self.members = None
        members, n = self._walk(paths, level), len(wanted)
        rows = [members[node] for node in wanted]
        mine = np.concatenate(rows) if rows else np.arange(0)
        place = np.repeat(np.arange(n) * bins, [len(r) for r in rows])
        weights_of = self.weights.take(mine)
        labels = weights_of * self.rest.take(mine)
        sums, weights = np.empty((2, n, len(self.bins), bins))
        for f, row in enumerate(self.bins):
            cell = place + row.take(mine)
            sums[:, f] = np.bincount(cell, labels, n * bins).reshape(n, bins)
            weights[:, f] = np.bincount(cell, weights_of, n * bins).reshape(n, bins)
        return Sums(sums, weights, *self._squares_and_rows(len(paths.feature)), self.leaf_squares, self.leaf_rows)


class Tree:
    """A tree in heap order with the sums of its nodes; ``scale`` times the rest is what it is fitted to."""

    def __init__(self, depth: int, scale: float, weight: float):
        size = 2 ** (depth + 1) - 1
        self.scale, self.weight = scale, weight
        self.feature, self.cut = np.full(size, -1, dtype=np.int32), np.zeros(size, dtype=np.int32)
        self.sums, self.weights, self.squares, self.gain = np.zeros((4, size))
        self.rows = np.zeros(size, dtype=np.int64)

    def value(self) -> np.ndarray:
        return self.scale * np.divide(self.sums, self.weights, out=np.zeros_like(self.sums), where=self.weights > 0)

    def paths(self) -> Paths:
        return Paths(self.feature, self.cut, self.weight * self.value())

    def finish(self, leaf: Sums) -> None:
        """Squares and rows of all nodes from those of the leaves."""
        self.squares, self.rows = leaf.leaf_squares.copy(), leaf.leaf_rows.copy()
        for i in np.flatnonzero(self.feature >= 0)[::-1]:
            self.squares[i], self.rows[i] = (x[2 * i + 1] + x[2 * i + 2] for x in (self.squares, self.rows))

    def nodes(self) -> list[dict]:
        """The nodes as ``pyspark.ml`` saves them (the fields of ``NODE``), numbered parents first."""
        value, out = self.value(), []

        def add(i: int) -> int:
            number, inner = len(out), self.feature[i] >= 0
            out.append(None)
            left, right = (add(2 * i + 1), add(2 * i + 2)) if inner else (-1, -1)
            mean, scale = value[i] / self.scale, self.scale
            impurity = max(0.0, self.squares[i] / self.weights[i] - mean * mean) * scale * scale
            split = dict(zip(SPLIT.names, (int(self.feature[i]), [float(self.cut[i]) + 0.5], -1) if inner else (-1, [], -1)))
            stats = [float(self.weights[i]), float(self.sums[i] * scale), float(self.squares[i] * scale * scale)]
            gain = float(self.gain[i] * scale * scale) if inner else -1.0
            fields = (number, float(value[i]), float(impurity), stats, int(self.rows[i]), gain, left, right, split)
            out[number] = dict(zip(NODE.names, fields))
            return number

        add(0)
        return out


Measure = Callable[[Paths | None, Paths, int, np.ndarray], Sums]


def _best(sums: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """The split of each node that lowers the variance most: feature, last bin on the left, gain, sum and weight on the left."""
    left, left_weight = sums.cumsum(axis=2), weights.cumsum(axis=2)
    right, right_weight = left[:, :, -1:] - left, left_weight[:, :, -1:] - left_weight
    both = (left_weight > 0) & (right_weight > 0)
    # the difference of the means, as the difference of the variances would lose its digits
    apart = np.divide(left, left_weight, out=np.zeros_like(left), where=both) - np.divide(right, right_weight, out=np.zeros_like(left), where=both)
    gain = left_weight * right_weight / left_weight[:, :, -1:] ** 2 * apart * apart
    flat = np.where(both, gain, 0.0).reshape(len(sums), -1)
    at = flat.argmax(axis=1)
    n, bins = np.arange(len(sums)), sums.shape[2]
    feature, cut = at // bins, at % bins
    return feature, cut, flat[n, at], left[n, feature, cut], left_weight[n, feature, cut]


def _grow(measure: Measure, before: Tree | None, depth: int, scale: float, weight: float) -> Tree:
    """One tree, level by level; ``before`` is the last tree, which the rows have not seen yet."""
    tree = Tree(depth, scale, weight)
    wanted = np.array([0])
    nodes = sums = weights = None
    for level in range(max(depth, 1)):
        got = measure(before.paths() if before and level == 0 else None, tree.paths(), level, wanted)
        if level == 0:
            if before:
                before.finish(got)
            nodes, sums, weights = wanted, got.sums, got.weights
            tree.sums[0], tree.weights[0] = sums[0, 0].sum(), weights[0, 0].sum()
        else:
            sisters = ((wanted - 1) ^ 1) + 1
            nodes = np.concatenate([wanted, sisters])
            sums, weights = (np.concatenate([x, whole - x]) for x, whole in ((got.sums, sums), (got.weights, weights)))
        mean = tree.sums[nodes] / tree.weights[nodes]
        impurity = (got.squares[nodes] / tree.weights[nodes] - mean * mean) * scale * scale
        feature, cut, gain, left, left_weight = _best(sums, weights)
        split = (impurity >= EQUAL) & (gain > 0) & (level < depth)
        if not split.any():
            break
        nodes, sums, weights, left, left_weight = (x[split] for x in (nodes, sums, weights, left, left_weight))
        tree.feature[nodes], tree.cut[nodes], tree.gain[nodes] = feature[split], cut[split], gain[split]
        tree.sums[2 * nodes + 1], tree.weights[2 * nodes + 1] = left, left_weight
        tree.sums[2 * nodes + 2], tree.weights[2 * nodes + 2] = tree.sums[nodes] - left, tree.weights[nodes] - left_weight
        wanted = np.where(left_weight <= tree.weights[nodes] - left_weight, 2 * nodes + 1, 2 * nodes + 2)
    return tree


def boost(measure: Measure, trees: int, rate: float, depth: int) -> list[Tree]:
    done: list[Tree] = []
    for i in range(trees):
        scale, weight = (2.0, rate) if i else (1.0, 1.0)
        done.append(_grow(measure, done[-1] if done else None, depth, scale, weight))
    done[-1].finish(measure(done[-1].paths(), Tree(depth, 1.0, 1.0).paths(), 0, np.array([], dtype=int)))
    return done


def _part(batches: Iterator[pa.RecordBatch]) -> Part | None:
    """The rows of a task: the bins, then label and weight."""
    columns: list[list[np.ndarray]] = []
    for batch in batches:
        *bins, label, weight = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        columns.append([np.array(bins, dtype=np.uint8), label, weight])
    if not columns:
        return None
    bins, label, weight = (np.concatenate(x, axis=-1) for x in zip(*columns))
    if not np.isfinite(label).all():
        raise ValueError("labels must be finite")
    return Part(bins, weight, label)


def _blob(value: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(value)], pa.binary())], ["value"])


def _in_task(batches: Iterator[pa.RecordBatch], trees: int, rate: float, depth: int, bins: int) -> Iterator[pa.RecordBatch]:
    part = _part(batches)
    if part is None:
        return

    def measure(before: Paths | None, paths: Paths, level: int, wanted: np.ndarray) -> Sums:
        if before:
            part.take(before, depth)
        return part.measure(paths, level, wanted, bins)

    yield _blob(boost(measure, trees, rate, depth))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = _part(batches)
    if part is not None:
        yield _blob(part)


def _over_parts(rows: DataFrame, parts: int, trees: int, rate: float, depth: int, bins: int, trees_per_checkpoint: int) -> list[Tree]:
    """The rest of the labels moves on with each tree, as an RDD kept by the executors and cut off by checkpoints."""
    stored = StorageLevel.MEMORY_AND_DISK
    state = rows.repartition(parts).mapInArrow(_packed, "value binary").rdd.map(lambda r: pickle.loads(r.value)).persist(stored)
    taken = 0

    def measure(before: Paths | None, paths: Paths, level: int, wanted: np.ndarray) -> Sums:
        nonlocal state, taken
        old = None
        if before:
            old, state = state, state.map(lambda part: part.take(before, depth)).persist(stored)
            taken += 1
            if taken % trees_per_checkpoint == 0:
                state.checkpoint()
        told = state.map(lambda part: part.measure(paths, level, wanted, bins))
        out = told.treeReduce(added) if parts > PARTS_TO_DRIVER else reduce(added, told.collect())
        if old is not None:
            old.unpersist()
        return out

    try:
        return boost(measure, trees, rate, depth)
    finally:
        state.unpersist()


def fit(cells: DataFrame, booster: GBTRegressor, columns: list[str], parts: int) -> GBTRegressionModel:
    """The model of ``booster`` on ``cells``: bins 0, 1, ... in ``columns``, its label and its weight; in one task or in ``parts``."""
    rows = cells.select(*columns, booster.getLabelCol(), booster.getWeightCol())
    trees, rate, depth, bins = booster.getMaxIter(), booster.getStepSize(), booster.getMaxDepth(), booster.getMaxBins()
    if parts == 1:
        options = {"trees": trees, "rate": rate, "depth": depth, "bins": bins}
        found = rows.coalesce(1).mapInArrow(partial(_in_task, **options), "value binary").first()
        grown = pickle.loads(found.value)
    else:
        grown = _over_parts(rows, parts, trees, rate, depth, bins, booster.getCheckpointInterval())
    return _model(cells.sparkSession, booster, grown, len(columns))


def _model(spark: SparkSession, booster: GBTRegressor, grown: list[Tree], features: int) -> GBTRegressionModel:
    """The trees as a model of ``pyspark.ml``, through its files: building it node by node would be a call to the JVM for each value."""

    def named(found: dict) -> dict:
        return {p.name: value for p, value in found.items()}

    def told(kind: str, uid: str, **more: object) -> str:
        head = {"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
        return json.dumps({**head, "paramMap": {}, "defaultParamMap": {}, **more})

    folder = run_folder(spark, "boosters")
    settings = {"paramMap": named(booster._paramMap), "defaultParamMap": named(booster._defaultParamMap)}
    whole = told("GBTRegressionModel", booster.uid, numFeatures=features, numTrees=len(grown), **settings)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{folder}/metadata")
    each = [(i, told("DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}"), float(t.weight)) for i, t in enumerate(grown)]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/treesMetadata")
    of, nodes = zip(*((i, node) for i, tree in enumerate(grown) for node in tree.nodes()))
    table = pa.table({"treeID": pa.array(of, pa.int32()), "nodeData": pa.array(nodes, NODE)})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{folder}/data")
    return GBTRegressionModel.load(folder)
