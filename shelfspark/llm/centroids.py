"""Clustering of integer vectors around centroids; the nearest one is found by the threshold algorithm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfspark.llm.common import stored

DIMENSIONS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Vectors that are compared at a time; bounds the memory of a task.
BLOCK = 1024
#: Components must be below this in size, so that squared distances fit 64 bits.
LARGEST = 1 << 27


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each vector the number of the nearest centroid (of equal ones the smallest), its squared distance, and the
    distances that were computed for it.

    Threshold algorithm: the centroids are listed by value in each dimension. All lists are walked outward from the
    vector's own values, always to the nearer side; a centroid that comes up first in any list gets its exact distance.
    A centroid that has not come up differs in every dimension by the gap at the list's frontier at least, so the walk
    ends once the sum of the squared gaps is larger than the best exact distance: an equal one may still hide a tie.
    """
    n, k = len(vectors), len(centroids)
    dims = np.arange(vectors.shape[1])
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    high = np.stack([np.searchsorted(values[:, d], vectors[:, d]) for d in dims], axis=1)
    low = high - 1
    best = np.full(n, np.iinfo(np.int64).max)
    who = np.full(n, k)
    seen = np.zeros((n, k), dtype=bool)
    active = np.arange(n)
    endless = np.int64(1) << 31  # beyond any gap, and 64 of its squares overflow nothing that is used
    while len(active):
        v, lo, hi = vectors[active], low[active], high[active]
        below = np.where(lo >= 0, v - values[np.maximum(lo, 0), dims], endless)
        above = np.where(hi < k, values[np.minimum(hi, k - 1), dims] - v, endless)
        down = below <= above
        gap = np.where(down, below, above)
        there = gap < endless
        at = np.where(down, np.maximum(lo, 0), np.minimum(hi, k - 1))
        low[active], high[active] = lo - (down & there), hi + (~down & there)
        fresh = np.zeros((len(active), k), dtype=bool)
        rows, cols = np.nonzero(there)
        fresh[rows, order[at[rows, cols], cols]] = True
        fresh &= ~seen[active]
        seen[active] |= fresh
        rows, found = np.nonzero(fresh)
        exact = ((v[rows] - centroids[found]) ** 2).sum(axis=1)
        # the smallest distance of each vector, then the smallest number
        first = np.lexsort((found, exact, rows))
        rows, found, exact = rows[first], found[first], exact[first]
        top = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, dtype=bool)
        mine, found, exact = active[rows[top]], found[top], exact[top]
        better = (exact < best[mine]) | ((exact == best[mine]) & (found < who[mine]))
        best[mine[better]], who[mine[better]] = exact[better], found[better]
        frontier = np.where(there.all(axis=1), (gap * gap * there).sum(axis=1), 0)
        done = seen[active].all(axis=1) | (there.all(axis=1) & (frontier > best[active]))
        active = active[~done]
    return who, best, seen.sum(axis=1)


def whole_vectors(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMENSIONS) -> DataFrame:
    """Id and integer components ``v`` of the vectors with exactly ``dims`` components, none null or not finite."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    fits = F.forall("v", lambda c: (c < LARGEST) & (c > -LARGEST))
    kept = table.filter((F.size(x) == dims) & finite).select(F.col(id_col).alias("vec_id"), whole.alias("v"))
    told = F.raise_error(F.concat(F.lit("a component is too large for exact distances, vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))))
    return kept.select("vec_id", F.when(fits, F.col("v")).otherwise(told).cast("array<int>").alias("v"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED, dims: int = DIMENSIONS) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids, of equal ones that with the smaller components; fewer if there are fewer."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], dtype=np.int64).reshape(len(rows), dims)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(batch), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            yield batch.slice(at, BLOCK)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of their vectors; one without vectors stays.

    Each task adds up its vectors, so what moves and what the driver gets is bounded by centroids x dimensions.
    """
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for block in _blocks(batches):
            v = _matrix(block)
            who, _, _ = nearest(v, centroids)
            np.add.at(total, who, v)
            count += np.bincount(who, minlength=k)
        there = np.nonzero(count)[0]
        if len(there):
            yield pa.RecordBatch.from_arrays(
                [pa.array(there, pa.int32()), pa.array(count[there]), *[pa.array(total[there, d]) for d in range(dims)]],
                ["cluster", "n", *[f"s{d}" for d in range(dims)]],
            )

    parts = vectors.select("v").mapInArrow(sums, "cluster int, n long, " + ", ".join(f"s{d} long" for d in range(dims)))
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col(f"s{d}").cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)]).collect()
    out = centroids.copy()
    for r in rows:
        out[r.cluster] = [int(r[f"s{d}"]) // r.n for d in range(dims)]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Id, ``cluster`` and squared ``distance`` of each vector."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            who, far, _ = nearest(_matrix(block), centroids)
            yield pa.RecordBatch.from_arrays([block.column("vec_id"), pa.array(who, pa.int32()), pa.array(far)], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(found, f"vec_id {dict(vectors.dtypes)['vec_id']}, cluster int, distance long")


def centroid_clusters(
    table: DataFrame, *, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMENSIONS, **columns
) -> DataFrame:
    """One row per whole vector: id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Vectors are turned to integers and written once; each round is one pass over them that moves only sums. The driver
    and each task hold the centroids, k x dimensions integers.

    Vectors of another length or with null, NaN or infinite components are left out; a null id is hashed as an empty one;
    repeated rows are clustered each; of equally near centroids the smaller number wins; with fewer than ``k`` vectors
    there are fewer centroids; an empty table gives no rows. Components of 2^19 and above are refused, as squared
    distances would not fit 64 bits.
    """
    spark = table.sparkSession
    vectors = stored(whole_vectors(table, dims=dims, **columns), "centroid-vectors")
    kind = dict(vectors.dtypes)["vec_id"]
    centroids = first_centroids(vectors, k, seed, dims)
    if not len(centroids):
        return spark.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    rows = stored(assigned(vectors, centroids), "centroid-clusters")
    # one row per centroid: at most k
    each = {r.cluster: r.inertia for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    names = [(c, each.get(c, 0), ",".join(map(str, centroid.tolist()))) for c, centroid in enumerate(centroids)]
    told = spark.createDataFrame(names, "cluster int, cluster_inertia long, _name string")
    return rows.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(each.values())).cast("long").alias("inertia"),
        F.sha2("_name", 256).alias("centroid_sha256"),
    )
