"""Centroid clustering of whole-number vectors over a distance matrix that is kept and updated.

A vector is stored with its exact dot product with every centroid. When the
centroids move, a round adds to each product only what the changed components
contribute; a centroid that stays costs nothing. The squared distance is
``|x|^2 - 2 x.c + |c|^2``, so the nearest centroid follows from the products
and the centroids' own norms. Sums of a cluster are Spark aggregates with
map-side combine; what meets on the driver is one row of sums for each
centroid, whatever the table holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentsift.llm.common import forget, stored

SCALE, SIZE, CLUSTERS, ROUNDS, SEED = 256, 64, 40, 5, 2

#: A squared distance of 64 components must fit a long, so no component may be larger than this.
LARGEST = 1 << 27

STATE = "vec_id bigint, x array<int>, dots array<bigint>, cluster int, distance bigint"
_EXACT_DOUBLE = 1 << 53


def whole_vectors(rows: DataFrame, *, scale: int = SCALE, size: int = SIZE) -> DataFrame:
    """``vec_id, x`` with components ``floor(scale * component)`` of the vectors that take part.

    A vector takes no part when it is null, has another length, or holds a
    component that is null, not finite, or so large that a squared distance
    would not fit a long.
    """
    vector = F.col("embedding")
    scaled = F.transform(vector, lambda v: F.floor(v.cast("double") * scale))
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double") * scale) >= float(LARGEST)))
    kept = rows.where((F.size(vector) == size) & ~F.coalesce(bad, F.lit(True)))
    return kept.select(F.col("vec_id").cast("long"), F.transform(scaled, lambda v: v.cast("int")).alias("x"))


def first_centroids(vectors: DataFrame, *, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:vec_id``, in that order; equal ids go by their components.

    Vectors without an id are clustered but start no centroid.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where(F.col("vec_id").isNotNull()).orderBy(digest, "x").limit(clusters)
    return [list(row["x"]) for row in first.collect()]


def _product(x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Exact ``x @ change``, in doubles where every sum stays a whole number of a double."""
    bound = int(np.abs(x).max(initial=0)) * int(np.abs(change).max(initial=0)) * max(1, len(change))
    if bound < _EXACT_DOUBLE:
        return (x.astype(np.float64) @ change.astype(np.float64)).astype(np.int64)
    return x @ change


def _move(state: DataFrame, change: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """Products after the centroids' change, and the nearest centroid of each vector."""
    moved = [(k, np.flatnonzero(change[k])) for k in range(len(change)) if change[k].any()]
    norms = (centroids * centroids).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)
            dots = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1).copy()
            for k, places in moved:
                dots[:, k] += _product(x[:, places], change[k, places])
            # Without |x|^2, which is the same for all; argmin takes the smaller number of a tie.
            relative = norms[None, :] - 2 * dots
            cluster = relative.argmin(axis=1)
            distance = relative[np.arange(n), cluster] + (x * x).sum(axis=1)
            offsets = pa.array(np.arange(0, dots.size + 1, dots.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.ListArray.from_arrays(offsets, pa.array(dots.ravel(), pa.int64())),
                    pa.array(cluster, pa.int32()),
                    pa.array(distance, pa.int64()),
                ],
                names=["vec_id", "x", "dots", "cluster", "distance"],
            )

    return state.select("vec_id", "x", "dots").mapInArrow(run, STATE)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: floored means of their vectors; a centroid without vectors stays."""
    sums = [F.sum(F.get("x", F.lit(j)).cast("decimal(38,0)")).alias(f"x{j}") for j in range(centroids.shape[1])]
    after = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        after[row["cluster"]] = [int(row[f"x{j}"]) // row["n"] for j in range(centroids.shape[1])]
    return after


def centroid_clusters(
    rows: DataFrame, *, scale: int = SCALE, size: int = SIZE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, x, dots, cluster, distance`` of each vector that takes part, and the final centroids.

    ``rows`` need ``vec_id`` and ``embedding``; other columns are not read.
    See ``whole_vectors`` for nulls and odd values. Rows that repeat count as
    often as they occur, and ties go to the smaller number. With fewer vectors
    than ``clusters`` each starts a centroid; a table without any, or without
    an id, gives no rows and no centroids. The matrix is stored once a round.
    """
    vectors = whole_vectors(rows, scale=scale, size=size)
    first = first_centroids(vectors, clusters=clusters, seed=seed)
    if not first:
        return rows.sparkSession.createDataFrame([], STATE), []
    centroids = np.array(first, np.int64)
    before = np.zeros_like(centroids)
    state = vectors.withColumn("dots", F.array_repeat(F.lit(0).cast("long"), len(first)))
    for turn in range(rounds + 1):
        moved = stored(_move(state, centroids - before, centroids), "distances")
        if turn:
            forget(state)
        state = moved
        if turn < rounds:
            before, centroids = centroids, _means(state, centroids)
    return state, centroids.tolist()


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Assigned vectors with the distances summed over their cluster and over all, and the digest of their centroid.

    The sums are one row for each centroid, so they come back as literals.
    """
    sums = {row["cluster"]: int(row["s"]) for row in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def by_cluster(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))

    empty = not centroids
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        (F.lit(None) if empty else by_cluster([sums.get(k, 0) for k in range(len(centroids))])).cast("long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        (F.lit(None) if empty else by_cluster([centroid_digest(c) for c in centroids])).cast("string").alias("centroid_sha256"),
    )
