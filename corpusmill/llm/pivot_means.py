"""Centroid clustering with a table of distances to fixed pivots (LAESA).

Vectors are whole numbers. A few pivots are fixed once, far apart among the centroids to
begin with, and the distance of every vector to every pivot is stored beside it. In each
round the centroids' distances to the pivots are found on the driver (centroids x pivots).
By the triangle inequality no centroid is nearer to a vector than the largest difference of
their distances to one pivot. A vector is measured exactly against the centroid with the
least such bound; only centroids whose bound does not exceed that distance survive and are
measured too, in 64-bit whole numbers. Bounds are doubles and get a margin far above their
rounding error, so no nearest centroid, tied or not, is lost.

Tasks give counts and sums per centroid, so a round moves centroids x components numbers a
task and no vector; the driver gets one row per centroid.

Defined results: vectors without exactly ``size`` components, or with NULL or non-finite
ones, are dropped. Centroids begin as the vectors with the smallest hashes of their ids;
equal ids go by components, and rows without an id only when there are too few others. With
fewer vectors than centroids there are fewer clusters. A centroid without vectors stays.
Repeated rows each count. An empty table gives an empty result. Components of 2**18 or more
are an error. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.integer_vectors import (
    PARTIAL,
    added_up,
    chunks,
    finite,
    floor_means,
    lists,
    matrix,
    partial_rows,
    whole_components,
)
from corpusmill.plans.staging import stage

PIVOTS = 12
CHUNK_ROWS = 16_384
MARGIN = 1e-6


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of matching rows."""
    step = a - b
    return np.einsum("...k,...k->...", step, step)


def far_apart(candidates: np.ndarray, count: int) -> np.ndarray:
    """Rows chosen one after another, each the farthest from those before it."""
    if not len(candidates):
        return candidates
    chosen = [0]
    nearest = squared(candidates, candidates[0])
    while len(chosen) < min(count, len(candidates)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(candidates, candidates[chosen[-1]]))
    return candidates[chosen]


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(squared(vectors, p).astype(np.float64)) for p in pivots], axis=1)


def nearest_centroid(vectors: np.ndarray, stored: np.ndarray, centroids: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number), squared distance, and pairs measured.

    ``stored`` holds the vectors' distances to the pivots, ``known`` the centroids'.
    """
    bound = np.abs(stored[:, None, 0] - known[None, :, 0])
    for p in range(1, stored.shape[1]):
        np.maximum(bound, np.abs(stored[:, None, p] - known[None, :, p]), out=bound)
    rows = np.arange(len(vectors))
    first = bound.argmin(axis=1)
    best = squared(vectors, centroids[first])
    reach = np.sqrt(best.astype(np.float64)) * (1 + MARGIN) + MARGIN
    alive = bound <= reach[:, None]
    alive[rows, first] = False
    where, which = np.nonzero(alive)
    exact = np.full(bound.shape, np.iinfo(np.int64).max, np.int64)
    exact[rows, first] = best
    for begin in range(0, len(where), CHUNK_ROWS * 8):
        i, j = where[begin : begin + CHUNK_ROWS * 8], which[begin : begin + CHUNK_ROWS * 8]
        exact[i, j] = squared(vectors[i], centroids[j])
    found = exact.argmin(axis=1)
    return found, exact[rows, found], len(where) + len(vectors)


def clustered(df: DataFrame, id_col: str, vector_col: str, size: int = 64, centroids: int = 40, rounds: int = 5, seed: int = 2) -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` (squared) of every kept vector, and the final centroids."""
    spark = df.sparkSession
    kept = df.where(finite(F.col(vector_col)) & (F.size(vector_col) == size))
    rows = kept.select(F.col(id_col).alias("id"), whole_components(F.col(vector_col)).alias("vector"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    # A fixed number of rows.
    start = rows.orderBy(order.asc_nulls_last(), "vector").select("vector").limit(centroids).collect()
    centres = np.array([r["vector"] for r in start], np.int64).reshape(-1, size)
    kind = dict(rows.dtypes)["id"]
    if not len(centres):
        none = rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return none.limit(0), centres
    pivots = far_apart(centres, PIVOTS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = pivot_distances(matrix(batch.column("vector"), size), pivots)
                yield pa.RecordBatch.from_arrays([*batch.columns, lists(far)], ["id", "vector", "far"])

    table = stage(rows.mapInArrow(measure, f"id {kind}, vector array<int>, far array<double>"), "pivot_table")

    def searched(batches: Iterator[pa.RecordBatch], held) -> Iterator[tuple]:
        centres = held.value
        known = pivot_distances(centres, pivots)
        for chunk in chunks(batches, CHUNK_ROWS):
            vectors = matrix(chunk.column("vector").combine_chunks(), size)
            stored = chunk.column("far").combine_chunks().flatten().to_numpy().reshape(len(vectors), -1)
            yield chunk, vectors, *nearest_centroid(vectors, stored, centres, known)[:2]

    for _ in range(rounds):
        held = spark.sparkContext.broadcast(centres)

        def sums(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            counts, totals = np.zeros(len(held.value), np.int64), np.zeros(held.value.shape, np.int64)
            for _, vectors, found, _ in searched(batches, held):
                order = np.argsort(found, kind="stable")
                used, first = np.unique(found[order], return_index=True)
                counts[used] += np.diff(np.append(first, len(found)))
                totals[used] += np.add.reduceat(vectors[order], first, axis=0)
            yield partial_rows(counts, totals)

        counts, totals = added_up(table.select("vector", "far").mapInArrow(sums, PARTIAL), len(centres), size)
        centres = floor_means(totals, counts, centres)
        held.destroy()
    final = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, found, distance in searched(batches, final):
            own = chunk.select(["id"]).append_column("cluster", pa.array(found.astype(np.int32)))
            yield from own.append_column("distance", pa.array(distance)).to_batches()

    return table.mapInArrow(assign, f"id {kind}, cluster int, distance long"), centres


def with_inertia(found: DataFrame, centres: np.ndarray) -> DataFrame:
    """Add ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    ``found`` should be staged; it is read twice. The totals are one row per cluster.
    """
    spark = found.sparkSession
    digests = [(k, sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centres.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    each = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = found.agg(F.coalesce(F.sum("distance"), F.lit(0)).cast("bigint")).scalar()
    return found.join(F.broadcast(each.join(F.broadcast(named), "cluster")), "cluster").withColumn("inertia", whole)
