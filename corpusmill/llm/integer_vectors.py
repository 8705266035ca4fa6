"""Vectors as whole numbers: filters, components and exact sums shared by two operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
# Whole components stay below 2**26, so that squared distances of 64 components and their
# sums over many vectors fit 64 bits. Larger ones are an error, not a wrong sum.
LIMIT = 1 << 18


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its components is null or not finite."""
    values = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & sound, F.lit(False))


def whole_components(vector: Column) -> Column:
    """``floor(256 * x)`` of every component ``x``, taken as a double."""
    problem = F.raise_error(F.lit(f"vector components must be below {LIMIT}")).cast("int")

    def whole(x: Column) -> Column:
        x = x.cast("double")
        return F.when(F.abs(x) < LIMIT, F.floor(x * SCALE).cast("int")).otherwise(problem)

    return F.transform(vector, whole)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of equally long integer lists as rows of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def lists(rows: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Rows of a matrix as a column of lists."""
    ends = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel(), kind))


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together to tables of about ``rows`` rows; never empty ones."""
    held, count = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, count = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def floor_means(sums: np.ndarray, counts: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Componentwise ``floor(sum / count)``; rows without members stay as they were."""
    means = np.floor_divide(sums, np.maximum(counts, 1)[:, None])
    return np.where(counts[:, None] > 0, means, old)


def added_up(partial: DataFrame, groups: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums per group from the partial rows ``number, n, sums`` of the tasks.

    Spark adds the partial rows; the driver gets one row per group, a number that the
    number of vectors does not change.
    """
    totals = [F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(width)]
    rows = partial.groupBy("number").agg(F.sum("n").alias("n"), *totals).collect()
    counts, sums = np.zeros(groups, np.int64), np.zeros((groups, width), np.int64)
    for row in rows:
        counts[row["number"]] = row["n"]
        sums[row["number"]] = [row[f"s{k}"] for k in range(width)]
    return counts, sums


def partial_rows(counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """What one task adds to each group; groups without members are left out."""
    used = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(counts[used]), lists(sums[used], pa.int64())],
        ["number", "n", "sums"],
    )


PARTIAL = "number int, n long, sums array<long>"
