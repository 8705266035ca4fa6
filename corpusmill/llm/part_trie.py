"""Vector codes: a codebook per part, with distances shared along a trie of distinct parts.

Vectors are whole numbers, cut into equal consecutive parts. The distinct parts that a task
meets at one position, in lexicographic order, are the leaves of a trie, one component a
level. A depth-first walk in that order gives every node one vector: the squared distance
of its prefix from the same prefix of each codebook entry. A node adds one term to its
parent's vector, so parts that begin alike share the work on what they have in common, and
repeated parts are met once. At the leaves the vectors are the squared distances of whole
parts: the least one names the entry, and the leaf's components times its number of
occurrences go into that entry's sums.

The walk takes the leaves in stretches of ``STRETCH``, level by level inside a stretch, and
carries the last path on to the next one, so memory does not depend on the number of parts.
Tasks give counts and sums per entry; nothing but those and the codebooks (entries x
components, whatever the table holds) leaves them, and no vector is shuffled.

Defined results: vectors that are NULL or hold NULL or non-finite components are dropped, as
are those of another length than the vector with the smallest id has; that length must be a
multiple of the number of parts. With fewer vectors than entries, codebooks are smaller.
Equal ids go by their components, NULL ids come last. An entry without parts stays. Repeated
rows each count. An empty table gives an empty result. Components of 2**18 or more are an
error. Columns other than the id, vector and label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
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

STRETCH = 2048
CHUNK_ROWS = 32_768


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, how often each occurs, and each row's place."""
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    first = np.flatnonzero(new)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[first], np.diff(np.append(first, len(parts))), place


def walk(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the smaller number) and squared distance of every leaf.

    ``leaves`` are distinct and in lexicographic order.
    """
    nearest, least = np.empty(len(leaves), np.int64), np.empty(len(leaves), np.int64)
    path: list[np.ndarray] = []
    for begin in range(0, len(leaves), STRETCH):
        block = leaves[begin : begin + STRETCH]
        # Depth of the common prefix with the leaf before; the first one follows the last
        # leaf of the stretch before.
        before = leaves[begin - 1 : begin - 1 + len(block)] if begin else np.vstack([block[:1] - 1, block[:-1]])
        shared = (block == before).cumprod(axis=1).sum(axis=1)
        above = np.zeros((1, len(book)), np.int64)
        parent = np.zeros(len(block), np.int64)
        for depth in range(leaves.shape[1]):
            # A node of this depth begins where the prefix up to it is new.
            new = shared <= depth
            kept = 0 if new[0] else 1
            first = np.flatnonzero(new)
            node = np.cumsum(new) - 1 + kept
            step = block[first, depth, None] - book[:, depth]
            own = above[parent[first]] + step * step
            level = np.concatenate([path[depth][None], own]) if kept else own
            path[depth : depth + 1] = [level[-1].copy()]
            above, parent = level, node
        found = above.argmin(axis=1)[parent]
        nearest[begin : begin + len(block)] = found
        least[begin : begin + len(block)] = above[parent, found]
    return nearest, least


def coded(df: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[DataFrame, np.ndarray]:
    """``id, label, codes, error`` of every kept vector, and the codebooks.

    ``codes`` is an array with an entry number per part; ``error`` the squared distance of
    the vector from what its codes stand for. Codebooks are an array of the shape parts,
    entries, components of a part.
    """
    spark = df.sparkSession
    rows = df.where(finite(F.col(vector_col))).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), whole_components(F.col(vector_col)).alias("vector")
    )
    leading = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(1).collect()
    width = len(leading[0]["vector"]) if leading else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    rows = stage(rows.where(F.size("vector") == width), "whole_vectors")
    if not width:
        return rows.select("id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("bigint").alias("error")).limit(0), np.zeros((parts, 0, 0), np.int64)
    each = width // parts
    # A fixed number of rows: the codebooks to begin with.
    start = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    books = np.array([r["vector"] for r in start], np.int64).reshape(len(start), parts, each).transpose(1, 0, 2)
    size = len(start)
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(books)

        def sums(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            counts, totals = np.zeros(parts * size, np.int64), np.zeros((parts * size, each), np.int64)
            for table in chunks(batches, CHUNK_ROWS):
                vectors = matrix(table.column("vector").combine_chunks(), width)
                for part, book in enumerate(held.value):
                    leaves, times, _ = distinct_parts(vectors[:, part * each : (part + 1) * each])
                    nearest, _ = walk(leaves, book)
                    np.add.at(counts, part * size + nearest, times)
                    np.add.at(totals, part * size + nearest, leaves * times[:, None])
            yield partial_rows(counts, totals)

        counts, totals = added_up(rows.select("vector").mapInArrow(sums, PARTIAL), parts * size, each)
        books = floor_means(totals, counts, books.reshape(-1, each)).reshape(parts, size, each)
        held.destroy()
    final = spark.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, CHUNK_ROWS):
            vectors = matrix(table.column("vector").combine_chunks(), width)
            codes = np.empty((len(vectors), parts), np.int32)
            error = np.zeros(len(vectors), np.int64)
            for part, book in enumerate(final.value):
                leaves, _, place = distinct_parts(vectors[:, part * each : (part + 1) * each])
                nearest, least = walk(leaves, book)
                codes[:, part] = nearest[place]
                error += least[place]
            yield from (
                table.select(["id", "label"])
                .append_column("codes", lists(codes))
                .append_column("error", pa.array(error))
                .to_batches()
            )

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(assign, f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error long"), books


def code_text(codes: Column) -> Column:
    """Entry numbers as two lower-case hexadecimal digits each."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
    return sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


def with_label_error(found: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors of all vectors of the same label, NULLs together.

    Errors are added per label before they meet the rows, so a label that most rows have
    costs one row a task. ``found`` should be staged; it is read twice.
    """
    totals = found.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return found.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
