"""Flat token files: ids as unsigned integers, 64-bit document offsets, memory-mapped.

Documents are range-partitioned by id. Each task streams its documents, in order, into
three files: ``ids`` (16 bits per id if the vocabulary allows, else 32), ``ends`` (the
number of ids up to each document's end, 64 bits, counted inside the part) and ``docs``
(the 64-bit document ids, with one byte each that says whether there is one). The start
of a part in the whole stream is the prefix sum of the parts before it.

Defined results: a NULL text is empty and has only the end id; a NULL id sorts first;
rows with equal ids are ordered by text; an empty table gives no parts; other columns are
not read. A retried task writes under its own name and then replaces its files.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import unquote, urlparse
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.encoding import PieceEncoder
from corpusmill.plans.staging import new_path, stage
from corpusmill.sources.files import PendingObject, open_folder

PARTS = "part long, docs long, ids long, width int"
BATCH_CHARS = 1 << 20


def batches_of(column: Iterator[tuple], size: int = BATCH_CHARS) -> Iterator[list[tuple]]:
    """Group rows ``(key, text)`` so that a group has about ``size`` characters."""
    group, held = [], 0
    for row in column:
        group.append(row)
        held += len(row[1])
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def write_token_files(
    docs: DataFrame, root: str, vocabulary: str, end_id: int, id_col: str, text_col: str,
    added_tokens: bool = False,
) -> DataFrame:
    """Encode ``docs`` into files below ``root``; returns one row ``PARTS`` per part.

    ``vocabulary`` is a tokenizers file that every executor can read. With ``added_tokens``
    the vocabulary's added tokens are recognised in texts, else they are plain text.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(vocabulary, added_tokens)
        width = 2 if max(encoder.size - 1, end_id) < 1 << 16 else 4
        task = TaskContext.get()
        part, out, docs_seen, ids_seen = task.partitionId(), None, 0, 0
        rows = (
            (key, text)
            for batch in batches
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        )
        for group in batches_of(rows):
            if out is None:
                attempt = task.taskAttemptId()
                out = [PendingObject(root, f"{n}-{part:06d}.bin", attempt) for n in ("ids", "ends", "docs")]
            ids = [np.append(x, np.uint32(end_id)) for x in encoder.encode([t for _, t in group])]
            ends = ids_seen + np.cumsum([len(x) for x in ids])
            keys = np.zeros(len(group), [("id", "<i8"), ("there", "u1")])
            keys["there"] = [k is not None for k, _ in group]
            keys["id"] = [k or 0 for k, _ in group]
            out[0].write(np.concatenate(ids).astype(f"<u{width}").tobytes())
            out[1].write(ends.astype("<u8").tobytes())
            out[2].write(keys.tobytes())
            docs_seen, ids_seen = docs_seen + len(group), int(ends[-1])
        if out is not None:
            for pending in out:
                pending.publish()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "docs": [docs_seen], "ids": [ids_seen], "width": pa.array([width], pa.int32())}
            )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    ordered = rows.repartitionByRange("id").sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    return stage(ordered.mapInArrow(write, PARTS), "token-parts")


def part_starts(parts: DataFrame) -> DataFrame:
    """``start`` of each part: the ids of all parts before it. One row per written part."""
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _mapped(root: str, name: str, kind: np.dtype) -> np.ndarray:
    """A file as an array: memory-mapped where the store is a mounted folder."""
    if root.startswith("file:") or "://" not in root:
        path = unquote(urlparse(root).path) if root.startswith("file:") else root
        return np.memmap(os.path.join(path, name), kind, "r")
    files, folder = open_folder(root)
    with files.open_input_file(f"{folder}/{name}") as stream:
        return np.frombuffer(stream.read_buffer(), kind)


def read_token_files(spark: SparkSession, parts: DataFrame, root: str) -> DataFrame:
    """Each document as its files have it: ``id, start, n_tokens, ids_crc32``.

    The checksum is over the ids as little-endian unsigned 32-bit integers.
    """
    schema = "id long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from read_part(row)

    def read_part(row: dict) -> Iterator[pa.RecordBatch]:
        part = f"-{row['part']:06d}.bin"
        ids = _mapped(root, "ids" + part, np.dtype(f"<u{row['width']}"))
        ends = _mapped(root, "ends" + part, np.dtype("<u8"))
        keys = _mapped(root, "docs" + part, np.dtype([("id", "<i8"), ("there", "u1")]))
        if len(ids) != row["ids"] or len(ends) != row["docs"] or len(keys) != row["docs"]:
            raise RuntimeError(f"part {row['part']} is not as long as its manifest says")
        for k in range(0, len(ends), 1024):
            stop = ends[k : k + 1024].astype(np.int64)
            first = np.concatenate([[int(ends[k - 1]) if k else 0], stop[:-1]])
            sums = [crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(first, stop, strict=True)]
            own = keys[k : k + 1024]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own["id"], pa.int64(), mask=own["there"] == 0),
                    pa.array(first + row["start"], pa.int64()),
                    pa.array(stop - first, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["id", "start", "n_tokens", "ids_crc32"],
            )

    placed = part_starts(parts)
    # One row per part, dealt out so that parts are read in parallel; without a number the
    # few bytes would be put back into one task.
    spread = placed.repartition(max(1, parts.count()), "part")
    return spread.mapInArrow(read, schema)


def token_folder(spark: SparkSession) -> str:
    return new_path(spark, "tokens")
