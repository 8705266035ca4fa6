"""Shard objects: checksums, writing, listing and verification."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.plans.staging import qualified
from corpusmill.sources.files import PendingObject

# Bytes one task should hash or write.
TASK_BYTES = 512 * 1024 * 1024

_DIGESTS = (
    "source_id string, shard_sequence bigint, size_bytes bigint, record_count bigint, "
    "last_pos bigint, checksum string"
)
_OBJECTS = _DIGESTS + ", object_key string, stored_size_bytes bigint"


def shard_order(tagged: DataFrame, shards: int | None = None) -> DataFrame:
    """Bring the records of each shard together in order: the one shuffle of the payloads.

    A shard is bounded by its target size, so no partition can grow with a hot source.
    ``shards`` is their number; with it, tasks get about :data:`TASK_BYTES` each.
    """
    keys = ["source_id", "shard_sequence"]
    parted = tagged.repartition(shards, *keys) if shards else tagged.repartition(*keys)
    return parted.sortWithinPartitions(*keys, "pos")


def task_count(borders: DataFrame) -> int:
    """Tasks for :func:`shard_order`, from a staged table of shard borders."""
    total, shards = borders.agg(F.sum("size_bytes"), F.count("*")).first()
    spark = borders.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return max(min(shards, max(math.ceil((total or 0) / TASK_BYTES), cores)), 1)


def shard_stats(tagged: DataFrame, payload: Column, tasks: int | None = None) -> DataFrame:
    """Bytes, records, last position and SHA-256 of every shard, without storing it."""
    records = shard_order(tagged, tasks).select(
        "source_id", "shard_sequence", "pos", _line(payload).alias("line")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current = None
        for key, last_pos, count, data in _runs(batches):
            if current is None or current[0] != key:
                if current is not None:
                    done.append(_digest_row(current))
                current = [key, hashlib.sha256(), 0, 0, 0]
            current[1].update(data)
            current[2] += len(data)
            current[3] += count
            current[4] = last_pos
        if current is not None:
            done.append(_digest_row(current))
        yield _batch(done, _DIGESTS)

    return records.mapInArrow(digest, _DIGESTS)


def write_shards(
    tagged: DataFrame,
    payload: Column,
    object_key: Column,
    root: str,
    tasks: int | None = None,
    record_end: bytes = b"\n",
) -> DataFrame:
    """Write each shard as one object below ``root`` and return its row of facts.

    An object appears under its key only when complete: it is written under a name of
    its own first. Building it again gives the same bytes, so a retried task is harmless.
    The returned plan does the writing; stage it rather than running it twice.
    """
    root = qualified(tagged.sparkSession, root)
    records = shard_order(tagged, tasks).select(
        "source_id",
        "shard_sequence",
        "pos",
        _line(payload, record_end).alias("line"),
        object_key.alias("object_key"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        done: list[tuple] = []
        current = None
        try:
            for key, last_pos, count, data, name in _runs(batches, "object_key"):
                if current is None or current[0] != key:
                    if current is not None:
                        done.append(_object_row(current))
                    current = [key, hashlib.sha256(), 0, 0, 0, PendingObject(root, name, attempt)]
                current[1].update(data)
                current[5].write(data)
                current[2] += len(data)
                current[3] += count
                current[4] = last_pos
            if current is not None:
                done.append(_object_row(current))
                current = None
        finally:
            if current is not None:
                current[5].abandon()
        yield _batch(done, _OBJECTS)

    return records.mapInArrow(write, _OBJECTS)


def write_objects(objects: DataFrame, root: str) -> DataFrame:
    """Write each row ``object_key, body`` as one object below ``root``; return the keys."""
    root = qualified(objects.sparkSession, root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        done: list[tuple] = []
        for batch in batches:
            for key, body in zip(batch.column("object_key").to_pylist(), batch.column("body").to_pylist()):
                pending = PendingObject(root, key, attempt)
                pending.write(body)
                done.append((key, pending.publish()))
        yield _batch(done, "object_key string, length bigint")

    rows = objects.select("object_key", F.col("body").cast("binary").alias("body"))
    return rows.mapInArrow(write, "object_key string, length bigint")


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Objects below ``root`` with their size; contents are not read."""
    root = qualified(spark, root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        listed = files.load(root).select("path", "length")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        # Nothing was stored yet, or all of it is gone.
        return spark.createDataFrame([], "object_key string, length bigint")
    base = F.lit(_plain(root).rstrip("/") + "/")
    plain = F.regexp_replace("path", r"^[A-Za-z0-9+.-]+:/+", "/")
    below = F.when(plain.startswith(base), F.substring(plain, F.length(base) + 1, F.length(plain)))
    return listed.select(F.coalesce(below, "path").alias("object_key"), "length")


def verify_written(built: DataFrame, listing: DataFrame) -> DataFrame:
    """Objects that are missing or have another size than the shard that was built."""
    joined = built.join(listing.select("object_key", "length"), "object_key", "left")
    return joined.where(F.col("length").isNull() | (F.col("length") != F.col("size_bytes")))


def require_verified(written: DataFrame) -> None:
    """Raise when the store reports another size for a written shard than was built."""
    wrong = written.where(~F.col("stored_size_bytes").eqNullSafe(F.col("size_bytes")))
    bad = wrong.select("object_key").take(1)
    if bad:
        raise OSError(f"size mismatch for {bad[0]['object_key']}")


def _plain(path: str) -> str:
    return re.sub(r"^[A-Za-z0-9+.-]+:/+", "/", path)


def _line(payload: Column, record_end: bytes = b"\n") -> Column:
    raw = payload.cast("binary")
    return F.concat(raw, F.lit(record_end)) if record_end else raw


def _runs(batches: Iterator[pa.RecordBatch], *extra: str) -> Iterator[tuple]:
    """Neighbouring rows of one shard as ``(key, last pos, rows, bytes, ...)``.

    The lines of such rows lie next to each other in the Arrow buffer, so they are
    handed out together and without a copy.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        line = batch.column("line")
        wide = pa.types.is_large_binary(line.type)
        offsets = np.frombuffer(line.buffers()[1], dtype=np.int64 if wide else np.int32)
        offsets = offsets[line.offset : line.offset + batch.num_rows + 1]
        data = memoryview(line.buffers()[2])
        sequence = batch.column("shard_sequence").to_numpy(zero_copy_only=False)
        source = batch.column("source_id").dictionary_encode()
        code = source.indices.to_numpy(zero_copy_only=False)
        pos = batch.column("pos").to_numpy(zero_copy_only=False)
        changes = np.flatnonzero((sequence[1:] != sequence[:-1]) | (code[1:] != code[:-1])) + 1
        starts = [0, *changes.tolist()]
        ends = [*changes.tolist(), batch.num_rows]
        for start, end in zip(starts, ends):
            key = (source.dictionary[int(code[start])].as_py(), int(sequence[start]))
            others = [batch.column(name)[start].as_py() for name in extra]
            chunk = data[offsets[start] : offsets[end]]
            yield key, int(pos[end - 1]), end - start, chunk, *others


def _digest_row(current: list) -> tuple:
    (source, sequence), digest, size, count, last_pos = current[:5]
    return source, sequence, size, count, last_pos, digest.hexdigest()


def _object_row(current: list) -> tuple:
    return (*_digest_row(current), current[5].key, current[5].publish())


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names = [part.split()[0] for part in ddl.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    types = [kinds[part.split()[1]] for part in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types)], names=names
    )
