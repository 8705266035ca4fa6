"""Packed blocks stored with a description of themselves, and read back by block number."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.packing import DTYPE, TOKEN_BYTES, pack_metadata
from corpusmill.plans.staging import qualified, stage
from corpusmill.sources.files import open_folder
from corpusmill.sources.shards import list_objects, require_verified, write_objects
from corpusmill.sources.tokens import write_packed

RANGE_BLOCKS = 1 << 14
_NUMBERS = ("sequence_length", "vocab_size", "num_blocks", "num_tokens", "blocks_per_file")


def store_packed(
    blocks: DataFrame, root: str, name: str, sequence_length: int, vocab_size: int, blocks_per_file: int = 1 << 20
) -> dict:
    """Write blocks as binary files below ``root`` and describe them in ``{name}.json``.

    The description is written last, so that it stands for complete files only.
    """
    described = pack_metadata(blocks, sequence_length, vocab_size).first().asDict()
    if not described["num_blocks"]:
        raise ValueError("there is no whole block to store")
    written = stage(write_packed(blocks, root, name, blocks_per_file), "packed")
    require_verified(written)
    described |= {"blocks_per_file": blocks_per_file}
    body = json.dumps(described, sort_keys=True)
    key = f"{name}.json"
    write_objects(blocks.sparkSession.createDataFrame([(key, body)], "object_key string, body string"), root).collect()
    return described


def packed_description(spark: SparkSession, root: str, name: str) -> dict:
    """The checked description of stored blocks; anything odd in it is an error."""
    files, folder = open_folder(qualified(spark, root))
    path = posixpath.join(folder, f"{name}.json")
    try:
        with files.open_input_file(path) as held:
            found = json.loads(held.read().decode())
        numbers = [found[k] for k in _NUMBERS]
    except (OSError, ValueError, KeyError, TypeError) as error:
        raise ValueError(f"no sound description of packed blocks at {path}") from error
    if not all(isinstance(n, int) and not isinstance(n, bool) and n > 0 for n in numbers):
        raise ValueError(f"numbers of packed blocks must be positive integers: {path}")
    if found["num_tokens"] != found["num_blocks"] * found["sequence_length"] or found.get("dtype") != DTYPE:
        raise ValueError(f"the description of packed blocks contradicts itself: {path}")
    return found


def read_packed(
    spark: SparkSession, root: str, name: str, first_block: int = 0, last_block: int | None = None, range_blocks: int = RANGE_BLOCKS
) -> DataFrame:
    """Stored blocks ``block_id, ids``, all of them or those in ``[first_block, last_block)``.

    Every file must have exactly the size that the description gives it. A task maps the part
    of a file that its range of blocks takes and copies one range at a time, so neither the
    files' sizes nor their number matter, and blocks that are not asked for are not touched.
    """
    found = packed_description(spark, root, name)
    row, per_file, count = found["sequence_length"] + 1, found["blocks_per_file"], found["num_blocks"]
    root = qualified(spark, root)
    _require_sizes(spark, root, name, count, per_file, row * TOKEN_BYTES)
    begin, end = max(first_block, 0), count if last_block is None else min(last_block, count)
    vocabulary = found["vocab_size"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = open_folder(root)
        for batch in batches:
            for number in batch.column("id").to_pylist():
                at, stop = max(number * range_blocks, begin), min((number + 1) * range_blocks, end)
                while at < stop:
                    index = at // per_file
                    upto = min(stop, (index + 1) * per_file)
                    path = posixpath.join(folder, f"{name}-{index + 1:06d}.bin")
                    ids = _mapped(files, path, at - index * per_file, upto - at, row)
                    if ids.max() >= vocabulary:
                        raise ValueError(f"id beyond the vocabulary in {path}")
                    ends = pa.array(np.arange(0, ids.size + 1, row, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(at, upto)), pa.ListArray.from_arrays(ends, pa.array(ids.ravel().astype(np.int64)))],
                        ["block_id", "ids"],
                    )
                    at = upto

    first, last = begin // range_blocks, -(-max(end, begin) // range_blocks)
    ranges = spark.range(first, last if end > begin else first, 1, max(1, min(last - first, 100_000)))
    return ranges.mapInArrow(read, "block_id long, ids array<long>")


def _mapped(files, path: str, first: int, blocks: int, row: int) -> np.ndarray:
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, DTYPE, "r", first * row * TOKEN_BYTES, (blocks, row))
    with files.open_input_file(path) as held:
        body = held.read_at(blocks * row * TOKEN_BYTES, first * row * TOKEN_BYTES)
    return np.frombuffer(body, DTYPE).reshape(blocks, row)


def _require_sizes(spark: SparkSession, root: str, name: str, count: int, per_file: int, block_bytes: int) -> None:
    number = F.regexp_extract("object_key", rf"^{name}-(\d+)\.bin$", 1)
    listed = list_objects(spark, root).select(number.alias("n"), "length").where("n <> ''")
    files = -(-count // per_file)
    wanted = spark.range(1, files + 1).select(
        F.format_string("%06d", "id").alias("n"),
        (F.least(F.lit(per_file), F.lit(count) - (F.col("id") - 1) * per_file) * block_bytes).alias("wanted"),
    )
    wrong = wanted.join(listed, "n", "full").where(~F.coalesce(F.col("length") == F.col("wanted"), F.lit(False)))
    bad = wrong.orderBy("n").first()
    if bad is not None:
        raise ValueError(f"packed file {bad['n']} has {bad['length']} bytes, described are {bad['wanted']}")
