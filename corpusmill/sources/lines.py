"""Lines of text files with exact bytes, byte offsets and record numbers."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import without_line_end
from corpusmill.operators.prefix import totals_before
from corpusmill.plans.staging import broadcast_if_small, stage
from corpusmill.sources.ranges import SPLIT_BYTES, Range, lines_of

_HANDED_BYTES = 4 << 20
_MARK = b"\xef\xbb\xbf"
_COMPRESSED = r"\.(gz|bz2|zst|zstd|deflate|lz4|snappy)$"


def scan_lines(
    spark: SparkSession, paths: str | list[str], whole_files: bool = False
) -> DataFrame:
    """Lines ended by line feed: ``file, record_index, end_offset, payload``.

    ``payload`` is the line without trailing carriage returns, byte for byte.
    ``end_offset`` is the file offset after the line, where a resumed read goes on, and
    ``record_index`` the number of lines up to it. Large files are read in splits by many
    tasks: lines are counted inside a split as they stream by, and the totals of the
    earlier splits are added. ``whole_files`` says that no file is split (gzip), which
    saves the pass that adds up the splits; offsets are then those of the plain bytes.
    Without it a compressed file is an error, as its size says nothing about its lines.

    The text reader drops a byte order mark at the start of a file. Lines that add up to
    less than the file show it; the mark is put back before the first line (a file of a
    mark alone has no lines).
    """
    lines = _raw_lines(spark, paths)
    key = F.xxhash64("file", "split_start")
    counted = lines.withColumn("within", _count_in_split(key, F.octet_length("raw")))
    records, end, payload = F.col("within.records"), F.col("within.bytes"), F.col("raw")
    if not whole_files:
        per_split = (
            _raw_lines(spark, paths)
            .groupBy("file", "split_start")
            .agg(
                F.count("*").alias("records"),
                F.sum((F.octet_length("raw") + 1).cast("bigint")).alias("bytes"),
            )
        )
        per_split = stage(per_split, "splits")
        # A window over the splits of one file: a few rows per gigabyte.
        before = totals_before(per_split, ["file"], "split_start", ["records", "bytes"], levels=1)
        per_file = per_split.groupBy("file").agg(F.sum("bytes").alias("file_bytes"))
        before = broadcast_if_small(stage(before.join(per_file, "file"), "split_offsets"))
        counted = counted.join(before, ["file", "split_start"])
        records = records + F.col("__before_records")
        problem = F.raise_error(F.concat(F.lit("a compressed file has no line offsets: "), F.col("file")))
        plain = F.when(F.lower("file").rlike(_COMPRESSED), problem.cast("bigint")).otherwise(F.col("file_size"))
        marked = F.col("file_bytes") < F.col("file_size")
        # The last line may lack its line feed.
        end = F.least(end + F.col("__before_bytes") + F.when(marked, len(_MARK)).otherwise(0), plain)
        payload = F.when(marked & (records == 1), F.concat(F.lit(_MARK), payload)).otherwise(payload)
    return counted.select(
        "file",
        records.alias("record_index"),
        end.alias("end_offset"),
        without_line_end(payload).alias("payload"),
    )


def scan_files(listed: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The lines of plain files ``file, length``, as :func:`scan_lines` gives them.

    For very many files whose names and sizes are known: nothing is listed, a file is opened
    once, and a task reads many of them. Only files longer than ``split_bytes`` are read in
    several ranges, whose lines are counted first. A mark alone in a file is a line.
    """
    spark = listed.sparkSession
    compressed = F.raise_error(F.concat(F.lit("a compressed file has no line offsets: "), F.col("file"))).cast("string")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint")))
    spans = listed.where("length > 0").select(
        F.when(F.lower("file").rlike(_COMPRESSED), compressed).otherwise(F.col("file")).alias("file"),
        F.col("length").cast("bigint").alias("length"),
        starts.alias("start"),
    )
    total = listed.agg(F.sum("length")).first()[0] or 0
    tasks = max(math.ceil(total / split_bytes), spark.sparkContext.defaultParallelism)
    long = spans.where(F.col("length") > split_bytes).withColumn("before", F.lit(0).cast("bigint"))
    if not long.isEmpty():
        counted = long.repartition(tasks).mapInArrow(_range_reader(split_bytes, True), "file string, start bigint, records bigint")
        # A window over the ranges of one file: a few rows per gigabyte.
        before = totals_before(stage(counted, "range_counts"), ["file"], "start", ["records"], levels=1)
        before = broadcast_if_small(stage(before.select("file", "start", "__before_records"), "range_offsets"))
        spans = spans.join(before, ["file", "start"], "left")
        spans = spans.withColumn("before", F.coalesce("__before_records", F.lit(0).cast("bigint")))
    else:
        spans = spans.withColumn("before", F.lit(0).cast("bigint"))
    return (
        spans.select("file", "length", "start", "before")
        .repartition(tasks)
        .mapInArrow(_range_reader(split_bytes, False), "file string, record_index bigint, end_offset bigint, payload binary")
    )


def _range_reader(split_bytes: int, counts: bool):
    """Reads ranges ``file, length, start, before``: their lines, or how many there are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for file, length, start, before in zip(*(c.to_pylist() for c in batch.columns)):
                stop = min(start + split_bytes, length)
                lines = lines_of(Range(0, file, start, stop, start == 0, file_records=before), False, None, None, counts)
                if counts:
                    n = sum(found.num_rows for found in lines)
                    yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([start]), pa.array([n])], ["file", "start", "records"])
                    continue
                for found in lines:
                    held.append(found.select(["file", "record_index", "end_offset", "payload"]))
                    size += found.nbytes
                    # Lines of small files are handed on together.
                    if size > _HANDED_BYTES:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return read


def require_one_file(spark: SparkSession, paths: str | list[str]) -> None:
    """The paths must name one plain file."""
    require_plain_file(list(enumerate(spark.read.text(paths).inputFiles())), paths)


def require_plain_file(files: list[tuple[int, str]], paths: str | list[str]) -> None:
    """One byte offset can stand for one plain file only."""
    if len(files) > 1:
        raise ValueError(f"a byte offset needs a source of one file, found {len(files)}: {paths}")
    for _, path in files:
        if re.search(_COMPRESSED, path.lower()):
            raise ValueError(f"a compressed file has no line offsets: {path}")


def resume_lines(lines: DataFrame, byte_offset: int) -> DataFrame:
    """The lines after a saved byte offset."""
    return lines.where(F.col("end_offset") > byte_offset)


def _raw_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("value").cast("binary").alias("raw"),
    )


def _count_in_split(key, length):
    """Lines and bytes of a split up to each line; only two numbers per line leave the JVM."""

    @F.arrow_udf("struct<records: bigint, bytes: bigint>")
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last_key, records, size = None, 0, 0
        for keys, lengths in batches:
            keys = keys.to_numpy(zero_copy_only=False)
            sizes = lengths.to_numpy(zero_copy_only=False).astype(np.int64) + 1
            if not len(keys):
                yield pa.StructArray.from_arrays(
                    [pa.array([], pa.int64())] * 2, names=["records", "bytes"]
                )
                continue
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
            total = np.cumsum(sizes)
            base_size = (total - sizes)[starts]
            base_records = starts.astype(np.int64)
            if last_key is not None and keys[0] == last_key:
                base_size[0] -= size
                base_records[0] -= records
            run_size = total - base_size[run]
            run_records = np.arange(1, len(keys) + 1) - base_records[run]
            last_key, records, size = keys[-1], int(run_records[-1]), int(run_size[-1])
            yield pa.StructArray.from_arrays(
                [pa.array(run_records), pa.array(run_size)], names=["records", "bytes"]
            )

    # Carries state from row to row, so it must run once and in scan order.
    return count.asNondeterministic()(key, length)
