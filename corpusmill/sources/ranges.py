"""Lines read from a cursor on, and not beyond a byte or record limit.

A Python data source cuts files into byte ranges. What is before the cursor is never opened:
a plain file is entered at its offset, a list of compressed files at the cursor's file.
With a limit, ranges are counted from the cursor on in growing groups until the limit is
met; ranges behind it are never opened either. The second pass reads the counted ranges, each
knowing what comes before it, and stops inside the range that holds the cut.

Limits are options and not filters, as Spark hands filters to Python sources only in
sessions that switch that on. The same source also streams: its offsets are the cursors.

Defined results: a line ends at a line feed or the end of its file, and loses carriage
returns at its end; stored bytes are those of the line and one line feed. A byte order mark
belongs to the first line. An empty file has no lines, a limit of 0 gives none. A cursor at
or behind the end of everything gives none.
"""

from __future__ import annotations

import gzip
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from corpusmill.plans.staging import new_path, stage
from corpusmill.sources.files import open_folder

SPLIT_BYTES = 64 << 20
READ_BYTES = 4 << 20
RECORDS = (
    "file_index int, file string, record_index bigint, end_offset bigint, "
    "total_records bigint, total_bytes bigint, payload binary"
)
COUNTS = "file_index int, file string, start bigint, stop bigint, records bigint, bytes bigint, cut boolean"

_GZIP = b"\x1f\x8b"

_EMPTY = pa.schema(
    [
        ("file_index", pa.int32()), ("file", pa.string()), ("record_index", pa.int64()), ("end_offset", pa.int64()),
        ("total_records", pa.int64()), ("total_bytes", pa.int64()), ("payload", pa.binary()),
    ]
)


@dataclass
class Range(InputPartition):
    """Lines that begin in ``[start, stop)`` of a file, and what comes before them."""

    file_index: int
    file: str
    start: int
    stop: int
    entered: bool = False
    skipped: int = 0
    file_records: int = 0
    records_before: int = 0
    bytes_before: int = 0


class CorpusLines(DataSource):
    """Options: ``files`` (JSON ``[[index, path], ...]`` in order), ``firstFile``,
    ``startOffset``, ``firstRecord``, ``compressed``, ``splitBytes``, ``maxBytes``,
    ``maxRecords``; ``what`` (``records`` or ``counts``), ``slice`` and ``plan`` are set by
    :func:`read_lines`, ``bytesPerTrigger`` by streams.
    """

    @classmethod
    def name(cls) -> str:
        return "corpus_lines"

    def schema(self) -> str:
        return COUNTS if self.options.get("what") == "counts" else RECORDS

    def reader(self, schema) -> DataSourceReader:
        return _LineReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _LineStream(dict(self.options))


def _option(options: dict, name: str, default):
    found = {k.lower(): v for k, v in options.items()}.get(name.lower())
    return default if found is None else type(default)(found)


def _limit(options: dict, name: str) -> int | None:
    value = _option(options, name, "")
    return int(value) if value else None


def file_size(path: str) -> int:
    files, plain = open_folder(path)
    return files.get_file_info(plain).size


def ranges_of(options: dict) -> list[Range]:
    """All ranges from the cursor on, in order."""
    first, offset = _option(options, "firstFile", 0), _option(options, "startOffset", 0)
    skipped, split = _option(options, "firstRecord", 0), _option(options, "splitBytes", SPLIT_BYTES)
    compressed = _option(options, "compressed", "false") == "true"
    found = []
    for index, path in json.loads(_option(options, "files", "[]")):
        if index < first:
            continue
        size, at_cursor = file_size(path), index == first
        if compressed:
            found.append(Range(index, path, 0, size, True, skipped if at_cursor else 0))
            continue
        begin = offset if at_cursor else 0
        for start in range(begin, size, split):
            found.append(Range(index, path, start, min(start + split, size), start == begin))
    return found


class _LineReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options
        self.counts = options.get("what") == "counts"
        self.compressed = _option(options, "compressed", "false") == "true"
        self.max_bytes, self.max_records = _limit(options, "maxBytes"), _limit(options, "maxRecords")

    def partitions(self) -> list[Range]:
        plan = _option(self.options, "plan", "")
        if plan:
            files, path = open_folder(plan)
            rows = pq.read_table(path, filesystem=files).to_pylist()
            # One row per range, as many as any file scan is planned with on the driver.
            return [Range(**row) for row in sorted(rows, key=lambda r: (r["file_index"], r["start"]))]
        found = ranges_of(self.options)
        part = json.loads(_option(self.options, "slice", "null"))
        return found[part[0] : part[1]] if part else found

    def read(self, split: Range) -> Iterator[pa.RecordBatch]:
        batches = lines_of(split, self.compressed, self.max_bytes, self.max_records, self.counts)
        if not self.counts:
            yield from batches
            return
        records, size, cut = 0, 0, False
        for batch in batches:
            records += batch.num_rows
            size = batch.column("total_bytes")[-1].as_py() if batch.num_rows else size
            cut |= not batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], k) for x, k in (
                (split.file_index, pa.int32()), (split.file, pa.string()), (split.start, pa.int64()),
                (split.stop, pa.int64()), (records, pa.int64()), (size, pa.int64()), (cut, pa.bool_()),
            )],
            ["file_index", "file", "start", "stop", "records", "bytes", "cut"],
        )


def lines_of(split: Range, compressed: bool, max_bytes: int | None, max_records: int | None, counts: bool = False) -> Iterator[pa.RecordBatch]:
    """Record batches of a range, up to the limits counted from the cursor.

    An empty batch at the end says that a limit was met inside the range.
    """
    files, path = open_folder(split.file)
    done, records, size = split.file_records, split.records_before, split.bytes_before
    left = split.skipped
    with _opened(files, path, compressed) as stream:
        at = 0 if compressed else _enter(stream, split)
        stop = None if compressed else split.stop
        for data, base in _whole_lines(stream, at, stop):
            begin, end, after = _borders(data)
            if stop is not None:
                inside = int(np.searchsorted(begin + base, stop))
                begin, end, after = begin[:inside], end[:inside], after[:inside]
            if left:
                skip = min(left, len(begin))
                left, done = left - skip, done + skip
                begin, end, after = begin[skip:], end[skip:], after[skip:]
            total_bytes = size + np.cumsum(end - begin + 1)
            total_records = records + np.arange(1, len(begin) + 1)
            within = len(begin)
            if max_bytes is not None:
                within = min(within, int(np.searchsorted(total_bytes, max_bytes, "right")))
            if max_records is not None:
                within = min(within, max(max_records - records, 0))
            if within:
                payload = pa.nulls(within, pa.binary()) if counts else _payloads(data, begin[:within], end[:within])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(within, split.file_index, np.int32)),
                        pa.array([split.file] * within if not counts else [""] * within),
                        pa.array(done + np.arange(1, within + 1)),
                        pa.array(base + after[:within]),
                        pa.array(total_records[:within]),
                        pa.array(total_bytes[:within]),
                        payload,
                    ],
                    ["file_index", "file", "record_index", "end_offset", "total_records", "total_bytes", "payload"],
                )
                done, records, size = done + within, int(total_records[within - 1]), int(total_bytes[within - 1])
            if within < len(begin):
                yield pa.RecordBatch.from_pylist([], schema=_EMPTY)
                return


def _opened(files, path: str, compressed: bool):
    """A plain file that can be entered anywhere, or a stream of what a compressed one holds."""
    if not compressed:
        return files.open_input_file(path)
    raw = files.open_input_file(path)
    # Told by its first bytes, as a file may be named anything; it may consist of several members.
    gzipped = raw.read(2) == _GZIP
    raw.seek(0)
    if gzipped:
        return gzip.GzipFile(fileobj=raw)
    raw.close()
    return files.open_input_stream(path, compression="detect")


def _enter(raw, split: Range) -> int:
    """The offset of the first line that begins in the range."""
    if split.entered or not split.start:
        raw.seek(split.start)
        return split.start
    return next_line(raw, split.start)


def next_line(raw, offset: int) -> int:
    """The first offset not before ``offset`` at which a line begins, or the end of the file."""
    at = offset - 1
    raw.seek(at)
    while data := raw.read(READ_BYTES):
        found = data.find(b"\n")
        if found >= 0:
            raw.seek(at + found + 1)
            return at + found + 1
        at += len(data)
    return at


def _whole_lines(stream, at: int, stop: int | None) -> Iterator[tuple[bytes, int]]:
    """Pieces of whole lines with their offsets, until the lines begin behind ``stop``."""
    held: list[bytes] = []
    base = at
    while stop is None or base < stop:
        data = stream.read(READ_BYTES)
        if not data:
            break
        cut = data.rfind(b"\n") + 1
        if not cut:
            held.append(data)
            continue
        whole = b"".join([*held, data[:cut]])
        yield whole, base
        base += len(whole)
        held = [data[cut:]] if cut < len(data) else []
    rest = b"".join(held)
    if rest and (stop is None or base < stop):
        yield rest, base


def _borders(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end without line end, and end with it, of every line."""
    raw = np.frombuffer(data, np.uint8)
    feeds = np.flatnonzero(raw == 10)
    if not len(feeds) or feeds[-1] != len(raw) - 1:
        feeds = np.append(feeds, len(raw))
    begin = np.concatenate([[0], feeds[:-1] + 1])
    end = feeds.copy()
    marked = np.flatnonzero((end > begin) & (raw[np.maximum(end - 1, 0)] == 13))
    for k in marked.tolist():
        end[k] = begin[k] + len(data[begin[k] : end[k]].rstrip(b"\r"))
    return begin, end, np.minimum(feeds + 1, len(raw))


def _payloads(data: bytes, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The lines as a column; what is between them is skipped, not copied row by row."""
    edges = np.column_stack([begin, end]).ravel().astype(np.int32)
    every = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
    return every.take(pa.array(np.arange(0, len(edges) - 1, 2)))


def listed_files(spark: SparkSession, paths: str | list[str]) -> list[tuple[int, str]]:
    """The files of some paths in order of name, numbered from 0."""
    return list(enumerate(sorted(spark.read.text(paths).inputFiles())))


def _load(spark: SparkSession, options: dict) -> DataFrame:
    spark.dataSource.register(CorpusLines)
    return spark.read.format("corpus_lines").options(**options).load()


def read_lines(
    spark: SparkSession,
    files: list[tuple[int, str]],
    *,
    first_file: int = 0,
    start_offset: int = 0,
    first_record: int = 0,
    max_bytes: int | None = None,
    max_records: int | None = None,
    compressed: bool = False,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Lines of numbered files, from a cursor up to a limit.

    ``file_index, file, record_index, end_offset, total_records, total_bytes, payload``: the
    number of the record in its file and the offset behind it (in plain bytes), and records
    and stored bytes from the cursor through the record. In the cursor's file ``record_index``
    counts from the cursor for plain files, and from the file's start for compressed ones.
    """
    options = {
        "files": json.dumps([f for f in files if f[0] >= first_file]),
        "firstFile": str(first_file),
        "startOffset": str(start_offset),
        "firstRecord": str(first_record),
        "compressed": str(compressed).lower(),
        "splitBytes": str(split_bytes),
    }
    options |= {k: str(v) for k, v in (("maxBytes", max_bytes), ("maxRecords", max_records)) if v is not None}
    ranges = ranges_of(options)
    counted, records, size, done, cut = [], 0, 0, 0, False
    while done < len(ranges) and not cut and (max_bytes is None or size < max_bytes) and (max_records is None or records < max_records):
        upto = _group_end(ranges, done, None if max_bytes is None else max_bytes - size, max_records is not None, compressed)
        part = options | {"what": "counts", "slice": json.dumps([done, upto])}
        part_counts = stage(_load(spark, part), "range_counts")
        row = part_counts.agg(F.sum("records"), F.sum("bytes"), F.max("cut")).first()
        records, size, cut, done = records + (row[0] or 0), size + (row[1] or 0), bool(row[2]), upto
        counted.append(part_counts)
    if not counted:
        return spark.createDataFrame([], RECORDS)
    whole = counted[0]
    for more in counted[1:]:
        whole = whole.unionByName(more)
    # One row per range of the part that is read: a few rows a gigabyte.
    before = Window.partitionBy(F.lit(0)).orderBy("file_index", "start").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file_index").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    cursor = F.col("file_index") == first_file
    entered = F.col("start") == F.when(cursor & F.lit(not compressed), start_offset).otherwise(0)
    skipped = F.when(cursor & F.lit(compressed), first_record).otherwise(0)
    plan = whole.select(
        "file_index", "file", "start", "stop", entered.alias("entered"), skipped.cast("bigint").alias("skipped"),
        total("records", in_file).alias("file_records"),
        total("records", before).alias("records_before"), total("bytes", before).alias("bytes_before"),
        F.coalesce(F.max("cut").over(before), F.lit(False)).alias("behind"),
    )
    # A limit that one range meets by itself is met, whatever the totals say.
    plan = plan.where(~F.col("behind")).drop("behind")
    if max_bytes is not None:
        plan = plan.where(F.col("bytes_before") < max_bytes)
    if max_records is not None:
        plan = plan.where(F.col("records_before") < max_records)
    path = new_path(spark, "ranges")
    plan.write.parquet(path)
    return _load(spark, options | {"plan": path})


def _group_end(ranges: list[Range], begin: int, wanted: int | None, doubling: bool, compressed: bool) -> int:
    """How far to count next: as many bytes as are wanted, or twice as far as before.

    A line's stored bytes are at most its bytes in the file, so ranges of as many bytes as
    are wanted reach at most one range beyond the cut. Nothing is known of compressed files
    or of record limits, so there the number of ranges doubles.
    """
    if compressed or (wanted is None and doubling):
        return len(ranges) if wanted is None and not doubling else min(len(ranges), max(1, 2 * begin))
    if wanted is None:
        return len(ranges)
    end, have = begin, 0
    while end < len(ranges) and have < wanted:
        have += ranges[end].stop - ranges[end].start
        end += 1
    return min(end, max(1, 2 * begin)) if doubling else end


class _LineStream(DataSourceStreamReader):
    """Offsets are cursors ``{"file_index", "byte_offset"}`` at the begin of a line.

    Every trigger goes at most ``bytesPerTrigger`` bytes on, rounded up to the end of a line.
    The reader is told where to go on by the cursor options and by the ranges that Spark
    asks for, so a restart begins with the cursor of the last committed shard.
    """

    def __init__(self, options: dict) -> None:
        self.options = options
        self.files = [tuple(f) for f in json.loads(_option(options, "files", "[]"))]
        self.step = _option(options, "bytesPerTrigger", SPLIT_BYTES)
        self.split = _option(options, "splitBytes", SPLIT_BYTES)
        self.at = (_option(options, "firstFile", 0), _option(options, "startOffset", 0))

    def initialOffset(self) -> dict:
        return {"file_index": _option(self.options, "firstFile", 0), "byte_offset": _option(self.options, "startOffset", 0)}

    def latestOffset(self) -> dict:
        index, offset = self.at
        left = self.step
        for number, path in self.files:
            if number < index or left <= 0:
                continue
            if number > index:
                index, offset = number, 0
            size = file_size(path)
            if size - offset > left:
                files, plain = open_folder(path)
                with files.open_input_file(plain) as raw:
                    offset, left = next_line(raw, offset + left), 0
            else:
                left -= max(size - offset, 0)
                offset = max(size, offset)
        return {"file_index": index, "byte_offset": offset}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        low, high = ((o["file_index"], o["byte_offset"]) for o in (start, end))
        self.at = max(self.at, high)
        found = []
        for number, path in self.files:
            if low[0] <= number <= high[0]:
                begin = low[1] if number == low[0] else 0
                stop = high[1] if number == high[0] else file_size(path)
                for at in range(begin, stop, self.split):
                    found.append(Range(number, path, at, min(at + self.split, stop), at == begin))
        return found

    def read(self, split: Range) -> Iterator[pa.RecordBatch]:
        yield from lines_of(split, False, None, None)


def stream_lines(
    spark: SparkSession,
    files: list[tuple[int, str]],
    *,
    first_file: int = 0,
    start_offset: int = 0,
    bytes_per_trigger: int = SPLIT_BYTES,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """The same lines as a stream; the totals count inside each range of bytes only.

    Files may grow at their end and may be added at the end of the list between two starts.
    """
    spark.dataSource.register(CorpusLines)
    options = {
        "files": json.dumps(files),
        "firstFile": str(first_file),
        "startOffset": str(start_offset),
        "bytesPerTrigger": str(bytes_per_trigger),
        "splitBytes": str(split_bytes),
    }
    return spark.readStream.format("corpus_lines").options(**options).load()
