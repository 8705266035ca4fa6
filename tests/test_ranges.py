"""Lines from a cursor up to a limit, against plain reading."""

import gzip
import json
import os

import numpy as np
import pytest

from corpusmill.sources import ranges


def plain(files, first_file=0, offset=0, record=0, max_bytes=None, max_records=None, compressed=False):
    found, total = [], 0
    for index, path in files:
        if index < first_file:
            continue
        body = gzip.open(path).read() if compressed else open(path, "rb").read()
        at = offset if index == first_file and not compressed else 0
        lines = body[at:].split(b"\n")
        lines = lines[:-1] if not lines[-1] else lines
        for n, line in enumerate(lines, 1):
            at = min(at + len(line) + 1, len(body))
            if compressed and index == first_file and n <= record:
                continue
            payload = line.rstrip(b"\r")
            if max_bytes is not None and total + len(payload) + 1 > max_bytes:
                return found
            if max_records is not None and len(found) == max_records:
                return found
            total += len(payload) + 1
            found.append((index, n, at, len(found) + 1, total, payload))
    return found


def write(folder, bodies, compressed=False):
    files = []
    for k, body in enumerate(bodies):
        path = f"{folder}/part {k:03d}"
        with (gzip.open if compressed else open)(path, "wb") as out:
            out.write(body)
        files.append((k, path))
    return files


def rows(df):
    columns = ("file_index", "record_index", "end_offset", "total_records", "total_bytes", "payload")
    return sorted(tuple(bytes(v) if isinstance(v, bytearray) else v for v in (r[c] for c in columns)) for r in df.collect())


BODIES = [b"one\ntwo\r\nthree\r\r\n\nlast without end", b"", b"\xef\xbb\xbfmark\n" + b"x" * 60 + b"\n\r\n", b"a\n" * 12]


@pytest.mark.parametrize("split_bytes", [9, 1 << 20])
def test_ranges_read_like_one_pass(spark, folder, split_bytes):
    files = write(folder, BODIES)
    for options in ({}, {"max_bytes": 40, "max_records": 8}, {"max_bytes": 3}, {"max_bytes": 0}):
        assert rows(ranges.read_lines(spark, files, split_bytes=split_bytes, **options)) == plain(files, **options)
    cursor = rows(ranges.read_lines(spark, files, first_file=0, start_offset=9, max_bytes=30, split_bytes=split_bytes))
    assert cursor == plain(files, offset=9, max_bytes=30)
    assert rows(ranges.read_lines(spark, files, first_file=3, start_offset=100)) == []
    assert rows(ranges.read_lines(spark, files, first_file=9)) == []


def test_compressed_files_resume_at_a_record(spark, folder):
    files = write(folder, [b'{"n": %d}\n' % k * 5 for k in range(6)], compressed=True)
    for options in ({}, {"first_file": 2, "first_record": 3}, {"first_file": 5, "first_record": 5}, {"first_file": 1, "first_record": 2, "max_bytes": 70}):
        found = rows(ranges.read_lines(spark, files, compressed=True, **options))
        plainly = {{"first_record": "record"}.get(k, k): v for k, v in options.items()}
        assert found == plain(files, compressed=True, **plainly)


def test_what_the_limit_and_the_cursor_leave_out_is_never_opened(spark, folder):
    files = write(folder, [b"line of text\n" * 20 for _ in range(6)])
    wanted = plain(files, 2, 26, max_bytes=400)
    assert wanted[-1][0] == 3
    for index in (0, 1, 4, 5):
        # A folder in the place of the file: its size is listed, and opening it fails.
        os.remove(files[index][1])
        os.mkdir(files[index][1])
    sizes = ranges.file_size
    try:
        ranges.file_size = lambda path: 260 if os.path.isdir(path) else sizes(path)
        assert rows(ranges.read_lines(spark, files, first_file=2, start_offset=26, max_bytes=400, split_bytes=90)) == wanted
        opened = ranges._group_end(ranges.ranges_of({"files": "[[0, \"%s\"]]" % files[2][1], "splitBytes": "90"}), 0, 100, False, False)
        assert opened == 2
    finally:
        ranges.file_size = sizes


def test_random_bodies(spark, folder):
    random = np.random.default_rng(5)
    bodies = [bytes(random.choice([10, 13, 65, 66], p=[0.2, 0.1, 0.4, 0.3], size=n).tolist()) for n in (0, 1, 90, 400)]
    files = write(folder, bodies)
    for _ in range(3):
        limit, split = int(random.integers(1, 300)), int(random.integers(30, 60))
        assert rows(ranges.read_lines(spark, files, max_bytes=limit, split_bytes=split)) == plain(files, max_bytes=limit)


def test_stream_offsets_are_cursors_and_triggers_are_bounded(folder):
    files = write(folder, [b"0123456789\n" * 10, b"abc\n" * 5])
    reader = ranges._LineStream({"files": json.dumps(files), "bytesPerTrigger": "30", "splitBytes": "25"})
    at, seen = reader.initialOffset(), []
    while (end := reader.latestOffset()) != at:
        part = reader.partitions(at, end)
        seen += [p.as_py() for s in part for b in reader.read(s) for p in b.column("payload")]
        at = end
    assert seen == [p[-1] for p in plain(files)] and at == {"file_index": 1, "byte_offset": 20}
    again = ranges._LineStream({"files": json.dumps(files), "firstFile": "0", "startOffset": "99", "bytesPerTrigger": "12"})
    assert again.latestOffset() == {"file_index": 1, "byte_offset": 4}
