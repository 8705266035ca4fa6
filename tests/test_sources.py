import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.functions.text import json_payload
from corpusmill.operators.quota import resume_after_file
from corpusmill.sources.datasets import dataset_records, read_numbered, text_payload
from corpusmill.sources.files import PendingObject
from corpusmill.sources.lines import require_one_file, resume_lines, scan_lines
from corpusmill.sources.manifests import manifest_entries, manifest_records


def read_all(path):
    """Lines one after the other, with the offset after each."""
    rows, offset = [], 0
    with open(path, "rb") as handle:
        for line in handle:
            offset += len(line)
            rows.append((len(rows) + 1, offset, line.rstrip(b"\r\n")))
    return rows


def scanned(df):
    found = df.orderBy("record_index").collect()
    return [(r["record_index"], r["end_offset"], bytes(r["payload"])) for r in found]


@pytest.mark.parametrize(
    "body",
    [
        b"one\ntwo\nthree\nfour\n",
        b"one\r\n\r\ntwo\r\r\n\nlast line without end",
        b"\xff\xfe broken \xe2\r\nlone\rreturn\n\xe2\x80\xa8 separator\n",
        b"\n\n\n",
        b"\xef\xbb\xbfone\ntwo\n",
        b"\xef\xbb\xbf\r\n\xef\xbb\xbftwo\nlast line without end",
    ],
)
def test_lines_keep_bytes_offsets_and_numbers(spark, folder, body):
    path = f"{folder}/source.txt"
    with open(path, "wb") as handle:
        handle.write(body)
    assert scanned(scan_lines(spark, path)) == read_all(path)


def test_a_split_file_is_numbered_like_a_whole_one(spark, folder):
    path = f"{folder}/source.txt"
    with open(path, "wb") as handle:
        handle.writelines(b"x" * (i % 97) + (b"\r\n" if i % 5 else b"\n") for i in range(20_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        lines = scan_lines(spark, path)
        assert scanned(lines) == read_all(path)
        offset = read_all(path)[12_344][1]
        assert scanned(resume_lines(lines, offset)) == read_all(path)[12_345:]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_compressed_lines_have_no_offsets(spark, folder):
    path = f"{folder}/source.txt.gz"
    with gzip.open(path, "wb") as handle:
        handle.writelines(b"line %d\n" % i for i in range(100))
    with pytest.raises(PySparkException, match="compressed file"):
        scan_lines(spark, path).collect()
    assert scan_lines(spark, path, whole_files=True).count() == 100


def test_a_byte_offset_needs_one_file(spark, folder):
    for name in ("a", "b"):
        with open(f"{folder}/{name}.txt", "wb") as handle:
            handle.write(b"one\ntwo\n")
    require_one_file(spark, f"{folder}/a.txt")
    with pytest.raises(ValueError, match="one file, found 2"):
        require_one_file(spark, folder)


def test_many_files_in_one_task_are_numbered_apart(spark, folder):
    for i in range(9):
        with open(f"{folder}/f{i}.txt", "wb") as handle:
            handle.writelines(b"%d\n" % k for k in range(i * 3))
    rows = scan_lines(spark, folder).collect()
    for i in range(9):
        mine = [r for r in rows if r["file"].endswith(f"f{i}.txt")]
        assert sorted(r["record_index"] for r in mine) == list(range(1, i * 3 + 1))
        assert sorted((r["record_index"], r["end_offset"], bytes(r["payload"])) for r in mine) == read_all(
            f"{folder}/f{i}.txt"
        )


TEXTS = [
    "plain",
    "é 😀   \x7f",
    'quote " backslash \\ slash /',
    "\x1b[0m and \\u001B and \\\\u001B\x1b\x1b",
    "".join(map(chr, range(32))),
    "",
]


def test_payload_is_the_json_a_python_writer_gives(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for row in df.select("text", json_payload(F.col("text")).alias("p")).collect():
        assert row["p"] == json.dumps({"text": row["text"]}, ensure_ascii=False)


def test_dataset_text_field_must_be_a_string(spark):
    with pytest.raises(ValueError, match="no text field"):
        text_payload(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(ValueError, match="not hold strings"):
        text_payload(spark.createDataFrame([(1,)], "text int"))
    nulls = spark.createDataFrame([(None,)], "text string")
    with pytest.raises(PySparkException, match="not hold strings"):
        nulls.select(text_payload(nulls)).collect()


def test_dataset_rows_are_numbered_in_file_order(spark, folder):
    texts = ["zero", "one", "two", "three"]
    for i in (0, 1):
        part = spark.createDataFrame([(t,) for t in texts[2 * i : 2 * i + 2]], "text string")
        part.coalesce(1).write.parquet(f"{folder}/d/part={i}")
    rows = read_numbered(spark, f"{folder}/d")
    found = dataset_records(rows, F.lit("s"), F.col("pos")).where("pos > 2").orderBy("pos")
    assert [json.loads(r["payload"]) for r in found.collect()] == [{"text": "two"}, {"text": "three"}]


def manifest(folder, lines, files):
    with open(f"{folder}/manifest.txt", "w") as handle:
        handle.write("".join(line + "\n" for line in lines))
    for name, body in files.items():
        with gzip.open(f"{folder}/{name}", "wb") as handle:
            handle.write(body)
    return f"{folder}/manifest.txt"


def test_manifest_of_compressed_json_lines(spark, folder):
    path = manifest(
        folder,
        ["https://example.test/a.json.gz", "", "  https://example.test/b.json.gz "],
        {
            "a.json.gz": b'{"text":"first", "id": 1}\n{"text":"second"}\n',
            "b.json.gz": b'{"text":"third"}\r\n',
        },
    )
    assert [tuple(r) for r in manifest_entries(spark, path).collect()] == [
        (0, "https://example.test/a.json.gz"),
        (2, "https://example.test/b.json.gz"),
    ]
    rows = manifest_records(spark, path, {"https://example.test/": folder})
    found = sorted((r["file_index"], r["record_index"], bytes(r["payload"])) for r in rows.collect())
    assert found == [
        (0, 1, b'{"text":"first", "id": 1}'),
        (0, 2, b'{"text":"second"}'),
        (2, 1, b'{"text":"third"}'),
    ]
    left = resume_after_file(rows, 0, 1).collect()
    assert {(r["file_index"], r["record_index"]) for r in left} == {(0, 2), (2, 1)}


@pytest.mark.parametrize(
    "body,message",
    [
        (b'{"text":"a"}\n\n', "cannot be read as JSON"),
        (b"not json\n", "cannot be read as JSON"),
        (b'{"text": 1}\n', "has no text that is a string"),
        (b"[1]\n", "has no text that is a string"),
        (b'{"other": "a"}\n', "has no text that is a string"),
    ],
)
def test_manifest_records_must_hold_text(spark, folder, body, message):
    path = manifest(folder, ["https://example.test/a.json.gz"], {"a.json.gz": body})
    with pytest.raises(PySparkException, match=message):
        manifest_records(spark, path, {"https://example.test/": folder}).collect()


def test_manifest_entries_must_be_https(spark, folder):
    path = manifest(folder, ["http://example.test/a.json.gz"], {})
    with pytest.raises(PySparkException, match="not an https URL"):
        manifest_records(spark, path).collect()


def test_an_object_has_its_name_only_when_complete(folder):
    import os

    pending = PendingObject(folder, "a/b.txt", 7)
    pending.write(b"abc")
    assert not os.path.exists(f"{folder}/a/b.txt")
    assert pending.publish() == 3
    assert os.listdir(f"{folder}/a") == ["b.txt"]


def test_a_dataset_is_read_from_the_cursor_to_the_limit(spark, folder):
    for i in range(6):
        spark.createDataFrame([(f"text {i} {k}",) for k in range(3)], "text string").coalesce(1).write.parquet(f"{folder}/d/part={i}")
    size = F.octet_length("text")
    rows = read_numbered(spark, f"{folder}/d", after=4, max_bytes=20, size=size)
    found = {r["pos"]: r["text"] for r in rows.collect()}
    # Everything from the cursor to the limit is there, and whole files behind it are not.
    assert min(found) == 5 and {5, 6, 7} <= found.keys() and max(found) < 18
    assert all(found[p] == f"text {(p - 1) // 3} {(p - 1) % 3}" for p in found)
    assert read_numbered(spark, f"{folder}/d", after=18, max_bytes=20, size=size).count() == 0


def test_a_manifest_is_opened_from_the_cursor_on(spark, folder):
    body = b"".join(b'{"text": "r%d"}\n' % k for k in range(4))
    path = manifest(folder, [f"https://example.test/{k}.gz" for k in range(3)], {"0.gz": b"not json\n", "1.gz": body, "2.gz": body[:20] + b"\n[]\n"})
    mirror = {"https://example.test": folder}
    found = manifest_records(spark, path, mirror, after_file=1, after_record=2, max_bytes=36)
    assert [(r["file_index"], r["record_index"]) for r in found.orderBy("file_index", "record_index").collect()] == [(1, 3), (1, 4)]
