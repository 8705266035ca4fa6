import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.text import normalize, strip
from corpusmill.operators import documents

SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def reference_documents(text, min_chars):
    """Documents of a text, line by line."""
    found, buffer = [], []
    for line in [*re.split(r"\r\n|\n|\r", text), ""]:
        if line.strip():
            buffer.append(line.strip())
        elif buffer:
            found.append(re.sub(r"\s+", " ", " ".join(buffer)).strip())
            buffer = []
    return [d for d in found if len(d) >= min_chars]


def test_whitespace_is_that_of_python(spark):
    texts = [f"{c}a{c}{c}b{c}" for c in SPACES] + ["a​b", "﻿a", SPACES, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", normalize(F.col("t")).alias("n"), strip(F.col("t")).alias("s")).collect():
        assert row["n"] == re.sub(r"\s+", " ", row["t"]).strip()
        assert row["s"] == row["t"].strip()


def random_text(seed, ends):
    rng = random.Random(seed)
    parts = []
    for _ in range(300):
        parts.append(rng.choice(["", " ", "\t ", "word", " two  words ", "\x0bend", "é x"]))
        parts.append(rng.choice(ends))
    return "".join(parts)


@pytest.mark.parametrize("seed,bits", [(1, 2), (2, 5), (3, 12)])
def test_lines_make_documents(spark, seed, bits):
    texts = {f"f{i}": random_text(seed * 10 + i, ["\n"]) for i in range(3)}
    lines = [(f, n, v) for f, t in texts.items() for n, v in enumerate(t.split("\n"))]
    random.Random(seed).shuffle(lines)
    df = spark.createDataFrame(lines, "file string, line_no bigint, value string")
    rows = documents.assemble_documents(df, min_chars=4, bits=bits).orderBy("file", "first_line").collect()
    for name, text in texts.items():
        assert [r["text"] for r in rows if r["file"] == name] == reference_documents(text, 4)


@pytest.mark.parametrize("ends", [["\n"], ["\n", "\n", "\r\n", "\r"]])
def test_files_make_documents_without_a_shuffle(spark, folder, ends):
    texts = {f"f{i}": random_text(i, ends) for i in range(4)}
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as handle:
            handle.write(text)
    df = documents.read_documents(spark, folder, min_chars=1)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    rows = df.orderBy("file", "split_start", "row", "part").collect()
    for name, text in texts.items():
        found = [r["text"] for r in rows if r["file"].endswith(f"/{name}")]
        assert found == reference_documents(text, 1)


def test_sample_and_bad_bytes(spark, folder):
    with open(f"{folder}/a.txt", "wb") as handle:
        handle.write(b" first   document \ncontinued\n\nsecond \xff document\n")
    rows = documents.read_documents(spark, f"{folder}/a.txt", 1).orderBy("row", "part").collect()
    assert [r["text"] for r in rows] == ["first document continued", "second � document"]


def test_min_chars_counts_code_points(spark):
    df = spark.createDataFrame([("😀😀",), ("ab",), ("abc",)], "text string")
    assert documents.min_chars_filter(df, 3).count() == 1
    assert documents.min_chars_filter(df, 2).count() == 3
    with pytest.raises(ValueError, match="non-negative"):
        documents.min_chars_filter(df, -1)
    with pytest.raises(documents.EmptyDatasetError):
        documents.require_documents(documents.min_chars_filter(df, 4))


def test_the_last_document_validates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 3), ("b", 2)], "source string, doc_id bigint")
    rows = documents.split_last(df, "doc_id").where("split = 'validation'").collect()
    assert [r["doc_id"] for r in rows] == [5]
    rows = documents.split_last(df, "doc_id", ["source"]).where("split = 'validation'").collect()
    assert {r["doc_id"] for r in rows} == {5, 3}
    with pytest.raises(ValueError, match="at least two"):
        documents.require_split(df.limit(1))


def test_split_keeps_rows_without_a_group(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "g string, n long")
    found = {(r["g"], r["n"]): r["split"] for r in documents.split_last(rows, "n", ["g"]).collect()}
    assert found == {("a", 1): "train", ("a", 2): "validation", (None, 3): "validation"}
