import os

import pytest
from pyspark.errors import PySparkException

import corpus_pipeline
from corpusmill.plans import queries
from corpusmill.sources.lines import scan_files, scan_lines

BODIES = [b"one\ntwo\r\nthree\r\r\n\nlast without end", b"", b"\xef\xbb\xbfmark\n" + b"x" * 60 + b"\n\r\n", b"a\n" * 12]


def rows(df):
    return sorted((os.path.basename(r["file"]), r["record_index"], r["end_offset"], bytes(r["payload"])) for r in df.collect())


@pytest.mark.parametrize("split_bytes", [9, 1 << 20])
def test_known_files_read_like_a_scan(spark, folder, split_bytes):
    listed = []
    for k, body in enumerate(BODIES):
        with open(f"{folder}/{k}.txt", "wb") as out:
            out.write(body)
        listed.append((f"{folder}/{k}.txt", len(body)))
    files = spark.createDataFrame(listed, "file string, length bigint")
    assert rows(scan_files(files, split_bytes)) == rows(scan_lines(spark, folder))
    assert scan_files(files.limit(0)).count() == 0
    with pytest.raises(PySparkException, match="no line offsets"):
        scan_files(spark.createDataFrame([("/x.gz", 3)], "file string, length bigint")).collect()


def test_tasks_do_not_grow_with_the_number_of_files(spark, folder):
    spark.range(300).selectExpr(
        "id AS doc_id", "concat('s', id % 150) AS source", "repeat('text ', 9) AS text"
    ).write.parquet(f"{folder}/documents.parquet")
    found = queries.line_scan(spark, folder)
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert found.count() == 300


def test_dropping_rows_does_not_shuffle_texts(spark, folder):
    docs = spark.range(60).selectExpr("id AS doc_id", "concat_ws(' ', id % 50, 'a', id % 50, 'b', id % 50 + 7, 'c') AS text")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = corpus_pipeline.keep_one_of_group(spark, docs, folder)
        assert "BroadcastHashJoin" in left._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in left._jdf.queryExecution().executedPlan().toString()
        assert left.count() <= 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
