"""A content-addressed WARC archive: payloads once, record headers apart.

``write_archive`` stores each distinct payload under its SHA-256 and the exact header
block of every record in a second table; ``read_archive`` joins both back to records, and
``read_index`` reads those records: header fields, body by its length, revisits through
the response they refer to.
Payloads are checked against their digest whenever they are read, and a payload whose
bytes differ from another one's under the same digest fails the write.

Defined results: a NULL html is an empty payload; a NULL page id is the smallest and is
written as an empty id; of repeated rows with the largest id one is the response and the
others revisit it; an empty table gives an empty archive; other columns are not stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.plans.staging import new_path, stage
from corpusmill.sources.files import PendingObject

# The RFC 4648 alphabet, the WARC version line and the profile of revisits.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION_LINE = "WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of binary data in upper-case base32."""
    digest = F.sha1(payload)
    letters = F.lit(BASE32)
    parts = []
    for block in range(4):
        bits = F.conv(F.substring(digest, block * 10 + 1, 10), 16, 10).cast("bigint")
        for place in range(8):
            five = F.shiftright(bits, 35 - 5 * place).bitwiseAND(F.lit(31)).cast("int")
            parts.append(F.substring(letters, five + 1, F.lit(1)))
    return F.concat(*parts)


def _block(*lines: Column) -> Column:
    """Header lines; a NULL line is left out."""
    present = F.filter(F.array(*lines), lambda x: x.isNotNull())
    return F.concat(F.lit(VERSION_LINE), F.array_join(present, "\r\n"), F.lit(RECORD_END))


def _line(name: str, value: Column) -> Column:
    # A line break inside a value would end the header early.
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\\r\\n]+", " "))


def write_archive(
    pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE
) -> None:
    """Write ``page_id, url, html`` rows as ``path/payloads`` and ``path/headers``.

    Records with equal payloads of at least ``min_bytes`` bytes share one response: that
    of the largest page id. The others are revisits that refer to it.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = stage(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("page_id").cast("bigint").alias("page_id"),
            F.col("url").cast("string").alias("url"),
            F.sha2(payload, 256).alias("digest"),
            base32_sha1(payload).alias("sha1"),
            F.length(payload).cast("bigint").alias("bytes"),
        ),
        "records",
    )
    # Combined in each task before the shuffle; a second checksum verifies the digest.
    stored = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"))
    distinct = stored.groupBy("digest").agg(
        F.first("payload").alias("payload"),
        F.min(F.crc32("payload")).alias("low"),
        F.max(F.crc32("payload")).alias("high"),
    )
    same = F.col("low") == F.col("high")
    clash = F.raise_error(F.lit("payloads that differ have the same digest")).cast("binary")
    distinct.select("digest", F.when(same, F.col("payload")).otherwise(clash).alias("payload")).write.parquet(
        f"{path}/payloads"
    )

    order = F.struct(F.col("page_id").isNotNull(), "page_id", "row")
    first = records.groupBy("digest").agg(F.max(order).alias("first"))
    # A digest that many records share is split by adaptive execution.
    joined = records.join(first, "digest")
    shared = F.col("bytes") >= min_bytes
    revisit = shared & (F.col("row") != F.col("first.row"))
    urn = lambda page, row: F.concat_ws(
        ":", F.lit("<urn:page"), F.coalesce(page.cast("string"), F.lit("")), F.concat(row.cast("string"), F.lit(">"))
    )
    header = _block(
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn(F.col("page_id"), F.col("row"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, _line("WARC-Profile", F.lit(PROFILE))),
        F.when(revisit, _line("WARC-Refers-To", urn(F.col("first.page_id"), F.col("first.row")))),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, 0).otherwise(F.col("bytes")).cast("string")),
    )
    joined.select("row", "digest", header.alias("header")).write.parquet(f"{path}/headers")


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    damaged = F.raise_error(F.lit("a stored payload does not match its digest")).cast("binary")
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(damaged)
    return stored.select("digest", checked.alias("payload"))


def _headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("row long, digest string, header string").parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The whole records: ``row`` and ``record``, the bytes as a WARC file holds them.

    Only responses have a body, so a payload that many records share moves once.
    """
    headers = _headers(spark, path)
    is_response = _field("header", "WARC-Type") == "response"
    end = F.lit(RECORD_END).cast("binary")
    whole = headers.where(is_response).join(_payloads(spark, path), "digest").select(
        "row", F.concat(F.col("header").cast("binary"), F.col("payload"), end).alias("record")
    )
    bare = headers.where(~is_response).select("row", F.concat(F.col("header").cast("binary"), end).alias("record"))
    return whole.union(bare)


def _field(header: str, name: str) -> Column:
    return F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)", 1)


def parse_records(records: DataFrame) -> DataFrame:
    """Header fields of ``record`` and the size and digest of its body, read from its bytes.

    A record whose length is not that of its header and ``Content-Length``, or a response
    whose body has another digest than its header says, fails the query.
    """
    text = F.col("record").cast("string")
    headed = records.select("record", F.concat(F.substring_index(text, RECORD_END, 1), F.lit("\r\n")).alias("header"))
    start = F.octet_length("header") + 2
    size = _field("header", "Content-Length").cast("int")
    sound = F.octet_length("record") == start + size + len(RECORD_END)
    torn = F.raise_error(F.lit("a record's length is not what its header says")).cast("binary")
    body = F.when(sound, F.substring("record", start + 1, size)).otherwise(torn)
    parsed = headed.select(
        _field("header", "WARC-Record-ID").alias("record_id"),
        _field("header", "WARC-Type").alias("record_type"),
        _field("header", "WARC-Refers-To").alias("target"),
        F.substring(_field("header", "WARC-Payload-Digest"), 6, 32).alias("said"),
        F.length(body).cast("bigint").alias("bytes"),
        base32_sha1(body).alias("digest"),
    )
    wrong = F.raise_error(F.lit("a header's digest is not that of its payload")).cast("string")
    right = (F.col("record_type") != "response") | (F.col("said") == F.col("digest"))
    return parsed.select("record_id", "record_type", "target", F.when(right, F.col("said")).otherwise(wrong).alias("said"), "bytes")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Each rebuilt record with the size and digest of its full payload.

    A revisit has both from the response that it refers to; one without it fails the query.
    """
    records = stage(parse_records(read_archive(spark, path)), "records-read")
    responses = records.where(F.col("record_type") == "response")
    shared = responses.select(F.col("record_id").alias("target"), F.col("said").alias("own"), F.col("bytes").alias("full"))
    revisits = records.where(F.col("record_type") != "response").join(shared, "target", "left")
    astray = F.raise_error(F.lit("a revisit's response is missing or has another digest")).cast("bigint")
    met = F.coalesce(F.col("said") == F.col("own"), F.lit(False))
    resolved = revisits.withColumn("bytes", F.when(met, F.col("full")).otherwise(astray)).select(responses.columns)
    return responses.union(resolved).select(
        _page(F.col("record_id")).alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("said").alias("payload_digest"),
        "record_type",
        _page(F.col("target")).alias("refers_to"),
    )


def _page(urn: Column) -> Column:
    text = F.regexp_extract(urn, "^<urn:page:(-?[0-9]*):", 1)
    return F.when(text != "", text.cast("bigint"))


def export_warc(spark: SparkSession, path: str, root: str) -> DataFrame:
    """Write the records as ``root/part-*.warc`` files, in record order inside a file.

    Returns ``file, records, bytes`` of each file; a retried task replaces its own file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        target, records, size = None, 0, 0
        for batch in batches:
            for record in batch.column("record"):
                if target is None:
                    key = f"part-{task.partitionId():06d}.warc"
                    target = PendingObject(root, key, task.taskAttemptId())
                target.write(record.as_buffer())
                records, size = records + 1, size + record.as_buffer().size
        if target is not None:
            target.publish()
            yield pa.RecordBatch.from_pydict(
                {"file": [target.key], "records": [records], "bytes": [size]}
            )

    ordered = read_archive(spark, path).repartitionByRange("row").sortWithinPartitions("row")
    return stage(ordered.mapInArrow(write, "file string, records long, bytes long"), "warc-files")


def archive_folder(spark: SparkSession) -> str:
    return new_path(spark, "warc")
