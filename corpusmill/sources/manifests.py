"""Manifests that list compressed JSON-lines files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import strip
from corpusmill.plans.staging import broadcast_if_small, stage
from corpusmill.sources.lines import scan_lines
from corpusmill.sources.ranges import read_lines


def manifest_entries(spark: SparkSession, manifest: str) -> DataFrame:
    """``file_index, url`` of a manifest; blank lines are left out but counted."""
    whole = spark.read.text(manifest, wholetext=True)
    listed = whole.select(F.posexplode(F.split("value", "\n")).alias("file_index", "line"))
    url = strip(F.col("line"))
    problem = F.raise_error(F.concat(F.lit("manifest entry is not an https URL: "), url))
    return listed.where(url != "").select(
        "file_index",
        F.when(url.startswith("https://"), url).otherwise(problem.cast("string")).alias("url"),
    )


def manifest_records(
    spark: SparkSession,
    manifest: str,
    mirror: dict[str, str] | None = None,
    compressed: bool = True,
    after_file: int = 0,
    after_record: int = 0,
    max_bytes: int | None = None,
    max_records: int | None = None,
) -> DataFrame:
    """Records of all listed files: ``file_index, record_index, payload``.

    ``payload`` is the original line. ``mirror`` maps URL prefixes to folders Spark can
    read. Every line must be a JSON object with a string ``text``; otherwise the query fails.

    With a cursor (the file and the number of its last record that is done) or a limit, files
    before the cursor and behind the limit are not opened, and what they hold is not checked.
    """
    entries = [(row["file_index"], row["url"]) for row in manifest_entries(spark, manifest).collect()]
    if not entries:
        return spark.createDataFrame([], "file_index int, record_index bigint, payload binary")
    # The scan is planned from this list of files, so the driver holds it in any case.
    placed = [(index, _resolve(url, mirror or {})) for index, url in entries]
    if after_file or after_record or max_bytes is not None or max_records is not None:
        part = read_lines(
            spark,
            placed,
            first_file=after_file,
            first_record=after_record,
            max_bytes=max_bytes,
            max_records=max_records,
            compressed=True,
        )
        return part.select("file_index", "record_index", checked_json(F.col("payload")).alias("payload"))
    paths = sorted({path for _, path in placed})
    lines = scan_lines(spark, paths, whole_files=compressed)
    index = stage(spark.createDataFrame(placed, "file_index int, path string"), "manifest")
    joined = lines.withColumn("path", _plain_path(F.col("file"))).join(
        broadcast_if_small(index.withColumn("path", _plain_path(F.col("path")))), "path"
    )
    return joined.select("file_index", "record_index", checked_json(F.col("payload")).alias("payload"))


def checked_json(payload: Column) -> Column:
    """The payload itself when it is a JSON object with a string ``text``."""
    line = payload.cast("string")
    parsed = F.try_parse_json(line)
    text = F.schema_of_variant(F.try_variant_get(parsed, "$.text", "variant"))
    broken = F.raise_error(F.lit("a line of the shard cannot be read as JSON")).cast("binary")
    missing = F.raise_error(F.lit("a line of the shard has no text that is a string")).cast("binary")
    return (
        F.when(parsed.isNull(), broken)
        .when(F.coalesce(text, F.lit("")) == "STRING", payload)
        .otherwise(missing)
    )


def _resolve(url: str, mirror: dict[str, str]) -> str:
    for prefix, folder in mirror.items():
        if url.startswith(prefix):
            return folder.rstrip("/") + "/" + url[len(prefix) :].lstrip("/")
    return url


def _plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")
