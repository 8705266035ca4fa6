"""Structured datasets read as one text field."""

from __future__ import annotations

import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.text import json_payload
from corpusmill.plans.staging import broadcast_if_small, stage
from corpusmill.sources.files import open_folder


def text_column(df: DataFrame, text_field: str = "text") -> Column:
    """The text field of a dataset; a dataset without one, or of another type, is an error."""
    if text_field not in df.columns:
        raise ValueError(f"dataset has no text field {text_field}")
    if not isinstance(df.schema[text_field].dataType, T.StringType):
        raise ValueError(f"{text_field} does not hold strings")
    return F.col(text_field)


def text_payload(df: DataFrame, text_field: str = "text") -> Column:
    """Each record as one-line JSON; a missing or non-string field is an error."""
    text = text_column(df, text_field)
    problem = F.raise_error(F.lit(f"{text_field} does not hold strings")).cast("string")
    return F.when(text.isNull(), problem).otherwise(json_payload(text))


def dataset_records(
    df: DataFrame, source_id: Column, pos: Column, text_field: str = "text"
) -> DataFrame:
    """A dataset as ``source_id, pos, payload``."""
    return df.select(
        source_id.alias("source_id"),
        pos.cast("bigint").alias("pos"),
        text_payload(df, text_field).alias("payload"),
    )


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A parquet dataset of texts, scanned with the split sizes of the caller's session.

    A file of a single row group, which no split size can divide, is dealt out once; it is
    at most one task's work, even where the scan has more (then empty) tasks. Anything else
    is left as it is.
    """
    rows = spark.read.parquet(path)
    return rows.repartition(spark.sparkContext.defaultParallelism) if _undivided(rows) else rows


def _undivided(rows: DataFrame) -> bool:
    """Whether all rows are one row group; files of other stores are judged by their tasks."""
    files = rows.inputFiles()
    if len(files) != 1:
        return False
    if not files[0].startswith("file:"):
        return rows.rdd.getNumPartitions() == 1
    store, plain = open_folder(files[0])
    with store.open_input_file(plain) as held:
        return pq.ParquetFile(held).num_row_groups <= 1


def soft_payload(text: Column) -> Column:
    """Each record as one-line JSON; NULL for a missing text, which only counts if it is kept."""
    return F.when(text.isNotNull(), json_payload(text))


def read_numbered(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    after: int = 0,
    max_bytes: int | None = None,
    size: Column | None = None,
    where: Column | None = None,
) -> DataFrame:
    """A dataset with ``pos``, the number of the row in file order, counted from 1.

    Files go by path; rows inside a file by the row index the parquet reader reports. Files
    whose rows all come up to ``after`` are not read. With ``max_bytes``, files are measured
    (``size`` of the rows that ``where`` selects) in groups that double, until the limit is
    passed; the files behind are not read either.
    """
    if file_format != "parquet":
        raise ValueError("row numbers need a parquet dataset; pass a position column instead")
    rows = spark.read.parquet(path)
    placed = rows.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    )
    per_file = stage(placed.groupBy("__file").agg(F.count("*").alias("rows")), "files")
    # One row per file, as many as the driver has listed to plan the scan.
    earlier = (
        Window.partitionBy(F.lit(0))
        .orderBy("__file")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("__before")
    starts = stage(per_file.select("__file", "rows", before), "file_offsets")
    numbers = broadcast_if_small(starts.select("__file", "__before"))

    def numbered(of: DataFrame) -> DataFrame:
        with_file = of.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
        joined = with_file.join(numbers, "__file").withColumn("pos", F.col("__before") + F.col("__row") + 1)
        return joined.where(F.col("pos") > after).drop("__file", "__row", "__before")

    if not after and max_bytes is None:
        return numbered(rows)
    names = [r["__file"] for r in starts.where(F.col("__before") + F.col("rows") > after).orderBy("__file").select("__file").collect()]
    if not names:
        return numbered(rows).limit(0)
    if max_bytes is not None:
        have, upto = 0, 0
        while upto < len(names) and have <= max_bytes:
            group = names[upto : max(1, 2 * upto)]
            chosen = numbered(spark.read.schema(rows.schema).option("basePath", path).parquet(*group))
            chosen = chosen if where is None else chosen.where(where)
            have += chosen.agg(F.sum(size)).first()[0] or 0
            upto += len(group)
        names = names[:upto]
    return numbered(spark.read.schema(rows.schema).option("basePath", path).parquet(*names))
