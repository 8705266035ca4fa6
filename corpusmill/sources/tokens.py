"""Token ids and packed blocks as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusmill.functions.numbers import whole_div
from corpusmill.operators.packing import packed_bytes
from corpusmill.sources.shards import write_shards


def id_line(ids: Column) -> Column:
    """Ids of one document as one line; an empty document is an empty line."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ")


def write_token_ids(token_docs: DataFrame, path: str, order: str, ids: str = "ids") -> int:
    """Write one line of ids per document, in order over the part files; return the tokens."""
    seen = Observation()
    # Counted above the sort, which runs once; below it, the sampling would count too.
    placed = token_docs.select(order, ids).orderBy(order)
    counted = placed.observe(seen, F.sum(F.size(ids).cast("bigint")).alias("tokens"))
    counted.select(id_line(F.col(ids)).alias("value")).write.text(path)
    return int(seen.get["tokens"] or 0)


def read_token_ids(spark, path: str) -> DataFrame:
    """Ids of each line of written token files, with the order of the lines."""
    text = spark.read.option("lineSep", "\n").text(path)
    present = F.filter(F.split("value", " "), lambda x: x != "")
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"),
        F.transform(present, lambda x: x.cast("int")).alias("ids"),
    )


def write_packed(blocks: DataFrame, root: str, name: str, blocks_per_file: int = 1 << 20) -> DataFrame:
    """Write blocks as little-endian 32-bit rows, neighbouring blocks in one file.

    Files are ``{name}-%06d.bin`` in block order; one row per file is returned.
    """
    number = whole_div(F.col("block_id"), blocks_per_file) + 1
    rows = blocks.select(
        F.lit(name).alias("source_id"),
        number.alias("shard_sequence"),
        F.col("block_id").alias("pos"),
        packed_bytes(F.col("ids")).alias("payload"),
    )
    key = F.format_string("%s-%06d.bin", F.col("source_id"), F.col("shard_sequence"))
    return write_shards(rows, F.col("payload"), key, root, record_end=b"")
