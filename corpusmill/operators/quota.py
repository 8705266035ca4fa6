"""Ordered prefixes of a source: resume cursors, byte quotas, record limits.

Records come as ``(source_id, pos, size, ...)``. The columns worked on are narrow;
payloads are cut afterwards by comparing ``pos`` with one cut per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import stored_size
from corpusmill.operators.prefix import BLOCK_BITS, required, running_totals
from corpusmill.plans.staging import stage


def sized_records(
    df: DataFrame, source_id: str, pos: str, payload: Column, *keep: str
) -> DataFrame:
    """The narrow table the ordered operators work on: source, position, stored bytes.

    It is written once, so payloads are measured in a single pass over the input.
    """
    sized = df.select(
        required(source_id).alias("source_id"),
        required(pos).cast("bigint").alias("pos"),
        stored_size(payload).alias("size"),
        *keep,
    )
    return stage(sized, "sized")


def with_offsets(sized: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Add ``end_offset`` (bytes) and ``record_index`` (records), counted through the row.

    ``sized`` is read three times; it should come from :func:`sized_records`.
    """
    return running_totals(
        sized,
        ["source_id"],
        "pos",
        {"end_offset": F.col("size"), "record_index": F.lit(1).cast("bigint")},
        bits=bits,
        staged=True,
    )


def resume_after(sized: DataFrame, cursors: DataFrame) -> DataFrame:
    """Keep the records after each source's cursor; a source without one starts at the front.

    ``cursors`` has one row per source: ``source_id, cursor``.
    """
    joined = sized.join(cursors, "source_id", "left")
    return joined.where(F.col("cursor").isNull() | (F.col("pos") > F.col("cursor"))).drop("cursor")


def resume_after_file(records: DataFrame, file_index: int, record_index: int) -> DataFrame:
    """Resume a two-level source: later files whole, the cursor's file from its record on."""
    at = F.struct(F.col("file_index"), F.col("record_index"))
    cursor = F.struct(F.lit(file_index), F.lit(record_index).cast("bigint"))
    return records.where((F.col("file_index") >= file_index) & (at > cursor))


def quota_prefix(
    sized: DataFrame,
    limits: DataFrame | int,
    max_records: int | None = None,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Records in order up to the first one that would pass the byte limit of its source.

    ``limits`` is one number, or a table ``source_id, limit_bytes`` with one row per
    source; a source without one, or with a NULL limit, is not limited. Sizes are at least one byte, so the running total rises strictly and the
    comparison stops where a reader would stop.
    """
    rows = with_offsets(sized, bits)
    if isinstance(limits, DataFrame):
        rows = rows.join(limits, "source_id", "left")
        within = F.col("limit_bytes").isNull() | (F.col("end_offset") <= F.col("limit_bytes"))
        kept = rows.where(within).drop("limit_bytes")
    else:
        kept = rows.where(F.col("end_offset") <= F.lit(limits))
    return kept if max_records is None else record_limit(kept, max_records)


def record_limit(with_index: DataFrame, max_records: int) -> DataFrame:
    """The first ``max_records`` records of each source, counted from the resume point."""
    return with_index.where(F.col("record_index") <= max_records)


def remaining_limits(quotas: DataFrame, verified: DataFrame) -> DataFrame:
    """Bytes each source may still add: quota minus verified bytes."""
    left = F.col("max_bytes") - F.coalesce(F.col("verified_bytes"), F.lit(0))
    return quotas.join(verified, "source_id", "left").select(
        "source_id", left.alias("limit_bytes")
    )
