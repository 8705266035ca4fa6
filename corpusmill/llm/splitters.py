"""Sharding by sampled splitters: equal bytes per shard, in one order of keys.

Records are ordered by (hash of the text, id, row), so copies of one text are neighbours
and still divisible. Size-weighted samples of the keys give splitters; ranges that hold
too many rows get splitters of their own. Exact byte totals of the ranges then place the
shard borders, so the shards differ by about one record however the sample fell.

Only DataFrame functions are used. Defined results: a NULL text has no bytes and the
checksum 0; a NULL id sorts first; repeated rows are kept, each with its own slot; an
empty table gives an empty result; other columns of the input are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.plans.staging import stage

RECORD_BYTES = 16
FAN = 1024  # ranges per level
SAMPLES = 16  # sampled keys per range
RANGE_ROWS = 200_000  # a range of more rows is divided again
KEY = ("__hash", "__id", "__row")


def shard_by_bytes(
    df: DataFrame, shards: int, id_col: str, text_col: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``id_col, size, text_crc32, shard, slot`` for every row of ``df``.

    ``size`` is the text's UTF-8 bytes plus 16; shards are contiguous in the key order and
    a row belongs to the shard that holds the middle of its bytes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = df.select(
        F.col(id_col).cast("bigint").alias("__own"),
        (F.octet_length(text) + RECORD_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("__hash"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("__id"),
        F.monotonically_increasing_id().alias("__row"),
        F.lit(0).cast("bigint").alias("__range"),
    )
    rows = stage(narrow, "sizes")
    ranged = _divided(rows, _range_totals(rows).withColumn("pieces", F.lit(FAN)))
    ranged = stage(ranged, "ranges")
    pieces = F.ceil(F.col("rows") * 2 / range_rows).cast("int")
    overfull = _range_totals(ranged).where(F.col("rows") > range_rows)
    plan = overfull.withColumn("pieces", F.least(pieces, F.lit(FAN)))
    ranged = _divided(ranged, plan)

    before = _totals_before(_range_totals(ranged))
    total = before.agg(F.max(F.col("__before") + F.col("bytes")).alias("n")).first()["n"]
    inside = (
        Window.partitionBy("__range").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, 0)
    )
    # At most FAN * FAN ranges of four numbers each.
    placed = ranged.join(F.broadcast(before), "__range")
    end = F.col("__before") + F.sum("size").over(inside)
    numbered = placed.select(
        "__own",
        "size",
        "text_crc32",
        (F.floor((end * 2 - F.col("size")) * shards / (2.0 * (total or 1)))).alias("__shard"),
        (F.col("__rows_before") + F.row_number().over(inside) - 1).alias("__place"),
    )
    numbered = numbered.withColumn("shard", F.least("__shard", F.lit(shards - 1)).cast("int"))
    numbered = stage(numbered.drop("__shard"), "places")
    first = numbered.groupBy("shard").agg(F.min("__place").alias("__first"))
    # One row per shard.
    return numbered.join(F.broadcast(first), "shard").select(
        F.col("__own").alias(id_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("__place") - F.col("__first")).alias("slot"),
    )


def _range_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("__range").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")
    )


def _totals_before(totals: DataFrame) -> DataFrame:
    """Rows and bytes of earlier ranges, summed in runs of ``FAN`` ranges first."""
    rows = totals.withColumn("__run", F.shiftright("__range", 10))
    runs = rows.groupBy("__run").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    # At most FAN runs, and at most FAN ranges in each.
    earlier = Window.partitionBy(F.lit(0)).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    near = Window.partitionBy("__run").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "__run",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("__run_rows"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("__run_bytes"),
    )
    return rows.join(F.broadcast(runs), "__run").select(
        "__range",
        "bytes",
        (F.col("__run_rows") + F.coalesce(F.sum("rows").over(near), F.lit(0))).alias("__rows_before"),
        (F.col("__run_bytes") + F.coalesce(F.sum("bytes").over(near), F.lit(0))).alias("__before"),
    )


def _divided(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Split each range that ``plan`` lists into its ``pieces`` at sampled quantiles.

    ``plan`` has at most ``FAN`` rows ``__range, rows, bytes, pieces``.
    """
    weight = F.greatest(F.col("size"), F.col("bytes") / (F.col("pieces") * SAMPLES))
    chance = F.col("size") * F.col("pieces") * SAMPLES / F.col("bytes")
    draw = F.shiftrightunsigned(F.xxhash64(*KEY, F.lit(17)), 11) / F.lit(float(1 << 53))
    sample = (
        rows.join(F.broadcast(plan), "__range")
        .where(draw < chance)
        .select("__range", "pieces", F.struct(*KEY).alias("key"), weight.alias("weight"))
    )
    # At most about FAN * SAMPLES keys, or twice that many over all ranges, are sorted here.
    whole = Window.partitionBy("__range")
    upto = whole.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    piece = F.floor(F.sum("weight").over(upto) * F.col("pieces") / F.sum("weight").over(whole))
    cuts = (
        sample.withColumn("piece", piece)
        .withColumn("last", F.lag("piece").over(whole.orderBy("key")))
        .where(F.col("piece") > F.col("last"))
        .groupBy("__range")
        .agg(F.sort_array(F.collect_list("key")).alias("cuts"))
    )
    # At most FAN keys for each of at most FAN ranges.
    found = rows.join(F.broadcast(cuts), "__range", "left")
    part = F.coalesce(_count_upto(F.col("cuts"), F.struct(*KEY)), F.lit(0))
    return found.withColumn("__range", F.col("__range") * FAN + part).drop("cuts")


def _count_upto(cuts: Column, key: Column) -> Column:
    """How many of the sorted cuts are at or below the key, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in range(10, -1, -1)])

    def step(found: Column, width: Column) -> Column:
        inside = found + width <= F.size(cuts)
        below = F.get(cuts, F.least(found + width, F.size(cuts)) - 1) <= key
        return F.when(inside & below, found + width).otherwise(found)

    return F.when(F.size(cuts) > 0, F.aggregate(steps, F.lit(0), step))
