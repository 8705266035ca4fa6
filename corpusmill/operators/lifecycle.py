"""Status histories: what is current, and which changes were not allowed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.prefix import BLOCK_BITS, FAN_BITS, required
from corpusmill.schemas import PENDING, STATES, TRANSITIONS


def transition_allowed(before: Column, after: Column) -> Column:
    """Whether a status may follow another; staying the same always may."""
    pairs = [(before == a) & (after == b) for a, b in TRANSITIONS]
    return (before == after) | reduce(lambda x, y: x | y, pairs)


def known_status(status: Column) -> Column:
    """The status itself; anything but the eight states is an error."""
    problem = F.raise_error(F.concat(F.lit("unknown status: "), F.coalesce(status, F.lit("NULL"))))
    return F.when(status.isin(*STATES), status).otherwise(problem.cast("string"))


def with_previous(
    events: DataFrame, key: str, seq: str, value: str, first: str, bits: int = BLOCK_BITS
) -> DataFrame:
    """Add ``previous``: the value of the key's preceding event, or ``first``.

    Rows are compared inside blocks of sequence numbers. Only the last value of each
    block is carried to the key's next block, so one key may hold most of the events.
    """
    block = "__block"
    rows = events.withColumns({key: required(key), block: F.shiftright(F.col(seq), bits)})
    inside = Window.partitionBy(key, block).orderBy(seq)
    placed = rows.withColumns({"__before": F.lag(value).over(inside), "__rank": F.row_number().over(inside)})
    ends = rows.groupBy(key, block).agg(F.max_by(value, seq).alias("__end"))
    carried = _carry(ends, key, block).withColumn("__rank", F.lit(1))
    joined = placed.join(carried, [key, block, "__rank"], "left")
    previous = F.coalesce("__before", "__carried", F.lit(first))
    return joined.select(*events.columns, previous.alias("previous"))


def _carry(ends: DataFrame, key: str, block: str) -> DataFrame:
    """For each block of a key, the end value of the block before it; in two levels."""
    outer = "__outer"
    rows = ends.withColumn(outer, F.shiftright(F.col(block), FAN_BITS))
    near = Window.partitionBy(key, outer).orderBy(block)
    far = Window.partitionBy(key).orderBy(outer)
    last = rows.groupBy(key, outer).agg(F.max_by("__end", block).alias("__last"))
    last = last.select(key, outer, F.lag("__last").over(far).alias("__far"))
    close = rows.select(key, block, outer, F.lag("__end").over(near).alias("__near"))
    return close.join(last, [key, outer]).select(
        key, block, F.coalesce("__near", "__far").alias("__carried")
    )


def lifecycle_audit(
    events: DataFrame, key: str = "id", seq: str = "seq", status: str = "status"
) -> DataFrame:
    """Status changes that the lifecycle does not allow, from a history of each entity."""
    checked = events.withColumn(status, known_status(F.col(status)))
    changes = with_previous(checked, key, seq, status, PENDING)
    return changes.where(~transition_allowed(F.col("previous"), F.col(status)))


def apply_status(events: DataFrame, key: str = "id") -> DataFrame:
    """Current state of each entity from its history ``seq, status, error, ts``.

    The error is that of the last event, so a later event without one clears it.
    """

    def last_time(state: str, name: str) -> Column:
        return F.max_by(F.when(F.col("status") == state, F.col("ts")), F.when(F.col("status") == state, F.col("seq"))).alias(name)

    return events.groupBy(key).agg(
        F.max_by("status", "seq").alias("status"),
        F.max_by(F.struct("error"), "seq").getField("error").alias("last_error"),
        F.max_by("ts", "seq").alias("updated_at"),
        last_time("RUNNING", "last_started_at"),
        last_time("COMPLETED", "last_completed_at"),
        last_time("PAUSED", "paused_at"),
        last_time("FAILED", "failed_at"),
    )
