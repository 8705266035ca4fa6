"""Running totals that never sort a whole group in one task.

Positions are integers that are unique inside a group, so a block of ``2**bits``
neighbouring positions cannot hold more than ``2**bits`` rows, whatever the skew.
Rows are summed inside their block, block totals are summed inside blocks of
blocks, and so on; each window has a fixed upper bound on its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.plans.staging import stage

# 4,096 positions per block, then three levels of 131,072: together 63 bits.
BLOCK_BITS = 12
FAN_BITS = 17
LEVELS = 3
BLOCK = "__block"


def running_totals(
    df: DataFrame,
    group: list[str],
    pos: str,
    totals: dict[str, Column],
    bits: int = BLOCK_BITS,
    staged: bool = False,
) -> DataFrame:
    """Add the total of each value over the group up to and including the row.

    ``df`` is read twice: once for the totals of blocks, which are summed before they are
    shuffled and written out, and once for the rows, of which only those of one block are
    sorted together. ``staged`` says that ``df`` is cheap to read, so the totals of blocks
    need no copy. Group keys must not be NULL (see :func:`required`).
    """
    rows = df.withColumn(BLOCK, F.shiftright(F.col(pos), bits))
    upto = (
        Window.partitionBy(*group, BLOCK)
        .orderBy(pos)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = rows.withColumns({f"__in_{n}": F.sum(v).over(upto) for n, v in totals.items()})
    per_block = rows.groupBy(*group, BLOCK).agg(*[F.sum(v).alias(n) for n, v in totals.items()])
    if staged:
        spread = F.max(BLOCK) - F.min(BLOCK)
        few = (rows.agg(spread.alias("spread")).first()["spread"] or 0) < 1 << FAN_BITS
    else:
        per_block = stage(per_block, "blocks")
        few = per_block.count() <= 1 << FAN_BITS
    levels = 1 if few else LEVELS
    before = totals_before(per_block, group, BLOCK, list(totals), levels=levels)
    return inside.join(before, [*group, BLOCK]).select(
        *[c for c in df.columns if c not in totals],
        *[(F.col(f"__in_{n}") + F.col(f"__before_{n}")).alias(n) for n in totals],
    )


def totals_before(
    per_block: DataFrame,
    group: list[str],
    block: str,
    names: list[str],
    fan_bits: int = FAN_BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """For each block, ``__before_<name>``: the totals of all earlier blocks of its group.

    With one level all blocks of a group are sorted together. Each further level first
    adds up runs of ``2**fan_bits`` neighbouring blocks.
    """
    if levels == 1:
        return _summed_before(per_block, group, block, names, "__before_")
    outer = f"{block}_{levels}"
    rows = per_block.withColumn(outer, F.shiftright(F.col(block), fan_bits))
    inside = _summed_before(rows, [*group, outer], block, names, "__near_")
    per_outer = rows.groupBy(*group, outer).agg(*[F.sum(n).alias(n) for n in names])
    before = totals_before(per_outer, group, outer, names, fan_bits, levels - 1)
    return inside.join(before, [*group, outer]).select(
        *group,
        block,
        *[(F.col(f"__near_{n}") + F.col(f"__before_{n}")).alias(f"__before_{n}") for n in names],
    )


def required(key: str) -> Column:
    """A group key; NULL is an error, since such rows could not be placed."""
    problem = F.raise_error(F.lit(f"NULL in key {key}"))
    return F.when(F.col(key).isNull(), problem).otherwise(F.col(key))


def _summed_before(
    rows: DataFrame, keys: list[str], order: str, names: list[str], prefix: str
) -> DataFrame:
    earlier = (
        Window.partitionBy(*([F.col(k) for k in keys] or [F.lit(0)]))
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = [F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{prefix}{n}") for n in names]
    return rows.select(*keys, order, *sums)
