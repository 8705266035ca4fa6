"""Record-aligned shards of at least a target size.

A shard closes with the first record that brings it to the target, and the next
one opens there, so each border depends on all earlier ones. To find the borders
of one huge source in parallel, every stretch of records is first summarised as a
step function: "if the shard open on entry began at byte ``b``, it closes at ...".
Step functions of neighbouring stretches are combined level by level; then the
true entry states are handed back down and each stretch is cut on its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.numbers import whole_div
from corpusmill.operators.prefix import BLOCK_BITS
from corpusmill.operators.quota import with_offsets
from corpusmill.plans.staging import broadcast_if_small, stage

LEAF_ROWS = 1 << 20
FAN_IN = 16

_OFFSETS = ("end_offset", "record_index")
_STEPS = "source_id string, node bigint, begin bigint, upto bigint, opened bigint, closes bigint"
_ENTRIES = "source_id string, node bigint, opened bigint, closes bigint"
_BORDERS = (
    "source_id string, shard_sequence bigint, last_pos bigint, end_offset bigint, "
    "record_index bigint"
)


def check_bounds(target: int, maximum: int) -> None:
    """Shard sizes must satisfy ``0 < target <= maximum``."""
    if not 0 < target <= maximum:
        raise ValueError("shard sizes must satisfy 0 < target <= maximum")


def shard_assign(
    sized: DataFrame,
    target: int,
    maximum: int | None = None,
    leaf_rows: int = LEAF_ROWS,
    fan_in: int = FAN_IN,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``shard_sequence`` (from 1 per source), ``end_offset`` and ``record_index``."""
    check_bounds(target, target if maximum is None else maximum)
    schema = _schema_plus(sized, "end_offset", "record_index", "shard_sequence")
    return _cut(sized, target, _number_rows(target), schema, leaf_rows, fan_in, bits)


def shard_borders(
    sized: DataFrame,
    target: int,
    maximum: int | None = None,
    leaf_rows: int = LEAF_ROWS,
    fan_in: int = FAN_IN,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """One row per shard: which positions it covers, its bytes and its records."""
    check_bounds(target, target if maximum is None else maximum)
    narrow = [c for c in sized.columns if c in ("source_id", "pos", "size", *_OFFSETS)]
    sized = sized.select(*narrow)
    ends = _cut(sized, target, _closing_rows(target), _BORDERS, leaf_rows, fan_in, bits)
    # Every stretch reports its last row as the end of the shard still open there;
    # the row that really ends the shard is the latest of them.
    last = ends.groupBy("source_id", "shard_sequence").agg(
        *[F.max(c).alias(c) for c in ("last_pos", "end_offset", "record_index")]
    )
    in_order = Window.partitionBy("source_id").orderBy("shard_sequence")
    before = {c: F.lag(c).over(in_order) for c in ("last_pos", "end_offset", "record_index")}
    return last.select(
        "source_id",
        "shard_sequence",
        before["last_pos"].alias("after_pos"),
        "last_pos",
        (F.col("end_offset") - F.coalesce(before["end_offset"], F.lit(0))).alias("size_bytes"),
        (F.col("record_index") - F.coalesce(before["record_index"], F.lit(0))).alias(
            "record_count"
        ),
        "record_index",
    )


def oversize_records(
    sized: DataFrame, maximum: int, strict: bool = False, bits: int = BLOCK_BITS
) -> DataFrame:
    """Records that cannot be stored: larger alone than the maximum shard size.

    By default only the first record of each source is looked at, as a running
    ingest does; ``strict`` reports every such record.
    """
    large = sized.where(F.col("size") > maximum)
    if strict:
        return large
    first = sized.groupBy("source_id").agg(F.min("pos").alias("first_pos"))
    return (
        large.join(first, "source_id").where(F.col("pos") == F.col("first_pos")).drop("first_pos")
    )


def tag_shards(records: DataFrame, borders: DataFrame) -> DataFrame:
    """Give each record the number of the shard that covers its position.

    ``borders`` must be a staged table. It has one short row per shard, so the
    positions are normally sent to all tasks and searched there, which moves no
    payload. A table too long for that is joined by position block instead.
    """
    borders = borders.select("source_id", "shard_sequence", "after_pos", "last_pos")
    if borders.count() <= SEARCHED_SHARDS:
        return _tag_by_search(records, borders)
    return _tag_by_join(records, borders)


SEARCHED_SHARDS = 4_000_000


def _tag_by_search(records: DataFrame, borders: DataFrame) -> DataFrame:
    spark = records.sparkSession
    listed = borders.orderBy("source_id", "shard_sequence").toPandas()
    table = {
        source: (part["last_pos"].to_numpy(), part["shard_sequence"].to_numpy())
        for source, part in listed.groupby("source_id", sort=False)
    }
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("bigint")
    def find(source: pa.Array, pos: pa.Array) -> pa.Array:
        names = source.dictionary_encode()
        codes = names.indices.to_numpy(zero_copy_only=False)
        at = pos.to_numpy(zero_copy_only=False)
        number = np.zeros(len(at), dtype=np.int64)
        for code, name in enumerate(names.dictionary.to_pylist()):
            mine = codes == code
            if name in shared.value:
                last, sequence = shared.value[name]
                slot = np.searchsorted(last, at[mine], "left")
                inside = slot < len(last)
                found = np.zeros(len(slot), dtype=np.int64)
                found[inside] = sequence[slot[inside]]
                number[mine] = found
        return pa.array(number, mask=number == 0)

    # Marked as not deterministic so that the filter below does not run it again.
    find = find.asNondeterministic()
    tagged = records.withColumn("shard_sequence", find(F.col("source_id"), F.col("pos")))
    return tagged.where(F.col("shard_sequence").isNotNull())


def _tag_by_join(records: DataFrame, borders: DataFrame) -> DataFrame:
    """Exact fallback: list the shards that meet each block of positions, then compare.

    Blocks are as wide as a quarter of a source's average shard, so a source has about
    four blocks per shard whatever its positions mean. The first listed border of a source
    takes everything up to its end, as the search does; tables of a later wave need not
    begin with the first shard.
    """
    block = "__block"
    # One row per source; its shards and their range of positions.
    spans = borders.groupBy("source_id").agg(
        F.min("last_pos").alias("low"), F.max("last_pos").alias("high"), F.count(F.lit(1)).alias("n")
    )
    width = F.greatest(whole_div(F.col("high") - F.col("low"), 4 * F.col("n")), F.lit(1).cast("bigint"))
    spans = stage(spans.select("source_id", "low", "high", width.alias("width")), "spans")
    spans = broadcast_if_small(spans)

    def block_of(pos):
        # Positions up to the first listed end share its block.
        return whole_div(F.greatest(pos, F.col("low")) - F.col("low"), F.col("width"))

    # Like the search: the first listed shard of a source reaches back to the start.
    since = F.when(F.col("last_pos") > F.col("low"), F.col("after_pos")).alias("since")
    opened = borders.join(spans, "source_id").select("*", since).withColumn(
        block,
        F.explode(
            F.sequence(block_of(F.coalesce(F.col("since") + 1, F.col("low"))), block_of(F.col("last_pos")))
        ),
    )
    opened = opened.select("source_id", block, "since", "last_pos", "shard_sequence")
    placed = records.join(spans, "source_id").withColumn(block, block_of(F.col("pos")))
    after = F.col("since").isNull() | (F.col("pos") > F.col("since"))
    return (
        placed.join(opened, ["source_id", block])
        .where(after & (F.col("pos") <= F.col("last_pos")))
        .select(*records.columns, "shard_sequence")
    )


# --- cutting -----------------------------------------------------------------


def _cut(
    sized: DataFrame,
    target: int,
    cut_leaf: Callable[[pd.DataFrame, int, int], pd.DataFrame],
    schema,
    leaf_rows: int,
    fan_in: int,
    bits: int,
) -> DataFrame:
    counted = set(_OFFSETS) <= set(sized.columns)
    # Written once: the rows are narrow, and both passes below must see the same cut.
    rows = stage(sized if counted else with_offsets(sized, bits), "offsets")
    leaves = rows.withColumn("node", whole_div(F.col("record_index") - 1, leaf_rows))
    longest = rows.agg(F.max("record_index")).first()[0] or 0
    count = max(math.ceil(longest / leaf_rows), 1)
    if count == 1:
        def whole(part: pd.DataFrame) -> pd.DataFrame:
            return cut_leaf(part.sort_values("pos"), 0, 0)

        return leaves.groupBy("source_id").applyInPandas(whole, schema)

    entries = _entry_states(leaves, target, count, fan_in)

    def entered(part: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        opened, closes = (int(entry[c].iloc[0]) for c in ("opened", "closes"))
        return cut_leaf(part.sort_values("pos"), opened, closes)

    return (
        leaves.groupBy("source_id", "node")
        .cogroup(entries.groupBy("source_id", "node"))
        .applyInPandas(entered, schema)
    )


def _entry_states(leaves: DataFrame, target: int, count: int, fan_in: int) -> DataFrame:
    """For each leaf: where the shard open on entry began and how many closed before."""

    def summarise(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        return _leaf_steps(part, target)

    def combine(part: pd.DataFrame) -> pd.DataFrame:
        return _combine_steps(part, target)

    def descend(steps: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        opened, closes = (int(entry[c].iloc[0]) for c in ("opened", "closes"))
        return _walk(steps, target, opened, closes)

    parent = whole_div(F.col("node"), fan_in).alias("parent")
    slim = leaves.select("source_id", "node", "pos", "size", "end_offset")
    levels = [
        stage(slim.groupBy("source_id", "node").applyInPandas(summarise, _STEPS), "steps")
    ]
    while count > fan_in:
        up = levels[-1].withColumn("parent", parent)
        combined = up.groupBy("source_id", "parent").applyInPandas(combine, _STEPS)
        levels.append(stage(combined, "steps"))
        count = math.ceil(count / fan_in)
    entries = (
        levels[-1].groupBy("source_id").applyInPandas(lambda s: _walk(s, target, 0, 0), _ENTRIES)
    )
    for level in reversed(levels[:-1]):
        below = level.withColumn("parent", parent)
        above = entries.withColumnRenamed("node", "parent")
        entries = (
            below.groupBy("source_id", "parent")
            .cogroup(above.groupBy("source_id", "parent"))
            .applyInPandas(descend, _ENTRIES)
        )
    return entries


def _number_rows(target: int):
    def cut(part: pd.DataFrame, opened: int, closes: int) -> pd.DataFrame:
        ends = part["end_offset"].to_numpy()
        borders = _closing_indexes(ends, target, opened)
        earlier = np.searchsorted(borders, np.arange(len(ends)), "left")
        part = part.drop(columns="node")
        part["shard_sequence"] = closes + 1 + earlier
        return part

    return cut


def _closing_rows(target: int):
    def cut(part: pd.DataFrame, opened: int, closes: int) -> pd.DataFrame:
        ends = part["end_offset"].to_numpy()
        borders = _closing_indexes(ends, target, opened)
        if not len(borders) or borders[-1] != len(ends) - 1:
            borders = np.append(borders, len(ends) - 1)
        picked = part.iloc[borders]
        return pd.DataFrame(
            {
                "source_id": picked["source_id"],
                "shard_sequence": closes + 1 + np.arange(len(borders)),
                "last_pos": picked["pos"],
                "end_offset": picked["end_offset"],
                "record_index": picked["record_index"],
            }
        )

    return cut


def _closing_indexes(ends: np.ndarray, target: int, opened: int) -> np.ndarray:
    """Rows that close a shard when the open one began at byte ``opened``."""
    found = []
    at = int(np.searchsorted(ends, opened + target, "left"))
    while at < len(ends):
        found.append(at)
        at = int(np.searchsorted(ends, ends[at] + target, "left"))
    return np.array(found, dtype=np.int64)


def _leaf_steps(part: pd.DataFrame, target: int) -> pd.DataFrame:
    """Step function of one stretch: one step per row that may be the first to close."""
    ends = part["end_offset"].to_numpy()
    begin = int(ends[0] - part["size"].iloc[0])
    steps = min(int(np.searchsorted(ends, begin + target, "left")) + 1, len(ends))
    upto = ends[:steps]
    opened, closes = upto.copy(), np.ones(steps, dtype=np.int64)
    at = np.searchsorted(ends, opened + target, "left")
    moving = np.flatnonzero(at < len(ends))
    while len(moving):
        opened[moving] = ends[at[moving]]
        closes[moving] += 1
        at[moving] = np.searchsorted(ends, opened[moving] + target, "left")
        moving = moving[at[moving] < len(ends)]
    return _steps_frame(part["source_id"].iloc[0], part["node"].iloc[0], begin, upto, opened, closes)


def _combine_steps(part: pd.DataFrame, target: int) -> pd.DataFrame:
    """Step function of neighbouring stretches taken together."""
    begin = int(part["begin"].min())
    children = _children(part)
    upto = opened = closes = np.empty(0, dtype=np.int64)
    for child in children:
        slot = np.searchsorted(child["upto"], opened + target, "left")
        hit = slot < len(child["upto"])
        opened, closes = opened.copy(), closes.copy()
        opened[hit] = child["opened"][slot[hit]]
        closes[hit] += child["closes"][slot[hit]]
        if not len(upto) or upto[-1] < begin + target:
            upto = np.concatenate([upto, child["upto"]])
            opened = np.concatenate([opened, child["opened"]])
            closes = np.concatenate([closes, child["closes"]])
    steps = min(int(np.searchsorted(upto, begin + target, "left")) + 1, len(upto))
    return _steps_frame(
        part["source_id"].iloc[0], part["parent"].iloc[0], begin, upto[:steps], opened[:steps], closes[:steps]
    )


def _walk(steps: pd.DataFrame, target: int, opened: int, closes: int) -> pd.DataFrame:
    """Follow one entry state through neighbouring stretches."""
    states = []
    for child in _children(steps):
        states.append((child["node"], opened, closes))
        slot = int(np.searchsorted(child["upto"], opened + target, "left"))
        if slot < len(child["upto"]):
            opened, closes = int(child["opened"][slot]), closes + int(child["closes"][slot])
    frame = pd.DataFrame(states, columns=["node", "opened", "closes"])
    frame.insert(0, "source_id", steps["source_id"].iloc[0])
    return frame


def _children(steps: pd.DataFrame) -> list[dict]:
    children = []
    for node, part in steps.sort_values(["node", "upto"]).groupby("node", sort=True):
        columns = {c: part[c].to_numpy() for c in ("upto", "opened", "closes")}
        children.append({"node": node, **columns})
    return children


def _steps_frame(source, node, begin, upto, opened, closes) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "source_id": source,
            "node": node,
            "begin": begin,
            "upto": upto,
            "opened": opened,
            "closes": closes,
        }
    )


def _schema_plus(df: DataFrame, *longs: str) -> T.StructType:
    fields = list(df.schema.fields)
    fields += [T.StructField(n, T.LongType()) for n in longs if n not in df.columns]
    return T.StructType(fields)
