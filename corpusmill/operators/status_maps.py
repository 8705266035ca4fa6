"""Status changes judged in parallel: a change is a map of the states, and maps compose.

A change to a status takes the states that allow it to that status and leaves the others as
they are. One after another, changes are again such a map, written as eight digits, one per
state. Blocks of an entity's changes are composed apart, then the blocks, so an entity with
most of the events is as parallel as any other. Inside a task all blocks are composed at
once, in as many array steps as the longest block has binary digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.lifecycle import known_status
from corpusmill.operators.prefix import BLOCK_BITS, FAN_BITS, required
from corpusmill.plans.staging import stage
from corpusmill.schemas import PENDING, STATES, TRANSITIONS

IDENTITY = "".join(str(k) for k in range(len(STATES)))
CHUNK_ROWS = 65_536


def change_map(status: str) -> str:
    """Where a change to ``status`` takes each state."""
    return "".join(str(STATES.index(status if (s, status) in TRANSITIONS else s)) for s in STATES)


def digit(status: Column) -> Column:
    """The number of a status as a digit."""
    pairs = [x for k, s in enumerate(STATES) for x in (F.lit(s), F.lit(str(k)))]
    return F.create_map(*pairs)[status]


def status_of(number: Column) -> Column:
    return F.array(*[F.lit(s) for s in STATES])[number.cast("int")]


def applied(mapping: Column, state: Column) -> Column:
    """The digit a map has for a state's digit."""
    return F.substring(mapping, state.cast("int") + 1, F.lit(1))


def composed(first: Column, then: Column) -> Column:
    return F.concat(*[applied(then, F.substring(first, k + 1, 1)) for k in range(len(STATES))])


def prefixes(maps: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Composition of every row's map with those before it, back to row number ``begin``."""
    done = maps.copy()
    place = np.arange(len(maps)) - begin
    step = 1
    while (rows := np.flatnonzero(place >= step)).size:
        done[rows] = np.take_along_axis(done[rows], done[rows - step], axis=1)
        step *= 2
    return done


def _segments(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple]:
    """Sorted rows in pieces: table, first rows of segments, whether the first one goes on
    from the piece before, and composed maps from each segment's begin on."""
    last, carried = None, None
    for table in _pieces(batches):
        columns = [table.column(k).to_numpy() for k in keys]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        goes_on = last is not None and all(c[0] == x for c, x in zip(columns, last, strict=True))
        first = np.flatnonzero(new)
        begin = np.repeat(first, np.diff(np.append(first, len(new))))
        maps = np.array(table.column("map").to_pylist(), f"S{len(STATES)}").view(np.uint8).reshape(-1, len(STATES)) - 48
        whole = prefixes(maps, begin)
        if goes_on:
            head = first[1] if len(first) > 1 else len(new)
            whole[:head] = np.take_along_axis(whole[:head], np.broadcast_to(carried, (head, len(STATES))), axis=1)
        yield table, first, goes_on, whole, carried
        last, carried = [c[-1] for c in columns], whole[-1].copy()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, count = [], 0
    for batch in batches:
        held, count = [*held, batch], count + batch.num_rows
        if count >= CHUNK_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held).combine_chunks()


def _text(maps: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(maps + 48).view(f"S{len(STATES)}").ravel()
    return pa.array(flat.astype(str).tolist(), pa.string())


def _dealt(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return rows.select(*keys, *order, "map").repartition(*keys).sortWithinPartitions(*keys, *order)


def whole_maps(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``keys, map``: all maps of a group composed in order."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for table, first, goes_on, whole, _ in _segments(batches, keys):
            if held is not None and not goes_on:
                yield held
            last = np.append(first[1:], table.num_rows) - 1
            ends = table.take(pa.array(last)).select(keys).append_column("map", _text(whole[last]))
            ends = ends.combine_chunks().to_batches()[0]
            if ends.num_rows > 1:
                yield ends.slice(0, ends.num_rows - 1)
            held = ends.slice(ends.num_rows - 1)
        if held is not None:
            yield held

    kinds = dict(rows.dtypes)
    shape = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return _dealt(rows, keys, order).mapInArrow(fold, f"{shape}, map string")


def maps_before(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``keys, order, map, before``: what all earlier maps of the group compose to."""

    def earlier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first, goes_on, whole, carried in _segments(batches, keys):
            before = np.roll(whole, 1, axis=0)
            before[first] = np.arange(len(STATES), dtype=np.uint8)
            if goes_on:
                before[0] = carried
            yield from table.append_column("before", _text(before)).to_batches()

    kinds = dict(rows.dtypes)
    shape = ", ".join(f"{k} {kinds[k]}" for k in [*keys, *order])
    return _dealt(rows, keys, order).mapInArrow(earlier, f"{shape}, map string, before string")


def judged(events: DataFrame, states: DataFrame, bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame]:
    """Every change ``id, seq, status`` as accepted or refused, and the states afterwards.

    ``states`` has one row ``id, status`` per entity known so far; others start as pending.
    A refused change leaves the status as it was. Changes of one number go by their names.
    """
    mapping = F.create_map(*[F.lit(x) for s in STATES for x in (s, change_map(s))])
    rows = events.select(required("id").alias("id"), "seq", known_status(F.col("status")).alias("status"))
    rows = rows.select("id", F.shiftright("seq", bits).alias("block"), "seq", "status", mapping[F.col("status")].alias("map"))
    rows = stage(rows, "changes")
    blocks = stage(whole_maps(rows, ["id", "block"], ["seq", "status"]), "change_blocks")
    outer = blocks.withColumn("outer", F.shiftright("block", FAN_BITS))
    near = maps_before(outer, ["id", "outer"], ["block"]).select("id", "outer", "block", F.col("before").alias("near"))
    runs = whole_maps(outer, ["id", "outer"], ["block"])
    far = maps_before(runs, ["id"], ["outer"]).select("id", "outer", F.col("before").alias("far"))
    known = states.select("id", digit(F.col("status")).alias("at"))
    at = F.coalesce("at", F.lit(str(STATES.index(PENDING))))
    entered = near.join(far, ["id", "outer"]).join(known, "id", "left")
    entered = entered.select("id", "block", applied(composed(F.col("far"), F.col("near")), at).alias("entry"))
    placed = maps_before(rows, ["id", "block"], ["seq", "status"]).join(entered, ["id", "block"])
    before = applied(F.col("before"), F.col("entry"))
    result = placed.select(
        "id",
        "seq",
        status_of(before).alias("from_status"),
        F.col("status").alias("to_status"),
        (applied(F.col("map"), before) == digit(F.col("status"))).alias("accepted"),
    )
    changed = whole_maps(runs, ["id"], ["outer"]).withColumnRenamed("map", "change")
    after = known.join(changed, "id", "full").select(
        "id", status_of(applied(F.coalesce("change", F.lit(IDENTITY)), at)).alias("status")
    )
    return result, after
