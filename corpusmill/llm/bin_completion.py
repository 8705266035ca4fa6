"""Packing by bin completion over the counts of piece lengths.

Documents are cut into pieces of at most a sequence; only a document's first piece may be
shorter. Lengths are whole numbers up to the sequence length, so the packing problem is
fully given by one count per length. A bin is completed around the largest length left:
undominated fillings of the remaining space are enumerated, largest first, under a bound
on the waste that is still affordable, and the best-fit filling is the incumbent. Choices
are taken back depth first, counts without a plan are remembered, and a number of steps
bounds the search. A chosen filling is first used as often as the counts allow, so the plan
is a short list of fillings with multiplicities; Spark then numbers the pieces of each
length and looks up their place.

Defined results: a NULL text is empty and gives one piece with the end id; repeated rows
are packed each on its own; a NULL id stays NULL; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b
from operator import neg
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.slices import slices
from corpusmill.llm.encoding import PieceEncoder
from corpusmill.llm.token_files import batches_of
from corpusmill.plans.staging import stage

SEARCH_STEPS = 20_000  # steps to one bin of the first descent before the best so far is taken
PLAN_STEPS = 2_000_000  # steps of the search for a plan with fewer bins
NUMBERED_ROWS = 100_000  # pieces of one length that are numbered together, about


def token_pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str, text_col: str,
    added_tokens: bool = False, cached_pieces: int | None = None,
) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` of every piece of every document.

    With ``added_tokens`` the vocabulary's added tokens are recognised, else plain text.
    Fewer ``cached_pieces`` than the encoder's own number take less memory and more time.
    """
    schema = "id long, piece int, start long, length long, ids_crc32 long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(vocabulary, added_tokens, cached_pieces)
        rows = (
            (key, text)
            for batch in slices(batches)
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        )
        for group in batches_of(rows):
            out = []
            for (key, _), found in zip(group, encoder.encode([t for _, t in group]), strict=True):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    out.append((key, k, a, b - a, crc32(ids[a:b].tobytes())))
            columns = list(zip(*out, strict=True))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    return rows.mapInArrow(cut, schema)


# --- the plan over counts ------------------------------------------------------


def fillings(
    space: int, lengths: list[int], counts: dict[int, int], least: int, slack: int, left: list[int]
) -> Iterator[tuple]:
    """Undominated fillings of ``space`` that waste ``least`` to ``slack``, largest items first.

    ``lengths`` falls. A filling is dominated when an unused item still fits, or when an
    item could be exchanged for a larger free one that fits, so those are not given.
    ``left`` holds the steps that may still be taken; below zero the list is not complete.
    """
    lengths = lengths[bisect_left(lengths, -space, key=neg) :]
    end = len(lengths)
    reach = [0] * (end + 1)  # the most that the items from k on can fill
    for k in range(end - 1, -1, -1):
        reach[k] = min(space, reach[k + 1] + lengths[k] * counts[lengths[k]])
    open_ = [(0, space, ())]
    while open_:
        left[0] -= 1
        if left[0] < 0:
            return
        k, room, chosen = open_.pop()
        k = bisect_left(lengths, -room, k, key=neg)
        if k == end:
            if least <= room <= slack and not (room and _dominated(room, chosen, lengths, counts)):
                yield room, chosen
        elif room - reach[k] <= slack:
            x = lengths[k]
            open_ += [
                (k + 1, room - n * x, (*chosen, (x, n)) if n else chosen)
                for n in range(min(room // x, counts[x]) + 1)
            ]


def _dominated(waste: int, chosen: tuple, lengths: list[int], counts: dict[int, int]) -> bool:
    used = dict(chosen)
    free = [x for x in lengths if counts[x] > used.get(x, 0)]
    # A larger free item in place of a chosen one would waste less.
    return any(x < y <= x + waste for x in used for y in free) or bool(free and free[-1] <= waste)


def _best_fit(space: int, lengths: list[int], counts: dict[int, int]) -> tuple[int, tuple]:
    chosen = []
    for x in lengths:
        n = min(space // x, counts[x]) if x <= space else 0
        if n:
            chosen.append((x, n))
            space -= n * x
    return space, tuple(chosen)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any plan needs: those of large items, and what smaller ones cannot share.

    For each threshold, items above ``capacity - threshold`` stay alone among those counted,
    items above half a bin need one each, and the rest must fit into what these leave.
    """
    number, size = np.zeros(capacity + 2, np.int64), np.arange(capacity + 2)
    for k, n in counts.items():
        number[k] = n
    items, mass = np.cumsum(number), np.cumsum(number * size)
    half = capacity // 2
    low = np.arange(1, half + 1)
    alone = items[capacity] - items[capacity - low]
    paired = items[capacity - low] - items[half]
    room = paired * capacity - (mass[capacity - low] - mass[half])
    rest = mass[half] - mass[low - 1] - room
    bins = alone + paired + np.maximum(0, -(-rest // capacity))
    return max(-(-int(mass[-1]) // capacity), int(bins.max(initial=0)))


def completion_plan(
    counts: dict[int, int], capacity: int, steps: int = PLAN_STEPS
) -> list[tuple[int, tuple]]:
    """Fillings ``(times, ((length, number), ...))`` that use up the counts.

    Branch and bound: a first descent, then plans of one bin less as long as the search
    finds one. It ends at the lower bound, when no such plan exists, or after ``steps``.
    """
    least = lower_bound(counts, capacity)
    best = _descent(counts, capacity)
    size = sum(t for t, _ in best)
    left = [steps]
    while size > least:
        other = _plan_within(counts, capacity, size - 1, left)
        if other is None:
            break
        best, size = other, sum(t for t, _ in other)
    return best


def _descent(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple]]:
    """Each bin completed with the least waste, without a way back."""
    left, plan = {k: n for k, n in counts.items() if n > 0}, []
    while left:
        first, falling, own = _opened(left)
        space = capacity - first
        best = _best_fit(space, falling, own)
        if best[0]:
            for found in fillings(space, falling, own, 0, best[0] - 1, [SEARCH_STEPS]):
                best = min(best, found, key=lambda x: x[0])
                if best[0] == 0:
                    break
        items = _with(first, best[1])
        times = min(left[x] // n for x, n in items)
        plan.append((times, items))
        left = _without(left, times, items)
    return plan


def _plan_within(
    counts: dict[int, int], capacity: int, bins: int, left: list[int]
) -> list[tuple[int, tuple]] | None:
    """A plan of at most so many bins, depth first with a way back to every choice.

    ``None`` when there is none, or when ``left``, the steps, fell below zero.
    """
    start = {k: n for k, n in counts.items() if n > 0}
    exhausted: dict[bytes, int] = {}  # counts without a plan of so many bins
    path: list[tuple] = []  # per bin: what it leaves, bins for that, choices, the one taken
    state, room = start, bins
    while True:
        if not state:
            return [frame[-1] for frame in path]
        key = blake2b(repr(sorted(state.items())).encode(), digest_size=16).digest()
        left[0] -= len(state)
        if exhausted.get(key, -1) < room and lower_bound(state, capacity) <= room:
            path.append([state, room, key, _choices(state, capacity, room, left), None])
        while path:
            frame = path[-1]
            frame[-1] = next(frame[3], None)
            if left[0] < 0:
                return None
            if frame[-1] is not None:
                break
            exhausted[frame[2]] = max(frame[1], exhausted.get(frame[2], -1))
            path.pop()
        if not path:
            return None
        times, items = path[-1][-1]
        state, room = _without(path[-1][0], times, items), path[-1][1] - times


def _choices(state: dict[int, int], capacity: int, bins: int, left: list[int]) -> Iterator[tuple]:
    """``times, items`` of the bin around the largest length, about by rising waste.

    A filling is tried as often as it goes and then once, which leaves every other number
    of times to the bins after it.
    """
    spare = bins * capacity - sum(k * n for k, n in state.items())
    first, falling, own = _opened(state)
    space = capacity - first
    low, high = 0, 0
    while low <= min(space, spare):
        for waste, chosen in fillings(space, falling, own, low, min(high, space, spare), left):
            items = _with(first, chosen)
            times = min(state[x] // n for x, n in items)
            if waste:
                times = min(times, spare // waste)
            yield times, items
            if times > 1:
                yield 1, items
        low, high = high + 1, 2 * high + 1


def _opened(state: dict[int, int]) -> tuple[int, list[int], dict[int, int]]:
    """The largest length, and the falling lengths and counts of what may join it."""
    falling = sorted(state, reverse=True)
    first, own = falling[0], dict(state)
    own[first] -= 1
    return first, falling if own[first] else falling[1:], own


def _with(first: int, chosen: tuple) -> tuple:
    items = dict(chosen)
    items[first] = items.get(first, 0) + 1
    return tuple(sorted(items.items(), reverse=True))


def _without(state: dict[int, int], times: int, items: tuple) -> dict[int, int]:
    out = dict(state)
    for x, n in items:
        out[x] -= times * n
        if not out[x]:
            del out[x]
    return out


# --- places for the pieces -------------------------------------------------------


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id, offset`` to pieces with a ``length`` of 1 to ``capacity``."""
    rows = stage(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    total = rows.count()
    groups = max(1, total // NUMBERED_ROWS)
    rows = rows.withColumn("__part", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    counted = stage(rows.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # At most one row per length and group of about NUMBERED_ROWS pieces.
    earlier = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(
        "length", "__part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before")
    )
    # One count for each length, at most ``capacity`` of them.
    per_length = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = completion_plan({int(r["length"]): int(r["n"]) for r in per_length}, capacity)
    segments = _segments(plan)

    inside = Window.partitionBy("length", "__part").orderBy("__row")
    ranked = rows.withColumn("__in", F.row_number().over(inside) - 1)
    ranked = ranked.join(before, ["length", "__part"])
    ranked = ranked.withColumn("__rank", F.col("__before") + F.col("__in"))

    shared = rows.sparkSession.sparkContext.broadcast(segments)
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, bins, numbers, offsets = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy()
            lo, hi = np.searchsorted(lengths, length, "left"), np.searchsorted(lengths, length, "right")
            at = np.empty(len(rank), np.int64)
            for x in np.unique(length):
                own = length == x
                a, b = lo[own][0], hi[own][0]
                at[own] = a + np.searchsorted(ranks[a:b], rank[own], "right") - 1
            inner = rank - ranks[at]
            number = numbers[at]
            columns = [batch.column(n) for n in names]
            columns.append(pa.array(bins[at] + inner // number))
            columns.append(pa.array(offsets[at] + inner % number * length))
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def _segments(plan: list[tuple[int, tuple]]) -> tuple[np.ndarray, ...]:
    """Which ranks of a length go to which bins, sorted by length and rank."""
    used: dict[int, int] = {}
    rows, bin_id = [], 0
    for times, items in plan:
        offset = 0
        for length, number in items:
            rank = used.get(length, 0)
            rows.append((length, rank, bin_id, number, offset))
            used[length] = rank + times * number
            offset += length * number
        bin_id += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    lengths, ranks, bins, numbers, offsets = map(np.ascontiguousarray, table.T)
    return lengths, ranks, bins, numbers, offsets
