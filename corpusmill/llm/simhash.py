"""Near-duplicates by SimHash, found by the generalised pigeonhole principle.

Bits that vary together are grouped into partitions. Thresholds per partition, with a sum
of ``distance - partitions + 1`` (a partition of -1 is skipped), are chosen by dynamic
programming over estimated probes and candidates; any allocation finds every pair, so the
sample that the estimates come from cannot lose one. A threshold is shared between both
sides: a fingerprint is held under the codes within half of it and asks for those within
the rest, so two codes within the threshold meet. Every candidate is verified on all bits.

Equal fingerprints are one node. A code shared by very many different fingerprints is
compared in blocks of bounded size, of which only a spanning forest of links is kept.

Defined results: a NULL or empty text has fingerprint zero and links like any other; NULL
ids take part and never name a group unless all its ids are NULL; repeated rows are kept;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.plans.staging import stage

BITS = 64
SEED = 42
SAMPLE = 2048  # fingerprints that the layout is fitted on
# Measured costs of a probe and a candidate: for equal codes, which are compared in arrays,
# and for codes within a threshold, which are joined.
EQUAL_COSTS = 1.0, 0.007
NEAR_COSTS = 0.5, 0.05
DIRECT_PAIRS = 1 << 18  # a code with more pairs is compared in blocks
BLOCK = 1024


# --- fingerprints ---------------------------------------------------------------


def fingerprint(text: str, words: int = 4) -> int:
    """The fingerprint of one text; zero without words."""
    from xxhash import xxh64_intdigest

    # bytes.lower() changes A-Z only, and split() cuts at the six ASCII white-space bytes.
    own = text.encode().lower().split()
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) <= words:
        hashes = np.array([xxh64_intdigest(joined, SEED)], "<u8")
    else:
        ends = np.cumsum([len(w) + 1 for w in own]) - 1
        first = [0, *(ends[: len(own) - words] + 1).tolist()]
        parts = (joined[a:b] for a, b in zip(first, ends[words - 1 :].tolist(), strict=True))
        hashes = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), "<u8", len(first))
    # How often each byte value occurs at each of the eight places gives the bit counts.
    places = hashes.view(np.uint8).reshape(-1, 8) + _PLACES
    seen = np.bincount(places.ravel(), minlength=8 * 256).reshape(8, 256)
    counts = (seen @ _BYTE_BITS).ravel()
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


_PLACES = np.arange(8, dtype=np.int64) * 256
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, fp``: the fingerprint as a signed 64-bit number."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(x.as_py()) for x in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"]
            )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    return rows.mapInArrow(mark, "id long, fp long")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- layout ----------------------------------------------------------------------


def layout(sample: np.ndarray, total: int, distance: int) -> list[tuple[list[int], int]]:
    """Partitions ``(bits, threshold)`` for a self-join of ``total`` fingerprints."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    spread = bits.astype(float) - bits.mean(axis=0) if len(bits) else np.zeros((0, BITS))
    size = np.sqrt((spread**2).sum(axis=0)) + 1e-9
    related = np.abs(spread.T @ spread / np.outer(size, size))
    best = None
    for parts in range(2, distance + 2):
        groups = _grouped(related, parts)
        cost, thresholds = _allocated(groups, bits, total, distance)
        if best is None or cost < best[0]:
            best = cost, list(zip(groups, thresholds, strict=True))
    return [(g, t) for g, t in best[1] if t >= 0]


def _grouped(related: np.ndarray, parts: int) -> list[list[int]]:
    """Equal partitions; each takes the free bit most related to those it has."""
    free, groups = list(range(BITS)), []
    for k in range(parts):
        width = (BITS - sum(map(len, groups))) // (parts - k)
        group: list[int] = []
        while len(group) < width:
            pull = related[np.ix_(free, group or free)].sum(axis=1)
            group.append(free.pop(int(np.argmax(pull))))
        groups.append(sorted(group))
    return groups


def _allocated(
    groups: list[list[int]], bits: np.ndarray, total: int, distance: int
) -> tuple[float, list[int]]:
    """The cheapest thresholds whose sum is ``distance - partitions + 1``."""
    costs = []
    for group in groups:
        own = bits[:, group].astype(np.int16)
        apart = own @ (1 - own.T) + (1 - own) @ own.T
        seen = np.bincount(apart.ravel(), minlength=len(group) + 1).cumsum() - len(own)
        pairs = max(len(own) * (len(own) - 1), 1)
        row = [0.0]
        for t in range(distance + 1):
            asked, held = _ball(len(group), t - t // 2), _ball(len(group), t // 2)
            share = max(seen[min(t, len(group))] / pairs, asked * held / 2.0 ** len(group))
            probe, candidate = NEAR_COSTS if t else EQUAL_COSTS
            row.append(total * (probe * asked + candidate * share * total))
        costs.append(row)
    # Thresholds start at -1, so the steps above it add up to distance + 1.
    table = {0: (0.0, [])}
    for row in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in table.items():
            for steps, more in enumerate(row):
                now = used + steps
                if now <= distance + 1 and (now not in following or cost + more < following[now][0]):
                    following[now] = cost + more, [*chosen, steps - 1]
        table = following
    return table[distance + 1]


def _ball(width: int, radius: int) -> int:
    return sum(comb(width, k) for k in range(radius + 1))


# --- links -----------------------------------------------------------------------


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """Edges ``a, b`` that connect all fingerprints ``fp`` linked at ``distance`` bits or fewer.

    ``nodes`` is a staged table of distinct fingerprints.
    """
    total = nodes.count()
    chance = min(1.0, 4 * SAMPLE / max(total, 1))
    drawn = F.shiftrightunsigned(F.xxhash64("fp"), 11) / F.lit(float(1 << 53)) < chance
    rows = nodes.where(drawn).orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()
    sample = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
    plan = layout(sample, total, distance)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for part, (bits, threshold) in enumerate(plan):
                code = own & np.uint64(sum(1 << b for b in bits))
                for t in range(threshold - threshold // 2 + 1):
                    held = pa.array(np.full(len(own), t <= threshold // 2))
                    for flips in combinations(bits, t):
                        near = code ^ np.uint64(sum(1 << b for b in flips))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(own), part, np.int32)), pa.array(near.view(np.int64)), held, batch.column(0)],
                            ["part", "code", "held", "fp"],
                        )

    # Every entry asks for its code; those with ``held`` are found under it.
    entries = nodes.select("fp").mapInArrow(codes, "part int, code long, held boolean, fp long")
    entries = stage(entries, "entries")
    near = [part for part, (_, threshold) in enumerate(plan) if threshold]
    masks = [np.uint64(sum(1 << b for b in bits)).view(np.int64) for bits, _ in plan]
    own = [F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(int(m))).alias("code")) for k, m in enumerate(masks)]
    shared = nodes.select(F.inline(F.array(*own))).groupBy("part", "code").agg(F.count(F.lit(1)).alias("n"))
    large = stage(shared.where(F.col("n") > int(DIRECT_PAIRS**0.5) // 8).select("part", "code"), "large")
    if large.isEmpty():
        return _direct(entries, near, distance)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, near = (c.to_numpy() for c in batch.columns)
            for part, (bits, threshold) in enumerate(plan):
                code = near[parts == part].view(np.uint64)
                for t in range(threshold - threshold // 2 + 1):
                    for flips in combinations(bits, t):
                        there = (code ^ np.uint64(sum(1 << b for b in flips))).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), part, np.int32)), pa.array(there)], ["part", "code"])

    # Only codes near a large one can be asked for very often; such a code goes its own way
    # even if nobody is held there.
    busy = stage(large.mapInArrow(around, "part int, code long").distinct(), "busy")
    sizes = entries.join(_small(busy), ["part", "code"]).groupBy("part", "code").agg(
        F.sum(F.col("held").cast("long")).alias("held"), F.count(F.lit(1)).alias("asked")
    )
    heavy = stage(sizes.where(F.greatest("held", F.lit(1)) * F.col("asked") > DIRECT_PAIRS), "heavy")
    if heavy.isEmpty():
        return _direct(entries, near, distance)
    rest = entries.join(_small(heavy.select("part", "code")), ["part", "code"], "left_anti")
    return _direct(rest, near, distance).unionByName(_blocked(entries, heavy.where("held > 0"), distance))


def _small(staged: DataFrame) -> DataFrame:
    """Broadcast a counted table of two numbers a row while it is under about 16 MB."""
    return F.broadcast(staged) if staged.count() <= 500_000 else staged


def _direct(entries: DataFrame, near: list[int], distance: int) -> DataFrame:
    """Links under the other codes; the parts ``near`` have thresholds above zero."""
    equal = _met(entries.where(~F.col("part").isin(near)), distance)
    wide = entries.where(F.col("part").isin(near))
    held = wide.where("held").select("part", "code", F.col("fp").alias("b"))
    linked = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= distance
    found = wide.join(held, ["part", "code"]).where((F.col("fp") < F.col("b")) & linked)
    return equal.unionByName(found.select(F.col("fp").alias("a"), "b"))


def _met(entries: DataFrame, distance: int) -> DataFrame:
    """Links of those who share a code, code by code in sorted order."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Those under the code that the last batch ended in.
        last, waiting = None, np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            part, code, fp = (c.to_numpy() for c in batch.columns)
            change = np.flatnonzero((part[1:] != part[:-1]) | (code[1:] != code[:-1])) + 1
            begins = np.concatenate([[0], change])
            early = waiting if last == (part[0], code[0]) else waiting[:0]
            pool = np.concatenate([early, fp])
            first = np.repeat([0, *(change + len(early))], np.diff([*begins, len(fp)]))
            for row, place in _before(np.arange(len(early), len(pool)), first):
                a, b = pool[row], pool[place]
                near = np.bitwise_count((a ^ b).view(np.uint64)) <= distance
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[near]), pa.array(np.maximum(a, b)[near])], ["a", "b"])
            waiting = pool if len(begins) == 1 else fp[begins[-1] :]
            last = part[-1], code[-1]

    together = entries.repartition("part", "code").sortWithinPartitions("part", "code")
    return together.select("part", "code", "fp").mapInArrow(compare, "a long, b long")


def _before(rows: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row with every place from its ``first`` to the one before it, in bounded pieces."""
    total = np.cumsum(rows - first)
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 20), "right")))
        times = (rows - first)[at:to]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        yield np.repeat(rows[at:to], times), np.repeat(first[at:to], times) + step
        at = to


def _blocked(entries: DataFrame, heavy: DataFrame, distance: int) -> DataFrame:
    """Links under heavy codes: every block of the held against every block of those who ask."""
    key = ["part", "code"]

    def blocks(rows: DataFrame, count: str, name: str) -> DataFrame:
        own = rows.drop("held").join(_small(heavy), key)
        number = F.pmod(F.xxhash64("fp", F.lit(7)), F.ceil(F.col(count) / BLOCK)).alias(name)
        # About BLOCK fingerprints a block: the hash spreads a code over its blocks.
        return own.select(*key, number, "fp").groupBy(*key, name).agg(F.collect_list("fp").alias(f"{name}s"))

    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.ceil(F.col(c) / BLOCK) - 1))
    pairs = heavy.withColumn("held_by", numbers("held")).withColumn("asked_by", numbers("asked"))
    pairs = pairs.select(*key, "held_by", "asked_by").repartition("part", "code", "held_by", "asked_by")
    held = blocks(entries.where("held"), "held", "held_by")
    joined = pairs.join(held, [*key, "held_by"])
    joined = joined.join(blocks(entries, "asked", "asked_by"), [*key, "asked_by"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x = batch.column(0)[k].values.to_numpy().view(np.uint64)
                y = batch.column(1)[k].values.to_numpy().view(np.uint64)
                near = np.bitwise_count(x[:, None] ^ y[None, :]) <= distance
                nodes, roots = forest(x.view(np.int64), y.view(np.int64), near)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])

    return joined.select("held_bys", "asked_bys").mapInArrow(compare, "a long, b long")


def forest(x: np.ndarray, y: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked node of a block with the smallest node it is connected to in the block."""
    top = np.iinfo(np.int64).max
    label_x, label_y = x.copy(), y.copy()
    while True:
        new_x = np.minimum(label_x, np.where(near, label_y[None, :], top).min(axis=1, initial=top))
        new_y = np.minimum(label_y, np.where(near, new_x[:, None], top).min(axis=0, initial=top))
        if np.array_equal(new_x, label_x) and np.array_equal(new_y, label_y):
            break
        label_x, label_y = new_x, new_y
    nodes, roots = np.concatenate([x, y]), np.concatenate([label_x, label_y])
    keep = nodes != roots
    return nodes[keep], roots[keep]


def near_groups(docs: DataFrame, id_col: str, text_col: str, distance: int = 4) -> DataFrame:
    """``id, fp, component``: the smallest id reachable by links, for every row."""
    rows = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    named = stage(components(links(nodes, distance)), "components")
    joined = nodes.join(named, nodes.fp == named.node, "left")
    root = F.coalesce("component", "fp").alias("root")
    members = joined.select("fp", "least", root)
    least = members.groupBy("root").agg(F.min("least").alias("component"))
    by_fp = stage(members.join(least, "root").select("fp", "component"), "groups")
    # A fingerprint that many rows share is split by adaptive execution.
    return rows.join(by_fp, "fp").select("id", "fp", "component")
