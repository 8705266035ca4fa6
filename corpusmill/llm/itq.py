"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A rotation is learned (on a bounded sample) so that the signs of the rotated, centred unit
vectors are balanced codes. The code is cut into substrings, one table each. Two unit
vectors of cosine ``c`` differ by ``2 - 2c`` in squared length, and every bit in which
their codes differ costs at least the squares of both projections there. So in some
substring one of the two can reach the other's code by flipping bits whose squared
projections sum to at most ``(1 - c) / substrings``: probing exactly those codes finds
every pair, whatever the rotation. Candidates are compared with the original vectors.

Equal vectors are one class. Members and probes of a code meet in blocks of bounded size;
a pair is counted in the first table that finds it, and of the links of a block only a
spanning forest is kept for the components.

Defined results: vectors that are NULL, empty, zero or not finite, or have no label, link
with nothing and stay; vectors of different lengths never link; repeated rows are vectors
of their own; NULL ids count as links but name no component unless all are NULL; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.llm.simhash import forest
from corpusmill.plans.staging import stage

MAX_BITS = 64
SAMPLE = 10_000
ROTATIONS = 30
BLOCK = 512
SCALE = 1 << 30  # squared projections as whole numbers, rounded down


def fit_rotation(vectors: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Centre and orthonormal projection to balanced bits, for unit vectors in rows."""
    size = vectors.shape[1]
    bits = min(MAX_BITS, size)
    random = np.random.default_rng(seed)
    centre = vectors.mean(axis=0) if len(vectors) else np.zeros(size)
    spread = vectors - centre
    _, axes = np.linalg.eigh(spread.T @ spread + 1e-12 * np.eye(size))
    axes = axes[:, ::-1][:, :bits]
    flat = spread @ axes
    turn, _ = np.linalg.qr(random.standard_normal((bits, bits)))
    for _ in range(ROTATIONS if len(vectors) else 0):
        left, _, right = np.linalg.svd(flat.T @ np.where(flat @ turn >= 0, 1.0, -1.0))
        turn = left @ right
    return centre, axes @ turn


def usable(vector: Column, label: Column) -> Column:
    values = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return label.isNotNull() & vector.isNotNull() & finite & F.exists(values, lambda x: x != 0.0)


def subset_masks(costs: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """All bit sets whose costs sum to at most the budget: row numbers and masks.

    ``costs`` has a row per vector and a column per bit. Sets grow over the bits in order
    of cost by appending the next bit or by moving the last one, so each comes once.
    """
    n, width = costs.shape
    order = np.argsort(costs, axis=1, kind="stable")
    cheap = np.take_along_axis(costs, order, 1)
    bit = np.uint64(1) << order.astype(np.uint64)
    rows, masks = [np.arange(n)], [np.zeros(n, np.uint64)]
    row = np.flatnonzero(cheap[:, 0] <= budget)
    last, cost, mask = np.zeros(len(row), np.int64), cheap[row, 0], bit[row, 0]
    while len(row):
        rows.append(row)
        masks.append(mask)
        more = last + 1 < width
        row, last, cost, mask = row[more], last[more], cost[more], mask[more]
        following = cheap[row, last + 1]
        joined = mask | bit[row, last + 1]
        added, moved = cost + following <= budget, cost - cheap[row, last] + following <= budget
        row, last, cost, mask = (
            np.concatenate([row[added], row[moved]]),
            np.concatenate([last[added], last[moved]]) + 1,
            np.concatenate([(cost + following)[added], (cost - cheap[row, last] + following)[moved]]),
            np.concatenate([joined[added], (joined ^ bit[row, last])[moved]]),
        )
    return np.concatenate(rows), np.concatenate(masks)


def _tables(bits: int, members: int) -> list[tuple[int, int]]:
    """Ranges of bits, each a few bits wider than it takes to tell the members apart."""
    wanted = max(1, round(bits / max(8.0, log2(max(members, 2)) + 3)))
    edges = [bits * k // wanted for k in range(wanted + 1)]
    return list(zip(edges, edges[1:], strict=False))


def near_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, cosine: float = 0.98) -> DataFrame:
    """``id, n_links, component`` of every row, by links of at least ``cosine`` in a label."""
    spark = df.sparkSession
    rows = stage(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("bigint").alias("id"),
            F.col(label_col).alias("label"),
            F.when(usable(F.col(vector_col), F.col(label_col)), F.transform(vector_col, lambda x: x.cast("double") + 0.0)).alias("vector"),
        ),
        "vectors",
    )
    valid = rows.where(F.col("vector").isNotNull()).withColumn("size", F.size("vector"))
    classes = valid.groupBy("label", "size", "vector").agg(
        F.min("row").alias("node"), F.min("id").alias("least"), F.count(F.lit(1)).alias("held")
    )
    classes = stage(classes, "classes")
    members = classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    drawn = classes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vector").toArrow().column(0).to_pylist()
    by_size: dict[int, list] = {}
    for v in drawn:
        by_size.setdefault(len(v), []).append(v)
    fitted = {k: fit_rotation(_unit(np.array(v))) for k, v in by_size.items()}
    model = spark.sparkContext.broadcast(fitted)
    # A little more than the exact bound, so that rounding cannot lose a pair.
    reach = (1 - cosine) * (1 + 1e-6) + 1e-9

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                vectors = own.column("vector").flatten().to_numpy().reshape(-1, size)
                centre, axes = model.value.get(int(size)) or fit_rotation(np.zeros((0, int(size))))
                along = (_unit(vectors) - centre) @ axes
                code = ((along >= 0).astype(np.uint64) << np.arange(along.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
                squares = np.minimum(along**2 * SCALE, SCALE).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(code.view(np.int64)), _lists(squares)],
                    [*own.schema.names, "bits", "squares"],
                )

    columns = classes.select("node", "held", "label", "size", "vector")
    shape = f"node long, held long, label {dict(classes.dtypes)['label']}, size int, vector array<double>"
    coded = stage(columns.mapInArrow(encode, f"{shape}, bits long, squares array<int>"), "codes")

    def places(batches: Iterator[pa.RecordBatch], probing: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy().view(np.uint64)
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                width = min(MAX_BITS, int(size))
                squares = batch.column("squares").take(pa.array(at)).flatten().to_numpy().reshape(-1, width).astype(np.int64)
                tables = _tables(width, members)
                budget = int(reach / len(tables) * SCALE)
                for t, (a, b) in enumerate(tables):
                    code = (bits[at] >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
                    which = np.arange(len(at))
                    if probing:
                        which, masks = subset_masks(squares[:, a:b], budget)
                        code = code[which] ^ masks
                    own = pa.array(at[which])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("label").take(own), batch.column("size").take(own), pa.array(np.full(len(which), t, np.int32)),
                         pa.array(code.astype(np.int64)), batch.column("node").take(own)],
                        ["label", "size", "part", "code", "node"],
                    )

    key = ["label", "size", "part", "code"]
    kind = f"label {dict(classes.dtypes)['label']}, size int, part int, code long, node long"
    narrow = coded.select("label", "size", "bits", "squares", "node")
    index = narrow.mapInArrow(lambda b: places(b, False), kind)
    probes = narrow.mapInArrow(lambda b: places(b, True), kind)

    held = index.groupBy(*key).agg(F.count(F.lit(1)).alias("held_n"))
    hits = stage(probes.join(held, key), "probes")
    asked = hits.groupBy(*key).agg(F.count(F.lit(1)).alias("asked_n"), F.first("held_n").alias("held_n"))
    # A code that only its own member asks for has no pair.
    asked = stage(asked.where((F.col("held_n") > 1) | (F.col("asked_n") > 1)), "asked")
    carried = coded.select("node", F.struct("node", "held", "vector", "bits", "squares").alias("member"))

    def blocks(rows: DataFrame, count: str, name: str) -> DataFrame:
        number = F.pmod(F.xxhash64("node", F.lit(3)), F.ceil(F.col(count) / BLOCK)).alias(name)
        own = rows.join(asked, key).select(*key, number, "node").join(carried, "node")
        # About BLOCK members a block: the hash spreads a code over its blocks.
        return own.groupBy(*key, name).agg(F.collect_list("member").alias(f"{name}s"))

    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.ceil(F.col(c) / BLOCK) - 1))
    pairs = asked.withColumn("held_by", numbers("held_n")).withColumn("asked_by", numbers("asked_n"))
    pairs = pairs.select(*key, "held_by", "asked_by")
    joined = pairs.join(blocks(index, "held_n", "held_by"), [*key, "held_by"])
    joined = joined.join(blocks(hits.drop("held_n"), "asked_n", "asked_by"), [*key, "asked_by"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            parts, sizes = batch.column("part").to_numpy(), batch.column("size").to_numpy()
            for k in range(batch.num_rows):
                size = int(sizes[k])
                tables = _tables(min(MAX_BITS, size), members)
                x = _members(batch.column("asked_bys")[k].values, size)
                y = _members(batch.column("held_bys")[k].values, size)
                found.append(_compared(x, y, int(parts[k]), tables, int(reach / len(tables) * SCALE), cosine))
            if found:
                a, b, n = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"])

    seen = joined.select("part", "size", "asked_bys", "held_bys").mapInArrow(compare, "a long, b long, n long")
    seen = stage(seen, "links")
    counts = seen.groupBy("a").agg(F.sum("n").alias("n"))
    named = components(seen.where(F.col("a") != F.col("b")).select("a", "b"))
    nodes = classes.join(counts, F.col("node") == F.col("a"), "left").drop("a")
    nodes = nodes.join(named.withColumnRenamed("node", "own"), F.col("node") == F.col("own"), "left")
    nodes = nodes.select(
        "label", "size", "vector", "least", F.coalesce("component", "node").alias("root"),
        (F.col("held") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
    )
    least = nodes.groupBy("root").agg(F.min("least").alias("component"))
    nodes = stage(nodes.join(least, "root").select("label", "size", "vector", "n_links", "component"), "groups")
    # A vector that many rows share is split by adaptive execution.
    linked = valid.join(nodes, ["label", "size", "vector"]).select("id", "n_links", "component")
    alone = rows.where(F.col("vector").isNull())
    return linked.unionByName(
        alone.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    )


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _lists(table: np.ndarray) -> pa.Array:
    ends = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(table.ravel()))


def _members(values: pa.StructArray, size: int) -> tuple:
    width = min(MAX_BITS, size)
    return (
        values.field("node").to_numpy(),
        values.field("held").to_numpy(),
        _unit(values.field("vector").flatten().to_numpy().reshape(-1, size)),
        values.field("bits").to_numpy().view(np.uint64),
        values.field("squares").flatten().to_numpy().reshape(-1, width).astype(np.float64),
    )


def _compared(x: tuple, y: tuple, part: int, tables: list, budget: int, cosine: float) -> tuple:
    """Rows ``a, b, n`` of one block pair: link counts (a = b) and forest edges (n = 0)."""
    near = (x[2] @ y[2].T >= cosine) & (x[0][:, None] != y[0][None, :])
    i, j = np.nonzero(near)
    if len(i):
        # Whole numbers below 2**53, so these sums are exact.
        flipped = x[3][i] ^ y[3][j]
        first = np.ones(len(i), bool)
        for t, (a, b) in enumerate(tables[: part + 1]):
            apart = ((flipped[:, None] >> np.arange(a, b, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
            by_x = (apart * x[4][i, a:b]).sum(axis=1) <= budget
            by_y = (apart * y[4][j, a:b]).sum(axis=1) <= budget
            first &= ((x[0][i] < y[0][j]) | ~by_y) if t == part else ~(by_x | by_y)
        i, j = i[first], j[first]
    near = np.zeros(near.shape, bool)
    near[i, j] = True
    own_x, own_y = near @ y[1], x[1] @ near
    nodes, roots = forest(x[0], y[0], near) if len(i) else (x[0][:0], x[0][:0])
    return (
        np.concatenate([x[0], y[0], nodes]),
        np.concatenate([x[0], y[0], roots]),
        np.concatenate([own_x, own_y, np.zeros(len(nodes), np.int64)]),
    )
