"""Nearest vectors by inner product with a forest of sorted hash strings.

Strings. Each tree turns a vector by random rotations and notes, for stretches of
``FACETS`` turned coordinates, which one is the largest in size and its sign: one symbol a
stretch, ``SYMBOLS`` symbols a string. Vectors at a small angle agree in a symbol far more
often than others do. So that nearness is the inner product, an indexed vector ``x`` gets
one more coordinate that brings its length to the table's largest, and a query gets 0 there.

Arrays. The strings of a tree are sorted over the cluster and stored in blocks of at most
``BLOCK`` entries, each with the vector in one byte a component. Queries are sorted in
between. The strings that share a prefix with a query lie together, in one block or in a
run of neighbouring blocks, and each block says where its runs begin and end.

Descent and ascent. A query starts with the longest prefixes. All its trees go up together,
a symbol at a time, one tree after another, until the entries under their prefixes add up to
the wanted number of candidates; a tree that reaches its root has every vector. All entries
under the prefixes are compared, block by block as matrix products; the best ``spare`` of
them are measured with the original vectors in double precision.

The wanted number is fitted: for at most ``SAMPLE`` queries the nearest vectors are found by
brute force, and the smallest number that finds ``RECALL`` of them is taken. If no smaller
one does, queries go up to the root, which is exact. Every row is indexed, however few
queries the fit looked at.

Equal vectors are one entry with their ``k + 1`` smallest ids, which is all a result can
show. Blocks with many queries are dealt out in portions, so no task gets more than one
block and one portion. No group of rows, however large, meets in one task.

Defined results: vectors that are NULL, zero or hold NULL or non-finite components take no
part, nor do rows without an id. Vectors of different lengths do not meet. Every row but the
query's own is a candidate, so a repeated row is near its copies; each repeated query row
gets its own result. Ties go to the smaller id. An empty table gives an empty result.
Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.integer_vectors import chunks, finite
from corpusmill.plans.staging import broadcast_if_small, stage

TREES = 26
SYMBOLS = 8
FACETS = 16
BLOCK = 16_384
PORTION = 4096
SAMPLE = 256
RECALL = 0.94
PARTITION_BYTES = 64 << 20


def symbol_bits(size: int) -> int:
    return max(1, (2 * min(FACETS, size + 1) - 1).bit_length())


def rotations(size: int) -> np.ndarray:
    """Columns that give all symbols of all trees: (coordinates, trees, symbols, facets)."""
    full, facets = size + 1, min(FACETS, size + 1)
    each = full // facets
    count = TREES * -(-SYMBOLS // each)
    turned = np.linalg.qr(np.random.default_rng([size, 11]).standard_normal((count, full, full)))[0]
    stretches = turned[:, :, : each * facets].reshape(count, full, each, facets).transpose(1, 0, 2, 3)
    return stretches.reshape(full, TREES, -1, facets)[:, :, :SYMBOLS].astype(np.float32)


def strings(vectors: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Hash strings as whole numbers, a row per vector and a column per tree."""
    full, trees, symbols, facets = axes.shape
    bits = symbol_bits(full - 1)
    found = np.zeros((len(vectors), trees), np.int64)
    vectors = vectors.astype(np.float32)
    for t in range(trees):
        along = (vectors @ axes[:, t].reshape(full, -1)).reshape(len(vectors), symbols, facets)
        largest = np.abs(along).argmax(axis=2)
        positive = np.take_along_axis(along, largest[:, :, None], 2)[:, :, 0] > 0
        for s in range(symbols):
            found[:, t] = found[:, t] << bits | largest[:, s] * 2 + positive[:, s]
    return found


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Indexed vectors with the coordinate that brings them all to one length."""
    small = vectors / longest
    rest = np.sqrt(np.maximum(1.0 - np.einsum("ij,ij->i", small, small), 0.0))
    return np.column_stack([small, rest])


def asking(vectors: np.ndarray) -> np.ndarray:
    """Query vectors of length one, with 0 as the additional coordinate."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return np.column_stack([unit, np.zeros(len(unit))])


def chosen_levels(counts: np.ndarray, wanted: int, first: int = 0) -> np.ndarray:
    """Prefix length per tree, for ``counts`` of entries per tree and prefix length.

    All trees start at the longest prefix and go up together. In the last step trees go one
    after another, beginning with number ``first``, and stop as soon as there are enough.
    """
    trees, lengths = counts.shape
    totals = counts.sum(axis=0)
    enough = np.flatnonzero(totals >= wanted)
    if not len(enough):
        return np.zeros(trees, np.int64)
    level = int(enough[-1])
    if level == lengths - 1:
        return np.full(trees, level)
    turn = np.roll(np.arange(trees), -first)
    growing = totals[level + 1] + np.cumsum(counts[turn, level] - counts[turn, level + 1])
    risen = int(np.searchsorted(growing, wanted)) + 1
    found = np.full(trees, level + 1)
    found[turn[:risen]] = level
    return found


def _bytes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components in one byte, and what one step of them stands for."""
    step = np.abs(vectors).max(axis=1) / 127
    return np.rint(vectors / step[:, None]).astype(np.int8), step


def _dense(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        yield int(size), batch.take(pa.array(np.flatnonzero(sizes == size)))


def distinct_vectors(df: DataFrame, id_col: str, vector_col: str, asks: Column, k: int) -> tuple[DataFrame, DataFrame]:
    """The usable rows ``id, vector, asks``, and one row per distinct vector among them."""
    kind = df.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    element = "float" if single else "double"
    vector = F.transform(vector_col, lambda x: x.cast(element) + F.lit(0).cast(element))
    whole = F.col(id_col).isNotNull() & finite(F.col(vector_col)) & F.exists(vector_col, lambda x: x != 0)
    rows = df.where(F.coalesce(whole, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("id"), vector.alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks")
    )
    rows = stage(rows, "vectors")
    # The row limit is applied before the shuffle too, so a frequent vector costs k + 1 rows a task.
    place = F.row_number().over(Window.partitionBy("vector", "asks").orderBy("id"))
    least = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    classes = least.groupBy("vector").agg(
        F.max("asks").alias("asks"), F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids")
    )
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    classes = classes.select(
        F.monotonically_increasing_id().alias("node"), F.size("vector").alias("size"), norm.alias("norm"), "asks", "ids", "vector"
    )
    return rows, stage(classes, "classes")


def sorted_blocks(classes: DataFrame) -> DataFrame:
    """The forest: ``block, size, tree, keys, nodes, codes, ask_keys, ask_nodes``."""
    spark = classes.sparkSession

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, own in _by_size(batch):
                if size not in axes:
                    axes.clear()
                    axes[size] = rotations(size)
                vectors = _dense(own.column("vector"), size)
                keys = strings(lengthened(vectors, own.column("longest")[0].as_py()), axes[size])
                code, step = _bytes(vectors)
                packed = np.column_stack([step.astype("<f8").view(np.int8).reshape(-1, 8), code])
                ends = np.arange(len(vectors) + 1, dtype=np.int32) * packed.shape[1]
                codes = pa.Array.from_buffers(pa.binary(), len(vectors), [None, pa.py_buffer(ends), pa.py_buffer(packed.tobytes())])
                yield from _entries(size, keys, own.column("node"), codes)
                ask = np.flatnonzero(own.column("asks").to_numpy(zero_copy_only=False))
                if len(ask):
                    keys = strings(asking(vectors[ask]), axes[size])
                    yield from _entries(size, keys, own.column("node").take(pa.array(ask)), pa.nulls(len(ask), pa.binary()))

    sizes = stage(classes.groupBy("size").agg(F.max("norm").alias("longest")), "sizes")
    measured = classes.join(broadcast_if_small(sizes, 10_000), "size").select("node", "size", "longest", "asks", "vector")
    flat = measured.mapInArrow(entries, "size int, tree int, key long, node long, code binary")
    # Sorting a forest of known size: about 64 MB a task.
    total = classes.agg(F.sum(F.col("size").cast("bigint") + 40)).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, total * TREES // PARTITION_BYTES + 1)
    order = ["size", "tree", "key", "node", "code"]
    placed = flat.repartitionByRange(tasks, *order[:4]).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for table in chunks(batches, 4 * BLOCK):
            of = np.column_stack([table.column(c).to_numpy() for c in ("size", "tree")])
            edges = np.concatenate([[0], np.flatnonzero((of[1:] != of[:-1]).any(axis=1)) + 1, [len(of)]])
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                for begin in range(low, high, BLOCK):
                    part = table.slice(begin, min(BLOCK, high - begin))
                    held = part.column("code").is_valid()
                    own, ask = part.filter(held), part.filter(pa.compute.invert(held))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([number]), pa.array([of[begin, 0]], pa.int32()), pa.array([of[begin, 1]], pa.int32()),
                            *[pa.array([own.column(c).to_numpy()], pa.list_(pa.int64())) for c in ("key", "node")],
                            pa.array([b"".join(own.column("code").to_pylist())], pa.binary()),
                            *[pa.array([ask.column(c).to_numpy()], pa.list_(pa.int64())) for c in ("key", "node")],
                        ],
                        ["block", "size", "tree", "keys", "nodes", "codes", "ask_keys", "ask_nodes"],
                    )
                    number += 1

    kind = "block long, size int, tree int, keys array<long>, nodes array<long>, codes binary, ask_keys array<long>, ask_nodes array<long>"
    return stage(placed.mapInArrow(pack, kind), "forest")


def _entries(size: int, keys: np.ndarray, nodes: pa.Array, codes: pa.Array) -> Iterator[pa.RecordBatch]:
    for tree in range(keys.shape[1]):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), size, np.int32)), pa.array(np.full(len(keys), tree, np.int32)), pa.array(keys[:, tree]), nodes, codes],
            ["size", "tree", "key", "node", "code"],
        )


def prefix_runs(blocks: DataFrame) -> DataFrame:
    """Where a prefix's entries are: ``size, tree, level, prefix, block, low, high``.

    Only runs that a query of the block shares, and runs at a block's ends, which may belong
    to a query of another block.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                size, tree, block = (batch.column(c)[k].as_py() for c in ("size", "tree", "block"))
                keys = batch.column("keys")[k].values.to_numpy()
                asked = batch.column("ask_keys")[k].values.to_numpy()
                found = []
                for level in range(SYMBOLS + 1) if len(keys) else ():
                    shift = symbol_bits(size) * (SYMBOLS - level)
                    own = keys >> shift
                    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                    last = np.append(first[1:], len(own))
                    used = np.isin(own[first], asked >> shift)
                    used[0] = used[-1] = True
                    found.append((np.full(used.sum(), level), own[first][used], first[used], last[used]))
                if found:
                    level, prefix, low, high = (np.concatenate(c) for c in zip(*found, strict=True))
                    same = lambda x, kind: pa.array(np.full(len(level), x), kind)
                    yield pa.RecordBatch.from_arrays(
                        [same(size, pa.int32()), same(tree, pa.int32()), pa.array(level, pa.int32()), pa.array(prefix, pa.int64()),
                         same(block, pa.int64()), pa.array(low, pa.int32()), pa.array(high, pa.int32())],
                        ["size", "tree", "level", "prefix", "block", "low", "high"],
                    )

    narrow = blocks.select("block", "size", "tree", "keys", "ask_keys")
    return stage(narrow.mapInArrow(runs, "size int, tree int, level int, prefix long, block long, low int, high int"), "runs")


def prefix_counts(blocks: DataFrame, runs: DataFrame) -> DataFrame:
    """Per query ``node, size, keys, counts``: entries under each of its prefixes, by tree and length."""
    place = ["size", "tree", "level", "prefix"]
    totals = runs.groupBy(*place).agg(F.sum((F.col("high") - F.col("low")).cast("bigint")).alias("n"))
    asks = blocks.select("size", "tree", F.inline(F.arrays_zip(F.col("ask_keys").alias("key"), F.col("ask_nodes").alias("node"))))
    # The number of bits of a symbol follows from the length of the vectors.
    facets = F.least(F.lit(FACETS), F.col("size") + 1)
    bits = F.greatest(F.lit(1), F.ceil(F.log2(2 * facets)).cast("int"))
    level = F.explode(F.sequence(F.lit(0), F.lit(SYMBOLS))).alias("level")
    every = asks.select("node", "size", "tree", "key", bits.alias("bits"), level)
    prefix = F.call_function("shiftright", F.col("key"), F.col("bits") * (SYMBOLS - F.col("level")))
    every = every.select("node", "size", "tree", "level", prefix.alias("prefix"))
    counted = every.join(totals, place, "left").groupBy("node", "size").agg(
        F.sort_array(F.collect_list(F.struct("tree", "level", F.coalesce("n", F.lit(0)).alias("n"), "prefix"))).alias("grid")
    )
    counted = counted.select(
        "node", "size",
        F.transform(F.filter("grid", lambda g: g["level"] == SYMBOLS), lambda g: g["prefix"]).alias("keys"),
        F.col("grid.n").alias("counts"),
    )
    return stage(counted, "prefix_counts")


def fitted_wanted(classes: DataFrame, counted: DataFrame, k: int) -> int:
    """The number of candidates that finds ``RECALL`` of the nearest of a sample of queries."""
    spark = classes.sparkSession
    drawn = classes.where("asks").orderBy(F.xxhash64("node"), "node").select("node", "size", "vector").limit(SAMPLE).collect()
    least, most = TREES * (k + 1), max(TREES * classes.count(), 1)
    if not drawn:
        return least
    by_size: dict[int, tuple[list, np.ndarray]] = {}
    for size in {r["size"] for r in drawn}:
        own = [r for r in drawn if r["size"] == size]
        by_size[size] = [r["node"] for r in own], np.array([r["vector"] for r in own], np.float64)
    held = spark.sparkContext.broadcast(by_size)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, own in _by_size(batch):
                if size not in held.value:
                    continue
                nodes, asked = held.value[size]
                others = own.column("node").to_numpy()
                score = asked @ _dense(own.column("vector"), size).T
                score[np.array(nodes)[:, None] == others] = -np.inf
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                which = np.repeat(np.arange(len(nodes)), top.shape[1])
                at = top.ravel()
                keep = np.isfinite(score[which, at])
                which, at = which[keep], at[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(nodes)[which]), own.column("size").take(pa.array(at)), pa.array(score[which, at]), pa.array(others[at]),
                     own.column("longest").take(pa.array(at)), own.column("vector").take(pa.array(at))],
                    ["node", "size", "score", "other", "longest", "vector"],
                )

    kind = dict(classes.dtypes)["vector"]
    longest = classes.groupBy("size").agg(F.max("norm").alias("longest"))
    whole = classes.join(longest, "size").select("node", "size", "longest", "vector")
    found = whole.mapInArrow(best, f"node long, size int, score double, other long, longest double, vector {kind}")
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.col("score").desc(), "other"))
    # At most SAMPLE queries with k vectors each.
    near = found.withColumn("rank", rank).where(F.col("rank") <= k).collect()
    counts = counted.where(F.col("node").isin([r["node"] for r in drawn])).collect()
    if not near:
        return most
    grids = {r["node"]: (np.array(r["keys"], np.int64), np.array(r["counts"]).reshape(TREES, -1)) for r in counts}
    depth, axes = [], {size: rotations(size) for size in by_size}
    for r in near:
        size, keys = r["size"], grids[r["node"]][0]
        own = strings(lengthened(np.array([r["vector"]], np.float64), r["longest"]), axes[size])[0]
        bits = symbol_bits(size)
        shared = np.array([(own >> bits * (SYMBOLS - s)) == (keys >> bits * (SYMBOLS - s)) for s in range(1, SYMBOLS + 1)])
        depth.append(shared.sum(axis=0))
    wanted = least
    while wanted < most:
        levels = {node: chosen_levels(grid, wanted, node % TREES) for node, (_, grid) in grids.items()}
        if np.mean([(d >= levels[r["node"]]).any() for r, d in zip(near, depth, strict=True)]) >= RECALL:
            return wanted
        wanted = wanted * 5 // 4
    return most


def nearest(df: DataFrame, id_col: str, vector_col: str, asks: Column, k: int = 20, wanted: int | None = None) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` rows nearest to every row for which ``asks`` holds.

    ``wanted`` is the number of candidates to go up for; without it, it is fitted.
    """
    rows, classes = distinct_vectors(df, id_col, vector_col, asks, k)
    blocks = sorted_blocks(classes)
    runs = prefix_runs(blocks)
    counted = prefix_counts(blocks, runs)
    goal = fitted_wanted(classes, counted, k) if wanted is None else max(wanted, TREES * (k + 1))
    spare = k + 12

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                node, size = batch.column("node")[n].as_py(), batch.column("size")[n].as_py()
                keys = batch.column("keys")[n].values.to_numpy()
                counts = batch.column("counts")[n].values.to_numpy().reshape(len(keys), -1)
                level = chosen_levels(counts, goal, node % TREES)
                # A tree at its root has everything, so the other trees have nothing to add.
                use = np.flatnonzero(level == 0)[:1] if (level == 0).any() else np.arange(len(keys))
                shift = symbol_bits(size) * (SYMBOLS - level[use])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(use), node)), pa.array(np.full(len(use), size, np.int32)), pa.array(use, pa.int32()),
                     pa.array(level[use], pa.int32()), pa.array(keys[use] >> shift)],
                    ["node", "size", "tree", "level", "prefix"],
                )

    picked = counted.mapInArrow(choose, "node long, size int, tree int, level int, prefix long")
    requests = picked.join(runs, ["size", "tree", "level", "prefix"]).select("node", "block", "low", "high")
    requests = stage(requests, "requests")
    portions = requests.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PORTION).cast("int").alias("portions"))
    portions = stage(portions, "portions")
    dealt = requests.join(portions, "block").withColumn("portion", F.pmod(F.xxhash64("node"), F.col("portions")).cast("int"))
    asked = classes.where("asks").select("node", F.col("vector").alias("asked"))
    dealt = dealt.join(asked, "node").select("block", "portion", "node", "low", "high", "asked")
    shared = blocks.join(portions, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"), "size", "nodes", "codes"
    )

    def compare(key: tuple, queries: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and held.num_rows:
            size = held.column("size")[0].as_py()
            nodes = held.column("nodes").combine_chunks().flatten().to_numpy()
            packed = np.frombuffer(held.column("codes")[0].as_py(), np.int8).reshape(len(nodes), -1)
            step = np.ascontiguousarray(packed[:, :8]).view("<f8").ravel()
            codes = packed[:, 8:].astype(np.float32)
            columns = np.arange(len(nodes))
            for begin in range(0, queries.num_rows, 256):
                part = queries.slice(begin, 512)
                code, own_step = _bytes(_dense(part.column("asked").combine_chunks(), size))
                low, high = (part.column(c).to_numpy()[:, None] for c in ("low", "high"))
                score = (code.astype(np.float32) @ codes.T) * step * own_step[:, None]
                score[(columns < low) | (columns >= high)] = -np.inf
                top = np.argpartition(-score, spare, axis=1)[:, :spare] if len(nodes) > spare else np.broadcast_to(columns, score.shape)
                near = np.take_along_axis(score, top, 1)
                which, at = np.nonzero(near > -np.inf)
                out.append((part.column("node").to_numpy()[which], nodes[top[which, at]], near[which, at]))
        node, other, near = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        return pa.table({"node": node, "other": other, "near": near})

    found = dealt.groupBy("block", "portion").cogroup(shared.groupBy("block", "portion")).applyInArrow(compare, "node long, other long, near double")
    # Dealt by query once; the counts, ranks and lists below need no other shuffle.
    found = found.repartition("node").groupBy("node", "other").agg(F.max("near").alias("near"))
    order = Window.partitionBy("node").orderBy(F.col("near").desc(), "other")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= spare).select("node", "other")
    best = stage(best, "candidates")
    named = classes.select(F.col("node").alias("other"), F.col("vector").alias("near_vector"), "ids")
    product = F.aggregate(
        F.zip_with("asked", "near_vector", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x
    )
    measured = best.join(asked, "node").join(named, "other").select("node", "other", "ids", product.alias("score"))
    # At most spare * (k + 1) entries a query; the smallest struct is the best one.
    entry = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("order"), i.alias("id"), F.col("other").alias("node"), F.col("score").alias("score")))
    lists = measured.groupBy("node").agg(F.slice(F.array_sort(F.flatten(F.collect_list(entry))), 1, k + 1).alias("near"))
    queries = rows.where("asks").join(classes.where("asks").select("vector", "node"), "vector").select("id", "node")
    at = F.expr("coalesce(array_position(transform(near, x -> x.id = id AND x.node = node), true), 0)")
    others = F.expr(f"CASE WHEN own > 0 THEN concat(slice(near, 1, own - 1), slice(near, own + 1, {k + 1})) ELSE near END")
    result = queries.join(lists, "node").withColumn("own", at.cast("int")).select("id", F.slice(others, 1, k).alias("near"))
    result = result.select(F.col("id").alias("query_id"), F.posexplode("near").alias("rank", "entry"))
    return result.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("entry.id").alias("id"), F.col("entry.score").alias("score"))
