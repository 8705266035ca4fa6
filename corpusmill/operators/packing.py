"""Fixed-length blocks cut from a continuous stream of token ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.numbers import whole_div
from corpusmill.operators.prefix import BLOCK_BITS, running_totals
from corpusmill.operators.tokens import checked_ids

# Fixed value: bytes of one stored token id.
TOKEN_BYTES = 4
DTYPE = "<u4"


def pack_blocks(
    token_docs: DataFrame,
    sequence_length: int,
    vocab_size: int,
    doc_id: str = "doc_id",
    ids: str = "ids",
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Blocks of ``sequence_length + 1`` ids, each sharing one id with the next.

    Documents follow each other in ``doc_id`` order without a separator; an incomplete
    last block is dropped. Documents are cut to pieces of blocks where they are. Pieces
    that fill a block are done; only those at document borders are brought together.
    """
    if sequence_length <= 0 or vocab_size <= 0:
        raise ValueError("blocks need a length and a vocabulary above 0")
    n = sequence_length
    docs = token_docs.select(
        F.col(doc_id).cast("bigint").alias("doc"),
        checked_ids(F.col(ids), vocab_size).alias("ids"),
        F.size(ids).cast("bigint").alias("length"),
    )
    placed = running_totals(docs, [], "doc", {"stop": F.col("length")}, bits=bits)
    placed = placed.where(F.col("length") > 0).withColumn("start", F.col("stop") - F.col("length"))

    def piece(block: Column) -> Column:
        first = F.greatest(F.col("start"), block * n)
        last = F.least(F.col("stop") - 1, block * n + n)
        body = F.slice("ids", (first - F.col("start") + 1).cast("int"), (last - first + 1).cast("int"))
        return F.struct(block.alias("block_id"), first.alias("first"), body.alias("ids"))

    blocks = F.sequence(
        F.greatest(whole_div(F.col("start") - 1, n), F.lit(0).cast("bigint")),
        whole_div(F.col("stop") - 1, n),
    )
    pieces = placed.select(F.inline(F.transform(blocks, piece)))
    whole = pieces.where(F.size("ids") == n + 1).select("block_id", "ids")
    joined = (
        pieces.where(F.size("ids") <= n)
        .groupBy("block_id")
        .agg(F.sort_array(F.collect_list(F.struct("first", "ids"))).alias("parts"))
        .select("block_id", F.flatten(F.col("parts.ids")).alias("ids"))
        .where(F.size("ids") == n + 1)
    )
    return whole.unionByName(joined)


def require_blocks(blocks: DataFrame) -> DataFrame:
    """The same blocks, or an error when the stream was too short for one."""
    if blocks.isEmpty():
        raise ValueError("the ids of all documents do not fill one block")
    return blocks


def pack_metadata(blocks: DataFrame, sequence_length: int, vocab_size: int) -> DataFrame:
    """One row that describes a set of blocks."""
    count = F.count("*")
    return blocks.agg(count.alias("num_blocks")).select(
        F.lit(sequence_length).alias("sequence_length"),
        F.lit(vocab_size).alias("vocab_size"),
        "num_blocks",
        (F.col("num_blocks") * sequence_length).alias("num_tokens"),
        F.lit(DTYPE).alias("dtype"),
    )


def pack_check(metadata: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row per rule a stored set of blocks breaks: ``problem``."""
    stored = blocks.agg(F.coalesce(F.sum(F.size("ids").cast("bigint")), F.lit(0))).scalar()
    positive = (F.col("sequence_length") > 0) & (F.col("vocab_size") > 0) & (F.col("num_blocks") > 0)
    tokens = F.col("num_tokens") == F.col("num_blocks") * F.col("sequence_length")
    expected = F.col("num_blocks") * (F.col("sequence_length") + 1) * TOKEN_BYTES
    rules = F.array(
        F.when(~F.coalesce(positive, F.lit(False)), "invalid pack metadata values"),
        F.when(~F.coalesce(tokens, F.lit(False)), "invalid token count in pack metadata"),
        F.when(
            ~F.coalesce(expected == stored * TOKEN_BYTES, F.lit(False)),
            "packed data does not match metadata",
        ),
    )
    return metadata.select(F.explode(F.array_compact(rules)).alias("problem"))


def shifted_examples(blocks: DataFrame, sequence_length: int) -> DataFrame:
    """Inputs are the first ids of a block, targets the same one step later."""
    return blocks.select(
        "block_id",
        F.slice("ids", 1, sequence_length).alias("inputs"),
        F.slice("ids", 2, sequence_length).alias("targets"),
    )


def sequential_batches(examples: DataFrame, batch_size: int = 2) -> DataFrame:
    """Neighbouring examples together; the last batch may be short."""
    columns = [c for c in examples.columns if c != "block_id"]
    in_order = F.sort_array(F.collect_list(F.struct("block_id", *columns)))
    grouped = examples.groupBy(
        whole_div(F.col("block_id"), batch_size).alias("batch_id")
    ).agg(in_order.alias("rows"))
    return grouped.select(
        "batch_id",
        F.size("rows").alias("examples"),
        *[F.col(f"rows.{c}").alias(c) for c in columns],
    )


def packed_bytes(ids: Column) -> Column:
    """Ids as little-endian 32-bit integers, the stored form of a block."""

    @F.arrow_udf("binary")
    def to_bytes(blocks: pa.Array) -> pa.Array:
        flat = blocks.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.concatenate([[0], np.cumsum(np.asarray(blocks.value_lengths()))]) * TOKEN_BYTES
        return pa.Array.from_buffers(
            pa.binary(),
            len(blocks),
            [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())],
        )

    return to_bytes(ids)
