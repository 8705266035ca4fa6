"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import (
    bin_completion,
    context_mixing,
    fm_index,
    itq,
    pii,
    simhash,
    splitters,
    token_files,
    toxicity,
    vector_queries,
    warc,
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``p_low_quality, p_toxic, is_toxic``, by models fitted on the labels."""
    categories = toxicity.categories()
    models = toxicity.train(docs, labels, categories, "doc_id", "text")
    scored = toxicity.score(docs, models, list(categories), "text")
    return scored.withColumn("is_toxic", F.col("p_toxic") >= 0.5)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(spark, docs, read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "p_low_quality", "p_toxic", "is_toxic")


def op2_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = itq.near_vectors(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(read(spark, sf_dir, "documents"), "doc_id", "text")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in pii.PATTERNS],
        F.sha2(pii.span_text("base"), 256).alias("base_sha256"),
        F.concat_ws(",", *[F.when(F.size(c) > 0, pii.span_text(c)) for c in ("base", "more")]).alias("spans"),
    )


def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = fm_index.benchmark_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        fm_index.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive_folder(spark)
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    return warc.read_index(spark, path)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = splitters.shard_by_bytes(read(spark, sf_dir, "documents"), 40, "doc_id", "text")
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The public vocabulary file, which every machine of the cluster has."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = token_files.token_folder(spark)
    docs = read(spark, sf_dir, "documents")
    parts = token_files.write_token_files(docs, root, vocabulary(), 2, "doc_id", "text", added_tokens=True)
    return token_files.read_token_files(spark, parts, root).withColumnRenamed("id", "doc_id")


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = context_mixing.score(read(spark, sf_dir, "documents"), "doc_id", "text")
    return scored.withColumnRenamed("id", "doc_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(read(spark, sf_dir, "documents"), "doc_id", "text")
    return groups.select(
        F.col("id").alias("doc_id"),
        simhash.hex_digits(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def packed(docs: DataFrame, cached_pieces: int | None = None) -> DataFrame:
    """Places of all token pieces of ``docs`` in sequences of 2,048 tokens."""
    pieces = bin_completion.token_pieces(
        docs, vocabulary(), 0, 2048, "doc_id", "text", added_tokens=True, cached_pieces=cached_pieces
    )
    return bin_completion.pack(pieces, 2048).withColumnRenamed("id", "doc_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_itq": op2_itq,
    "op3_pii": op3_pii,
    "op4_fm_index": op4_fm_index,
    "op5_warc": op5_warc,
    "op6_sharding": op6_sharding,
    "op7_token_files": op7_token_files,
    "op8_context_mixing": op8_context_mixing,
    "op9_simhash": op9_simhash,
    "op10_packing": op10_packing,
    **vector_queries.QUERIES,
}

ORACLES: dict[str, str] = {
    "op5_warc": """
WITH pages_read AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), hashed AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
        max(page_id) OVER (PARTITION BY payload) AS first_id
    FROM pages_read
)
SELECT page_id, payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, (i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1,
        1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM hashed
""",
    **vector_queries.ORACLES,
}
