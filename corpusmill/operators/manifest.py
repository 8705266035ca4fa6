"""Run manifests: a run, its source and its shards as one nested row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.schemas import COMPLETED

_SHARD_FIELDS = (
    "shard_sequence",
    "bucket",
    "object_key",
    "stored_size_bytes",
    "checksum_algorithm",
    "checksum",
    "etag",
)


def run_manifest(runs: DataFrame, sources: DataFrame, shards: DataFrame) -> DataFrame:
    """One nested row per run.

    ``runs`` has ``run_id, source_id, version_id, status, started_at, completed_at``;
    ``sources`` the provenance columns. A run's shards are one row each of a few hundred
    bytes, so a manifest of a million shards is still one ordinary row.
    """
    listed = (
        shards.where(F.col("status") == COMPLETED)
        .groupBy("run_id")
        .agg(
            F.sort_array(F.collect_list(F.struct(*_SHARD_FIELDS))).alias("shards"),
            F.count("*").alias("total_shards"),
            F.sum("downloaded_size_bytes").alias("total_downloaded_bytes"),
            F.sum("stored_size_bytes").alias("total_stored_bytes"),
        )
    )
    provenance = sources.select(
        "source_id",
        F.struct(
            "source_type",
            "source_uri",
            "license_name",
            "license_url",
            F.col("source_notes").alias("notes"),
            "dataset_id",
            "dataset_config",
        ).alias("source"),
    )
    none = F.expr("array()").cast(listed.schema["shards"].dataType)

    def or_zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint").alias(name)

    return (
        runs.join(provenance, "source_id")
        .join(listed, "run_id", "left")
        .select(
            "run_id",
            "source_id",
            "source",
            "version_id",
            "status",
            F.col("started_at").cast("string").alias("started_at"),
            F.col("completed_at").cast("string").alias("completed_at"),
            or_zero("total_shards"),
            or_zero("total_downloaded_bytes"),
            or_zero("total_stored_bytes"),
            F.lit("SHA-256").alias("checksum_algorithm"),
            F.coalesce("shards", none).alias("shards"),
        )
    )


def manifest_json(manifest: DataFrame) -> DataFrame:
    """Each manifest as JSON text with all fields, empty ones as null."""
    fields = [F.col(c) for c in sorted(manifest.columns)]
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return manifest.select("run_id", "source_id", "version_id", text.alias("manifest"))
