"""Table layouts and fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Lifecycle states and the allowed changes between them.
PENDING = "PENDING"
RUNNING = "RUNNING"
PAUSE_REQUESTED = "PAUSE_REQUESTED"
PAUSED = "PAUSED"
COMPLETED = "COMPLETED"
FAILED = "FAILED"
RETRYING = "RETRYING"
CANCELLED = "CANCELLED"

STATES = (PENDING, RUNNING, PAUSE_REQUESTED, PAUSED, COMPLETED, FAILED, RETRYING, CANCELLED)

TRANSITIONS = (
    (PENDING, RUNNING),
    (PENDING, FAILED),
    (PENDING, CANCELLED),
    (RUNNING, PAUSE_REQUESTED),
    (RUNNING, COMPLETED),
    (RUNNING, FAILED),
    (RUNNING, RETRYING),
    (RUNNING, CANCELLED),
    (PAUSE_REQUESTED, PAUSED),
    (PAUSE_REQUESTED, FAILED),
    (PAUSED, RUNNING),
    (PAUSED, COMPLETED),
    (PAUSED, FAILED),
    (PAUSED, CANCELLED),
    (RETRYING, RUNNING),
    (RETRYING, PAUSED),
    (RETRYING, COMPLETED),
    (RETRYING, FAILED),
    (RETRYING, CANCELLED),
    (FAILED, RETRYING),
    (FAILED, COMPLETED),
    (FAILED, CANCELLED),
)

# Source types that can be read, and defaults.
SOURCE_TYPES = ("huggingface_dataset", "http_lines", "filesystem", "dolma_manifest")
DEFAULT_BUDGET_BYTES = 10_000_000_000
DEFAULT_TARGET_BYTES = 256 * 1024 * 1024
DEFAULT_MAXIMUM_BYTES = 500 * 1024 * 1024
DEFAULT_MIN_CHARS = 20
DEFAULT_SPECIAL_TOKENS = ("<pad>", "<unk>", "<bos>", "<eos>")
CHECKSUM_ALGORITHM = "sha256"

REGISTRY = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("license_name", T.StringType()),
        T.StructField("license_url", T.StringType()),
        T.StructField("max_bytes", T.LongType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("dataset_config", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("notes", T.StringType()),
    ]
)

REGISTRATIONS = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("source_uri", T.StringType()),
        T.StructField("license_name", T.StringType()),
        T.StructField("license_url", T.StringType()),
        T.StructField("source_notes", T.StringType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("dataset_config", T.StringType()),
        T.StructField("configured_quota_bytes", T.LongType()),
        T.StructField("checkpoint_type", T.StringType()),
        T.StructField("registered_at", T.TimestampType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("version_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
    ]
)

SHARDS = T.StructType(
    [
        T.StructField("shard_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("version_id", T.StringType()),
        T.StructField("shard_sequence", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("object_key", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("stored_size_bytes", T.LongType()),
        T.StructField("downloaded_size_bytes", T.LongType()),
        T.StructField("checksum_algorithm", T.StringType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("checkpoint", T.StringType()),
        T.StructField("verified_at", T.TimestampType()),
    ]
)

STATUS_EVENTS = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

EVENT_LOG = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_level", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("event_data", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


def allowed_transitions(spark: SparkSession) -> DataFrame:
    """The 22 allowed status changes as a table."""
    return spark.createDataFrame(list(TRANSITIONS), "from_status string, to_status string")
