"""Recovery at start-up: interrupted runs, missing objects, unfinished files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.lifecycle import transition_allowed
from corpusmill.schemas import COMPLETED, FAILED, PAUSE_REQUESTED, PAUSED, RETRYING, RUNNING

ACTIVE = (RUNNING, RETRYING, PAUSE_REQUESTED)
# Texts and event names that recovery leaves in the tables.
PAUSED_EVENT = "startup_run_paused"
PAUSED_MESSAGE = "interrupted run made resumable"
FAILED_EVENT = "startup_shard_verification_failed"
PAUSED_ERROR = "startup reconciliation paused interrupted run"
SIZE_ERROR = "stored shard size does not match metadata"
MISSING_ERROR = "stored shard is missing"
# Fixed value: suffixes of unfinished files.
_SUFFIX = r"[^/]\.(partial|ready|uploading)$"


def reconcile_interrupted(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Status rows and event rows that make interrupted sources resumable.

    ``sources`` has ``source_id, status, current_run_id``. A running source asks for a
    pause before it is paused, as a live one would.
    """
    active = sources.where(F.col("status").isin(*ACTIVE))
    steps = F.when(F.col("status") == RUNNING, F.array(F.lit(PAUSE_REQUESTED), F.lit(PAUSED)))
    steps = steps.otherwise(F.array(F.lit(PAUSED)))
    each = active.select("source_id", "current_run_id", F.posexplode(steps).alias("step", "to"))
    of_source = each.select(
        F.lit("source").alias("entity"),
        F.col("source_id").alias("id"),
        "step",
        F.col("to").alias("status"),
        F.when(F.col("to") == PAUSED, PAUSED_ERROR).alias("error"),
    )
    of_run = each.where(F.col("current_run_id").isNotNull()).select(
        F.lit("run").alias("entity"),
        F.col("current_run_id").alias("id"),
        "step",
        F.col("to").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )
    events = active.select(
        F.col("current_run_id").alias("run_id"),
        "source_id",
        F.lit(None).cast("string").alias("shard_id"),
        F.lit(PAUSED_EVENT).alias("event_type"),
        F.lit("WARNING").alias("event_level"),
        F.lit(PAUSED_MESSAGE).alias("message"),
        F.lit(None).cast("string").alias("event_data"),
    )
    return of_source.unionByName(of_run), events


def bad_shards(
    shards: DataFrame, listing: DataFrame, current_runs: DataFrame | None = None
) -> DataFrame:
    """Committed shards whose object is missing or has another size.

    ``listing`` has ``bucket, object_key, length``; with ``current_runs`` only the
    shards of each source's current run are compared.
    """
    done = shards.where(F.col("status") == COMPLETED)
    if current_runs is not None:
        wanted = current_runs.select(F.col("current_run_id").alias("run_id"))
        done = done.join(wanted, "run_id", "left_semi")
    joined = done.join(listing, ["bucket", "object_key"], "left")
    missing = F.col("length").isNull()
    wrong = missing | (F.col("length") != F.col("stored_size_bytes"))
    message = F.when(missing, MISSING_ERROR).otherwise(SIZE_ERROR)
    return joined.where(wrong).select(
        "source_id",
        "run_id",
        "shard_id",
        "shard_sequence",
        "object_key",
        "stored_size_bytes",
        "length",
        message.alias("message"),
    )


def shard_failures(bad: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Status rows, event rows and violations that follow from bad shards.

    A source whose status may not change to failed (it is completed) is reported as a
    violation; the others are handled all the same.
    """
    failed = bad.groupBy("source_id", "run_id").agg(
        F.max_by("message", "shard_sequence").alias("error")
    )
    judged = failed.join(sources.select("source_id", "status"), "source_id")
    allowed = transition_allowed(F.col("status"), F.lit(FAILED))
    may, may_not = judged.where(allowed), judged.where(~allowed)

    def rows(entity: str, key: Column) -> DataFrame:
        return may.select(
            F.lit(entity).alias("entity"),
            key.alias("id"),
            F.lit(0).alias("step"),
            F.lit(FAILED).alias("status"),
            "error",
        )

    statuses = rows("source", F.col("source_id")).unionByName(rows("run", F.col("run_id")))
    events = bad.select(
        "run_id",
        "source_id",
        "shard_id",
        F.lit(FAILED_EVENT).alias("event_type"),
        F.lit("ERROR").alias("event_level"),
        "message",
        F.to_json(F.struct("object_key")).alias("event_data"),
    )
    violations = may_not.select(
        "source_id",
        F.col("status").alias("from_status"),
        F.lit(FAILED).alias("to_status"),
        "error",
    )
    return statuses, events, violations


def listing_audit(shards: DataFrame, listing: DataFrame) -> DataFrame:
    """Both sides compared: missing, wrong size, or stored without being committed."""
    done = shards.where(F.col("status") == COMPLETED)
    joined = done.select("bucket", "object_key", "stored_size_bytes").join(
        listing, ["bucket", "object_key"], "full_outer"
    )
    finding = (
        F.when(F.col("length").isNull(), "missing")
        .when(F.col("stored_size_bytes").isNull(), "orphan")
        .when(F.col("length") != F.col("stored_size_bytes"), "size_mismatch")
    )
    return joined.withColumn("finding", finding).where(F.col("finding").isNotNull())


def incomplete_files(files: DataFrame, batch: str, path: str = "path") -> DataFrame:
    """Unfinished staging files and where each would be put aside.

    Paths are relative to the staging folder. ``batch`` names this quarantine; files it
    already holds are left out.
    """
    aside = f"quarantine/{batch}/"
    suffix = F.regexp_extract(F.col(path), _SUFFIX, 1)
    found = files.where((suffix != "") & ~F.col(path).startswith(aside))
    return found.select(
        F.col(path).alias("path"),
        suffix.alias("kind"),
        F.concat(F.lit(aside), F.col(path)).alias("destination"),
    )
