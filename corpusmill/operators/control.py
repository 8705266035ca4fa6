"""Control tables: registered sources, runs, committed shards, and views of them.

Tables only grow. What a source or run looks like now is a view of the rows appended
so far, so a shard, its cursor and all totals appear together with one append.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.keys import canonical_cursor
from corpusmill.schemas import COMPLETED, FAILED, PAUSED, PENDING

# Fixed value: what a new registration overwrites on a known source.
DESCRIPTIVE = (
    "source_name",
    "source_type",
    "source_uri",
    "license_name",
    "license_url",
    "source_notes",
    "dataset_id",
    "dataset_config",
    "configured_quota_bytes",
    "checkpoint_type",
)


def register_sources(existing: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Sources after a registration: new ones start, known ones get a new description.

    Status, totals, cursor and creation time of known sources stay as they are.
    """
    old, new = existing.alias("old"), incoming.alias("new")
    given = F.col("new.source_id").isNotNull()
    known = F.col("old.source_id").isNotNull()

    def start(name: str, value) -> Column:
        return F.when(known, F.col(f"old.{name}")).otherwise(value).alias(name)

    joined = old.join(new, F.col("old.source_id") == F.col("new.source_id"), "full_outer")
    return joined.select(
        F.coalesce("old.source_id", "new.source_id").alias("source_id"),
        *[
            F.when(given, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            for c in DESCRIPTIVE
        ],
        start("status", F.lit(PENDING)),
        start("downloaded_bytes", F.lit(0)),
        start("verified_bytes", F.lit(0)),
        start("completed_shard_count", F.lit(0)),
        start("checkpoint", F.lit(None)),
        start("created_at", now),
        F.when(given, now).otherwise(F.col("old.updated_at")).alias("updated_at"),
    )


def repeated_names(sources: DataFrame) -> DataFrame:
    """Source names used by more than one source."""
    counted = sources.groupBy("source_name").agg(F.count("*").alias("n"))
    return counted.where("n > 1")


def latest_registrations(registrations: DataFrame) -> DataFrame:
    """The description of each source as last registered, and when it was first."""
    rest = [c for c in registrations.columns if c not in ("source_id", "registered_at")]
    return (
        registrations.groupBy("source_id")
        .agg(
            F.max_by(F.struct(*rest), "registered_at").alias("d"),
            F.min("registered_at").alias("created_at"),
        )
        .select("source_id", "d.*", "created_at")
    )


def open_runs(sources: DataFrame, runs: DataFrame, new_ids: DataFrame) -> DataFrame:
    """Rows to append to ``runs``: one for each source that has no run yet.

    ``new_ids`` holds ``source_id, run_id, version_id, started_at`` to use.
    """
    without = sources.select("source_id").join(runs, "source_id", "left_anti")
    return without.join(new_ids, "source_id").select(
        "run_id", "source_id", "version_id", "started_at"
    )


def current_runs(runs: DataFrame) -> DataFrame:
    """The current run and version of each source: the one started last."""
    latest = F.max_by(F.struct("run_id", "version_id"), F.struct("started_at", "run_id"))
    return (
        runs.groupBy("source_id")
        .agg(latest.alias("r"))
        .select(
            "source_id",
            F.col("r.run_id").alias("current_run_id"),
            F.col("r.version_id").alias("current_version_id"),
        )
    )


def new_shards(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Shards to append: those whose id is not stored. Running it again appends nothing."""
    return incoming.dropDuplicates(["shard_id"]).join(
        existing.select("shard_id"), "shard_id", "left_anti"
    )


def commit_conflicts(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming shards whose id is stored with another status than completed."""
    stored = existing.select("shard_id", F.col("status").alias("stored_status"))
    return incoming.join(stored, "shard_id").where(F.col("stored_status") != COMPLETED)


def require_no_conflicts(existing: DataFrame, incoming: DataFrame) -> None:
    found = commit_conflicts(existing, incoming).select("stored_status").take(1)
    if found:
        raise ValueError(f"shard already exists with status {found[0]['stored_status']}")


def shard_totals(shards: DataFrame, key: str) -> DataFrame:
    """Bytes and completed shards per source or run."""
    done = shards.where(F.col("status") == COMPLETED)
    return done.groupBy(key).agg(
        F.sum("stored_size_bytes").alias("verified_bytes"),
        F.sum("downloaded_size_bytes").alias("downloaded_bytes"),
        F.count("*").alias("completed_shard_count"),
    )


def source_totals(registry: DataFrame, shards: DataFrame) -> DataFrame:
    """Totals of every source; zero for those without a shard."""
    return _with_totals(registry.select("source_id"), shards, "source_id")


def run_totals(runs: DataFrame, shards: DataFrame) -> DataFrame:
    """Totals of every run; zero for those without a shard."""
    return _with_totals(runs.select("run_id", "source_id"), shards, "run_id")


def _with_totals(left: DataFrame, shards: DataFrame, key: str) -> DataFrame:
    totals = shard_totals(shards, key)
    names = ("verified_bytes", "downloaded_bytes", "completed_shard_count")
    return left.join(totals, key, "left").select(
        *left.columns, *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names]
    )


def resume_cursor(registry: DataFrame, shards: DataFrame) -> DataFrame:
    """Where each source goes on: the cursor of its last shard that has one."""
    last = (
        shards.where(F.col("checkpoint").isNotNull())
        .groupBy("source_id")
        .agg(F.max_by("checkpoint", "shard_sequence").alias("checkpoint"))
    )
    return registry.select("source_id").join(last, "source_id", "left").select(
        "source_id", canonical_cursor(F.col("checkpoint")).alias("checkpoint")
    )


def quota_reached(registry: DataFrame, shards: DataFrame, quota: str = "max_bytes") -> DataFrame:
    """Whether the verified bytes of each source fill its quota; no quota is never full."""
    full = F.col(quota).isNotNull() & (F.col("verified_bytes") >= F.col(quota))
    totals = source_totals(registry, shards)
    return registry.select("source_id", quota).join(totals, "source_id").select(
        "source_id", quota, "verified_bytes", full.alias("reached")
    )


def lookup(table: DataFrame, key: str, value: str) -> DataFrame:
    """The row with a key; a missing key is an error."""
    found = table.where(F.col(key) == value)
    if found.isEmpty():
        raise KeyError(value)
    return found


def lookup_many(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose keys are listed."""
    return table.join(wanted.select(key), key, "left_semi")


def run_shards(shards: DataFrame, run_id: str) -> DataFrame:
    """Completed shards of a run in order."""
    mine = (F.col("run_id") == run_id) & (F.col("status") == COMPLETED)
    return shards.where(mine).select(
        "shard_sequence",
        "bucket",
        "object_key",
        "stored_size_bytes",
        "checksum_algorithm",
        "checksum",
        "etag",
    ).orderBy("shard_sequence")


def source_listing(sources: DataFrame) -> DataFrame:
    """All sources by id."""
    return sources.orderBy("source_id")


def log_events(events: DataFrame, now: Column) -> DataFrame:
    """Rows to append to the event log: each gets an id and a time."""
    return events.withColumns({"event_id": F.uuid(), "created_at": now}).select(
        "event_id",
        "run_id",
        "source_id",
        "shard_id",
        "event_type",
        "event_level",
        "message",
        "event_data",
        "created_at",
    )


def event_counts(events: DataFrame) -> DataFrame:
    """How many events of each type and level were logged, and when first and last."""
    return events.groupBy("event_type", "event_level").agg(
        F.count("*").alias("n"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )


def progress_report(shards: DataFrame, registry: DataFrame, elapsed: str | None = None) -> DataFrame:
    """Progress after each shard: bytes so far, share of the quota, upload speed."""
    so_far = Window.partitionBy("source_id").orderBy("shard_sequence").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    done = shards.where(F.col("status") == COMPLETED)
    columns = {"verified_bytes": F.sum("stored_size_bytes").over(so_far)}
    if elapsed is not None:
        seconds = F.greatest(F.col(elapsed), F.lit(1e-6))
        columns["bytes_per_second"] = F.round(F.col("stored_size_bytes") / seconds, 2)
    quota = registry.select("source_id", F.col("max_bytes").alias("quota_bytes"))
    joined = done.withColumns(columns).join(quota, "source_id")
    return joined.select(
        "source_id",
        "shard_sequence",
        "stored_size_bytes",
        "verified_bytes",
        "quota_bytes",
        F.round(F.col("verified_bytes") / F.col("quota_bytes"), 6).alias("quota_share"),
        *[c for c in columns if c != "verified_bytes"],
    )


def empty_sources(registry: DataFrame, shards: DataFrame) -> DataFrame:
    """Sources whose run ended without any shard, new or old."""
    done = shards.where(F.col("status") == COMPLETED).select("source_id")
    return registry.select("source_id").join(done, "source_id", "left_anti").withColumn(
        "problem", F.concat(F.lit("source produced no records: "), F.col("source_id"))
    )


def run_outcome(sources: DataFrame) -> DataFrame:
    """What to do with each source, from its status, verified bytes and quota.

    Completing a source that never ran is not an allowed change; it is reported as a
    violation instead of stopping the others.
    """
    full = F.col("max_bytes").isNotNull() & (F.col("verified_bytes") >= F.col("max_bytes"))
    status = F.col("status")
    active = F.concat(F.lit("source is already active: "), F.col("source_id"))
    may_complete = status.isin("RUNNING", "PAUSED", "RETRYING", "FAILED")
    action = (
        F.when(status == COMPLETED, "skip")
        .when(full & may_complete, "complete")
        .when(full, "violation")
        .when(status.isin(PENDING, PAUSED), "run")
        .when(status == FAILED, "retry")
        .otherwise("error")
    )
    return sources.select(
        "source_id",
        "status",
        action.alias("action"),
        F.when(action == "error", active).alias("error"),
    )
