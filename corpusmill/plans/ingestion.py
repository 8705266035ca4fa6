"""Ingest runs: read sources, cut and store shards, commit them, report."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import keys
from corpusmill.functions.text import stored_size
from corpusmill.operators import control, quota, reconcile, sharding
from corpusmill.operators.manifest import manifest_json, run_manifest
from corpusmill.operators.registry import require_valid, source_plan
from corpusmill.plans.staging import stage
from corpusmill.plans.tables import ControlTables
from corpusmill.schemas import (
    CHECKSUM_ALGORITHM,
    COMPLETED,
    DEFAULT_BUDGET_BYTES,
    DEFAULT_MAXIMUM_BYTES,
    DEFAULT_TARGET_BYTES,
    FAILED,
    PAUSE_REQUESTED,
    PAUSED,
    PENDING,
    REGISTRATIONS,
    RETRYING,
    RUNNING,
    RUNS,
    STATUS_EVENTS,
    TRANSITIONS,
)
from corpusmill.sources import shards as shard_files
from corpusmill.sources.datasets import read_numbered, soft_payload, text_column
from corpusmill.sources.lines import require_plain_file
from corpusmill.sources.manifests import manifest_records
from corpusmill.sources.ranges import listed_files, read_lines

# Positions of two-level sources: file index above, record index below.
_FILE_SHIFT = 40
_NO_PAUSE: Callable[[], bool] = lambda: False


Reader = Callable[[SparkSession, Row, "Settings"], DataFrame]


@dataclass(frozen=True)
class Settings:
    """Where objects go and how large shards are."""

    store: str
    bucket: str = "raw"
    target_bytes: int = DEFAULT_TARGET_BYTES
    maximum_bytes: int = DEFAULT_MAXIMUM_BYTES
    budget_bytes: int = DEFAULT_BUDGET_BYTES
    # Shards committed together; a pause takes effect between two such waves.
    shards_per_wave: int | None = None
    mirror: tuple[tuple[str, str], ...] = ()
    # Readers of further source types: a session, a registry row and these settings
    # give records ``source_id, pos, payload``; positions rise and are never reused.
    readers: Mapping[str, Reader] = field(default_factory=dict)

    @property
    def bucket_root(self) -> str:
        return f"{self.store.rstrip('/')}/{self.bucket}"


def run_ingestion(
    tables: ControlTables,
    registry: DataFrame,
    settings: Settings,
    source_id: str | None = None,
    pause_requested: Callable[[], bool] = _NO_PAUSE,
    ingestion_date: str | None = None,
) -> dict[str, str]:
    """Run or resume the selected sources in registry order; return a state for each.

    Each source is one distributed job. A source that fails is recorded and the next one
    is started; a pause stops the loop after the shards at hand are committed.
    """
    require_valid(registry, settings.budget_bytes, settings.target_bytes, settings.maximum_bytes)
    recover(tables, settings)
    date = ingestion_date or datetime.now(timezone.utc).date().isoformat()
    results: dict[str, str] = {}
    # One short row per configured source.
    plan = source_plan(registry, source_id, tuple(settings.readers))
    for row in plan.orderBy("ordinal").collect():
        try:
            state = run_source(tables, row, settings, date, pause_requested)
        except Exception as error:
            results[row["source_id"]] = f"{FAILED}: {error}"
            continue
        results[row["source_id"]] = state
        if state == PAUSED:
            break
    return results


def run_source(
    tables: ControlTables,
    source: Row,
    settings: Settings,
    ingestion_date: str,
    pause_requested: Callable[[], bool] = _NO_PAUSE,
) -> str:
    """Run or resume one source and return its state."""
    spark, name = tables.spark, source["source_id"]
    _register(tables, source)
    state = tables.sources().where(F.col("source_id") == name).first()
    if state["status"] == COMPLETED:
        return COMPLETED
    if state["verified_bytes"] >= source["max_bytes"]:
        _set_status(tables, name, None, [COMPLETED])
        return COMPLETED
    if state["status"] not in (PENDING, PAUSED, FAILED):
        raise ValueError(f"source is already active: {name} ({state['status']})")
    run_id, version_id = state["current_run_id"], state["current_version_id"]
    opened = run_id is None
    if opened:
        run_id, version_id = keys.new_run_id(), keys.new_version_id()
        started = [(run_id, name, version_id, _now())]
        tables.append("runs", spark.createDataFrame(started, RUNS))
    retry = [RETRYING] if state["status"] == FAILED else []
    _set_status(tables, name, None, [*retry, RUNNING])
    _set_status(tables, None, run_id, [RUNNING] if opened else [*retry, RUNNING])
    try:
        paused = _ingest(
            tables, source, state, settings, run_id, version_id, ingestion_date, pause_requested
        )
        stored = tables.read("shards").where(F.col("source_id") == name)
        if not paused and stored.isEmpty():
            raise ValueError(f"source produced no records: {name}")
    except Exception as error:
        _set_status(tables, name, run_id, [FAILED], str(error))
        _log(tables, "source_failed", "ERROR", str(error), run_id, name)
        raise
    if paused:
        _set_status(tables, name, run_id, [PAUSE_REQUESTED, PAUSED])
        return PAUSED
    _set_status(tables, name, run_id, [COMPLETED])
    publish_manifest(tables, run_id, settings)
    return COMPLETED


def recover(tables: ControlTables, settings: Settings) -> DataFrame:
    """Make interrupted sources resumable and check stored shards; return the violations."""
    spark = tables.spark
    sources = stage(tables.sources(), "sources")
    statuses, events = reconcile.reconcile_interrupted(sources)
    if not statuses.isEmpty():
        _append_statuses(tables, statuses)
        tables.append("event_log", control.log_events(events, F.lit(_now())))
        sources = stage(tables.sources(), "sources")
    shards = tables.read("shards")
    if shards.isEmpty():
        return spark.createDataFrame([], "source_id string, from_status string, to_status string, error string")
    listing = shard_files.list_objects(spark, settings.bucket_root)
    listing = listing.withColumn("bucket", F.lit(settings.bucket))
    bad = stage(reconcile.bad_shards(shards, listing, sources), "bad_shards")
    statuses, events, violations = reconcile.shard_failures(bad, sources)
    if not bad.isEmpty():
        _append_statuses(tables, statuses)
        tables.append("event_log", control.log_events(events, F.lit(_now())))
    return violations


def publish_manifest(tables: ControlTables, run_id: str, settings: Settings) -> str:
    """Store the manifest of a run under its key and return the key."""
    run = tables.runs().where(F.col("run_id") == run_id)
    described = control.latest_registrations(tables.read("registrations"))
    nested = run_manifest(run, described, tables.read("shards"))
    key = keys.manifest_key(F.col("source_id"), F.col("version_id"), F.col("run_id"))
    objects = manifest_json(nested).select(key.alias("object_key"), F.col("manifest").alias("body"))
    return shard_files.write_objects(objects, settings.bucket_root).first()["object_key"]


def source_records(
    spark: SparkSession, source: Row, settings: Settings, after: int = 0, max_bytes: int | None = None
) -> DataFrame:
    """A configured source as ``source_id, pos, payload``; ``pos`` is also its cursor.

    Records up to the position ``after`` are left out, and what lies well behind
    ``max_bytes`` stored bytes from there is not read. A dataset's missing text is a NULL
    payload, an error only for those who keep the record.
    """
    kind, name = source["source_type"], F.lit(source["source_id"])
    if kind in settings.readers:
        return settings.readers[kind](spark, source, settings).where(F.col("pos") > after)
    if kind == "huggingface_dataset":
        chosen = _selection(spark, source)
        payload = soft_payload(text_column(spark.read.parquet(source["source_url"])))
        rows = read_numbered(
            spark, source["source_url"], after=after, max_bytes=max_bytes, size=stored_size(payload), where=chosen
        )
        return rows.where(chosen).select(name.alias("source_id"), F.col("pos").cast("bigint").alias("pos"), payload.alias("payload"))
    if kind in ("filesystem", "http_lines"):
        files = listed_files(spark, source["source_url"])
        require_plain_file(files, source["source_url"])
        lines = read_lines(spark, files, start_offset=after, max_bytes=max_bytes)
        return lines.select(name.alias("source_id"), F.col("end_offset").alias("pos"), "payload")
    if kind == "dolma_manifest":
        rows = manifest_records(
            spark,
            source["source_url"],
            dict(settings.mirror),
            after_file=after >> _FILE_SHIFT,
            after_record=after & ((1 << _FILE_SHIFT) - 1),
            max_bytes=max_bytes,
        )
        pos = F.shiftleft(F.col("file_index").cast("bigint"), _FILE_SHIFT) + F.col("record_index")
        return rows.select(name.alias("source_id"), pos.alias("pos"), "payload")
    raise ValueError(f"no reader for sources of type {kind}")


def _selection(spark: SparkSession, source: Row):
    """The rows of the configured part of a dataset; a part that cannot be told apart fails.

    The split that a dataset without splits has is named ``train``.
    """
    columns = spark.read.parquet(source["source_url"]).columns
    chosen = F.lit(True)
    for column, value, whole in (("config", source["dataset_config"], None), ("split", source["split"], "train")):
        if value is None or (column not in columns and value == whole):
            continue
        if column not in columns:
            raise ValueError(f"dataset has no column {column} to select {value} by: {source['source_url']}")
        chosen = chosen & F.coalesce(F.col(column) == value, F.lit(False))
    return chosen


def cursor_of(source_type: str, pos: int) -> dict:
    """The cursor valid after a position."""
    if source_type in ("filesystem", "http_lines"):
        return {"byte_offset": pos}
    if source_type == "dolma_manifest":
        return {"file_index": pos >> _FILE_SHIFT, "record_index": pos & ((1 << _FILE_SHIFT) - 1)}
    return {"record_index": pos}


def position_of(cursor: dict) -> int:
    """The position a cursor stands for; 0 for the empty cursor."""
    if "byte_offset" in cursor:
        return int(cursor["byte_offset"])
    low = int(cursor.get("record_index", 0))
    return (int(cursor.get("file_index", 0)) << _FILE_SHIFT) + low


def _ingest(
    tables, source, state, settings, run_id, version_id, ingestion_date, pause_requested
) -> bool:
    """Store and commit what is left of a source, wave by wave; true when paused."""
    spark, kind, name = tables.spark, source["source_type"], source["source_id"]
    cursor = position_of(json.loads(state["checkpoint"]))
    remaining = source["max_bytes"] - state["verified_bytes"]
    records = source_records(spark, source, settings, cursor, remaining)
    # A record without a text is an error when it is reached before the quota is used up.
    present = records.withColumn("missing", F.col("payload").isNull())
    sized = quota.sized_records(present, "source_id", "pos", F.coalesce("payload", F.lit("")), "missing")
    kept = stage(quota.quota_prefix(sized, remaining), "kept")
    if not kept.where("missing").isEmpty():
        raise ValueError("a record has no text that is a string")
    oversize = sharding.oversize_records(kept, settings.maximum_bytes)
    if not oversize.isEmpty():
        raise ValueError("one record alone exceeds maximum shard size")
    borders = stage(
        sharding.shard_borders(kept, settings.target_bytes, settings.maximum_bytes), "borders"
    )
    done, total = state["completed_shard_count"], borders.count()
    wave = settings.shards_per_wave or max(total, 1)
    for first in range(0, total, wave):
        number = F.col("shard_sequence")
        part = borders.where((number > first) & (number <= first + wave))
        # Records outside the wave are dropped before the payloads are shuffled.
        begin = F.min(F.coalesce("after_pos", F.lit(cursor)))
        low, high, size = part.agg(begin, F.max("last_pos"), F.sum("size_bytes")).first()
        # A wave reads its own stretch of the source only.
        within = source_records(spark, source, settings, low, size).where((F.col("pos") > low) & (F.col("pos") <= high))
        _store_and_commit(tables, within, part, settings, name, kind, run_id, version_id, ingestion_date, done)
        if pause_requested():
            return True
        if first + wave < total and state["verified_bytes"] + _sum(borders, first + wave) >= source["max_bytes"]:
            break
    return False


def _store_and_commit(
    tables, records, borders, settings, name, kind, run_id, version_id, ingestion_date, done
) -> None:
    tagged = sharding.tag_shards(records, borders).withColumn(
        "shard_sequence", F.col("shard_sequence") + F.lit(done)
    )
    key = keys.object_key(
        F.col("source_id"),
        F.col("source_id"),
        F.lit(version_id),
        F.lit(ingestion_date),
        F.lit(run_id),
        F.col("shard_sequence"),
        F.lit("txt"),
    )
    tasks = shard_files.task_count(borders)
    written = stage(
        shard_files.write_shards(tagged, F.col("payload"), key, settings.bucket_root, tasks), "written"
    )
    shard_files.require_verified(written)
    rows = written.select(
        keys.shard_id(F.lit(run_id), F.col("shard_sequence")).alias("shard_id"),
        F.lit(run_id).alias("run_id"),
        "source_id",
        F.lit(version_id).alias("version_id"),
        "shard_sequence",
        F.lit(COMPLETED).alias("status"),
        F.lit(settings.bucket).alias("bucket"),
        "object_key",
        "record_count",
        "stored_size_bytes",
        F.col("size_bytes").alias("downloaded_size_bytes"),
        F.lit(CHECKSUM_ALGORITHM).alias("checksum_algorithm"),
        "checksum",
        F.col("checksum").alias("etag"),
        _cursor_json(kind).alias("checkpoint"),
        F.lit(_now()).alias("verified_at"),
    )
    existing = tables.read("shards")
    control.require_no_conflicts(existing, rows)
    # The commit point: shards, cursor and totals become visible with this append.
    tables.append("shards", control.new_shards(existing, rows))


def _cursor_json(kind: str):
    pos = F.col("last_pos")
    if kind == "dolma_manifest":
        low = pos.bitwiseAND(F.lit((1 << _FILE_SHIFT) - 1))
        high = F.shiftright(pos, _FILE_SHIFT)
        return F.to_json(F.struct(high.alias("file_index"), low.alias("record_index")))
    name = "byte_offset" if kind in ("filesystem", "http_lines") else "record_index"
    return F.to_json(F.struct(pos.alias(name)))


def _sum(borders: DataFrame, upto: int) -> int:
    return borders.where(F.col("shard_sequence") <= upto).agg(F.sum("size_bytes")).first()[0] or 0


def _register(tables: ControlTables, source: Row) -> None:
    row = (
        source["source_id"],
        source["source_id"],
        source["source_type"],
        source["source_url"],
        source["license_name"],
        source["license_url"],
        source["notes"],
        source["dataset_id"],
        source["dataset_config"],
        source["max_bytes"],
        None,
        _now(),
    )
    tables.append("registrations", tables.spark.createDataFrame([row], REGISTRATIONS))


def _set_status(
    tables: ControlTables, source_id: str | None, run_id: str | None, steps: list[str], error=None
) -> None:
    """Append status changes of a source, a run or both; the last one carries the error."""
    now, seq = _now(), time.time_ns()
    keys_ = {"source": source_id, "run": run_id}
    current = _current_statuses(tables, keys_)
    rows = []
    for entity, key in keys_.items():
        if key is None:
            continue
        status = current.get(entity, PENDING)
        for i, target in enumerate(steps):
            if status != target and (status, target) not in TRANSITIONS:
                raise ValueError(f"invalid source state transition: {status} -> {target}")
            status = target
            rows.append((entity, key, seq + i, status, error if i == len(steps) - 1 else None, now))
    events = tables.spark.createDataFrame(rows, STATUS_EVENTS)
    tables.append("status_events", events)


def _current_statuses(tables: ControlTables, wanted: dict[str, str | None]) -> dict[str, str]:
    named = [f"{entity}/{key}" for entity, key in wanted.items()]
    mine = F.concat_ws("/", "entity", "id").isin(named)
    last = tables.read("status_events").where(mine).groupBy("entity")
    return {r["entity"]: r["status"] for r in last.agg(F.max_by("status", "seq").alias("status")).collect()}


def _append_statuses(tables: ControlTables, statuses: DataFrame) -> None:
    seq = time.time_ns()
    tables.append(
        "status_events",
        statuses.select(
            "entity",
            "id",
            (F.lit(seq) + F.col("step")).alias("seq"),
            "status",
            "error",
            F.lit(_now()).alias("ts"),
        ),
    )


def _log(tables, event_type, level, message, run_id, source_id) -> None:
    row = [(run_id, source_id, None, event_type, level, message, None)]
    columns = "run_id string, source_id string, shard_id string, event_type string, event_level string, message string, event_data string"
    events = tables.spark.createDataFrame(row, columns)
    tables.append("event_log", control.log_events(events, F.lit(_now())))


def _now() -> datetime:
    return datetime.now(timezone.utc)
