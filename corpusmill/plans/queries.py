"""Registered queries: every operator over the given tables.

Sizes are small so that small tables give several shards and blocks. The byte quota holds
in the queries about quotas and cursors only; all others work on every document.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions import keys
from corpusmill.functions.text import json_payload, pretokens, stored_size
from corpusmill.operators import (
    bpe,
    control,
    documents,
    evaluation,
    lifecycle,
    manifest,
    packing,
    quota,
    reconcile,
    registry,
    sharding,
    tokens,
)
from corpusmill.plans.staging import new_path, stage
from corpusmill.schemas import SOURCE_TYPES, STATES
from corpusmill.sources import shards as shard_files
from corpusmill.sources import tokens as token_files
from corpusmill.sources.datasets import read_texts, text_payload
from corpusmill.sources.lines import scan_files
from corpusmill.sources.manifests import manifest_records
from corpusmill.sources.packed import read_packed, store_packed
from corpusmill.sources.ranges import read_lines
from corpusmill.streaming.ingest import ShardCommitter, run_until_paused, start_ingest
from corpusmill.streaming.lifecycle import StatusJudge, judge_stream

QUOTA = 60_000
TARGET = 16_384
MAXIMUM = 32_768
SEQUENCE_LENGTH = 32
VOCAB_SIZE = 4096
VERSION = "2025-02-03T04-05-06Z-0f1e2d3c"
DATE = "2025-02-03"
STATUS_OF_EVENT = {
    "signup": "PENDING",
    "view": "RUNNING",
    "click": "PAUSED",
    "purchase": "COMPLETED",
    "error": "FAILED",
}


# --- shared inputs -----------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return read_texts(spark, f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as source records: ``source_id, pos, payload``."""
    docs = texts(spark, sf_dir)
    return docs.select(
        F.col("source").alias("source_id"),
        F.col("doc_id").alias("pos"),
        text_payload(docs).alias("payload"),
    )


def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.sized_records(records(spark, sf_dir), "source_id", "pos", F.col("payload"))


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records within the byte quota of their source."""
    return quota.quota_prefix(sized(spark, sf_dir), QUOTA)


def borders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(sharding.shard_borders(sized(spark, sf_dir), TARGET, MAXIMUM), "borders")


def tagged(spark: SparkSession, sf_dir: str, edges: DataFrame) -> DataFrame:
    return sharding.tag_shards(records(spark, sf_dir), edges)


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = borders(spark, sf_dir)
    return shard_files.shard_stats(
        tagged(spark, sf_dir, edges), F.col("payload"), shard_files.task_count(edges)
    )


def run_of(source: Column) -> Column:
    return F.concat(F.lit("run-"), source)


def key_of(source: Column, sequence: Column) -> Column:
    return keys.object_key(
        source, source, F.lit(VERSION), F.lit(DATE), run_of(source), sequence, F.lit("txt")
    )


def committed(shards: DataFrame, size: str = "size_bytes") -> DataFrame:
    """Shard rows as they are committed."""
    run, sequence = run_of(F.col("source_id")), F.col("shard_sequence")
    extra = [c for c in ("checksum",) if c in shards.columns]
    return shards.select(
        keys.shard_id(run, sequence).alias("shard_id"),
        run.alias("run_id"),
        "source_id",
        F.lit(VERSION).alias("version_id"),
        "shard_sequence",
        F.lit("COMPLETED").alias("status"),
        F.lit("raw").alias("bucket"),
        key_of(F.col("source_id"), sequence).alias("object_key"),
        "record_count",
        F.col(size).alias("stored_size_bytes"),
        F.col(size).alias("downloaded_size_bytes"),
        *extra,
    )


def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return committed(borders(spark, sf_dir))


def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry made from the sources that documents name."""
    names = read(spark, sf_dir, "documents").select(F.col("source").alias("source_id")).distinct()
    # One row per source.
    numbered = Window.partitionBy(F.lit(0)).orderBy("source_id")
    ordinal = F.col("ordinal")
    types = F.array(*[F.lit(t) for t in SOURCE_TYPES])
    return names.withColumn("ordinal", F.row_number().over(numbered) - 1).select(
        "ordinal",
        "source_id",
        types[ordinal % 4].alias("source_type"),
        F.concat(F.lit("https://example.test/"), "source_id").alias("source_url"),
        F.lit("CC0-1.0").alias("license_name"),
        F.lit("https://example.test/license").alias("license_url"),
        (40_000 + 5_000 * (ordinal % 9)).cast("bigint").alias("max_bytes"),
        F.when(ordinal % 4 == 0, F.col("source_id")).alias("dataset_id"),
        F.lit(None).cast("string").alias("dataset_config"),
        F.lit("train").alias("split"),
        (ordinal % 7 != 3).alias("enabled"),
        F.concat(F.lit("source "), ordinal.cast("string")).alias("notes"),
    )


def status_of(ordinal: Column) -> Column:
    return F.array(*[F.lit(s) for s in STATES])[ordinal % len(STATES)]


def source_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with a status, a run (for most) and verified bytes."""
    entries = source_registry(spark, sf_dir)
    totals = control.source_totals(entries, shard_rows(spark, sf_dir))
    run = F.when(F.col("ordinal") % 5 != 4, run_of(F.col("source_id")))
    return entries.join(totals, "source_id").select(
        "source_id",
        "ordinal",
        status_of(F.col("ordinal")).alias("status"),
        run.alias("current_run_id"),
        "max_bytes",
        "verified_bytes",
    )


def status_events(events: DataFrame) -> DataFrame:
    """The event table as a history of statuses, one entity per user."""
    mapping = F.create_map(*[F.lit(x) for pair in STATUS_OF_EVENT.items() for x in pair])
    return events.select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_id").alias("seq"),
        mapping[F.col("event_type")].alias("status"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
        "ts",
    )


def perturbed_listing(shards: DataFrame) -> DataFrame:
    """An object listing that lacks some shards and has another size for others."""
    number = F.col("shard_sequence")
    return shards.where(number % 5 != 3).select(
        "bucket",
        "object_key",
        (F.col("stored_size_bytes") - F.when(number % 4 == 2, 1).otherwise(0)).alias("length"),
    )


def word_ids(text: Column) -> Column:
    """Ids of words in a fixed vocabulary: first character and length of each word."""
    number = F.transform(
        pretokens(text), lambda w: ((F.ascii(w) * 31 + F.char_length(w)) % VOCAB_SIZE).cast("int")
    )
    return number


def token_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    return stage(docs.select("doc_id", "source", word_ids(F.col("text")).alias("ids")), "token_docs")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = token_docs(spark, sf_dir)
    return stage(packing.pack_blocks(docs, SEQUENCE_LENGTH, VOCAB_SIZE), "blocks")


def joined(ids: str) -> Column:
    return token_files.id_line(F.col(ids)).alias(ids)


def stamp(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(ts)


# --- sources -----------------------------------------------------------------


def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "objects")
    edges = borders(spark, sf_dir)
    name = F.format_string("%s/shard-%06d.txt", "source_id", "shard_sequence")
    written = stage(
        shard_files.write_shards(
            tagged(spark, sf_dir, edges), F.col("payload"), name, root, shard_files.task_count(edges)
        ),
        "written",
    )
    # A plain path, as names of sources are not escaped like those of a URI.
    path = F.concat(F.lit(re.sub(r"^file:/+", "/", root) + "/"), F.col("object_key"))
    lines = scan_files(written.select(path.alias("file"), F.col("stored_size_bytes").alias("length")))
    pattern = r"([^/]+)/shard-(\d+)\.txt$"
    return lines.select(
        F.regexp_extract("file", pattern, 1).alias("source_id"),
        F.regexp_extract("file", pattern, 2).cast("bigint").alias("shard_sequence"),
        "record_index",
        "end_offset",
        F.col("payload").cast("string").alias("payload"),
    )


def dataset_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    payload = text_payload(docs)
    return docs.select("doc_id", payload.alias("payload"), stored_size(payload).alias("size"))


def resume_byte_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored shards as plain files, from behind the first line of the middle one to a quota."""
    root = new_path(spark, "objects")
    edges = borders(spark, sf_dir)
    name = F.format_string("%s/shard-%06d.txt", "source_id", "shard_sequence")
    written = shard_files.write_shards(
        tagged(spark, sf_dir, edges), F.col("payload"), name, root, shard_files.task_count(edges)
    )
    # The names of the files, as a scan of them would list.
    order = stage(written, "written").orderBy("source_id", "shard_sequence").select("object_key")
    files = [(i, f"{root}/{r['object_key']}") for i, r in enumerate(order.collect())]
    middle = len(files) // 2
    cursor = read_lines(spark, files, first_file=middle, max_records=1).first()["end_offset"]
    rest = read_lines(spark, files, first_file=middle, start_offset=cursor, max_bytes=4 * QUOTA)
    return rest.select(
        "file_index", "end_offset", "total_records", "total_bytes", F.col("payload").cast("string").alias("payload")
    )


def resume_file_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed files of a manifest, from behind the third record of the second one to a quota."""
    listed, mirror = _stored_manifest(spark, sf_dir)
    found = manifest_records(spark, listed, mirror, after_file=1, after_record=3, max_bytes=4 * QUOTA)
    return found.withColumn("payload", F.col("payload").cast("string"))


def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed, mirror = _stored_manifest(spark, sf_dir)
    found = manifest_records(spark, listed, mirror)
    return found.withColumn("payload", F.col("payload").cast("string"))


def _stored_manifest(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, str]]:
    """Documents as compressed JSON lines, the manifest of the files, and where they lie."""
    docs = read(spark, sf_dir, "documents")
    folder = new_path(spark, "manifest")
    files = max(4, docs.count() // 100_000)
    placed = docs.select(
        F.pmod("doc_id", F.lit(files)).alias("n"),
        "doc_id",
        F.to_json(F.struct("doc_id", "text")).alias("value"),
    )
    (
        # By number and not by its hash, which sends several files to one task.
        placed.repartitionById(files, F.col("n").cast("int"))
        .sortWithinPartitions("n", "doc_id")
        .select("n", "value")
        .write.partitionBy("n")
        .option("compression", "gzip")
        .text(f"{folder}/data")
    )
    written = spark.read.format("binaryFile").load(f"{folder}/data").select("path", "n")
    entry = F.concat(
        F.regexp_replace("path", "^.*?/data/", "https://example.test/"),
        F.when(F.col("n") % 2 == 1, "\n").otherwise(""),
    )
    # The manifest is one small file by definition: one line per listed file.
    listed = written.orderBy("n").select(entry.alias("value")).coalesce(1)
    listed.write.text(f"{folder}/list")
    return f"{folder}/list", {"https://example.test/": f"{folder}/data"}


def resume_from_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sized(spark, sf_dir)
    first = stage(
        quota.quota_prefix(rows, QUOTA // 2)
        .groupBy("source_id")
        .agg(F.max("pos").alias("cursor"), F.sum("size").alias("verified_bytes")),
        "cursors",
    )
    limits = quota.remaining_limits(
        rows.select("source_id", F.lit(QUOTA).cast("bigint").alias("max_bytes")).distinct(),
        first.select("source_id", "verified_bytes"),
    )
    rest = quota.resume_after(rows, first.select("source_id", "cursor"))
    return quota.quota_prefix(rest, limits)


def quota_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir)


def record_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.record_limit(quota.with_offsets(sized(spark, sf_dir)), 25)


def source_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = registry.source_plan(source_registry(spark, sf_dir))
    return plan.select("ordinal", "source_id", "source_type", "reader", "max_bytes")


# --- shards ------------------------------------------------------------------


def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_assign(sized(spark, sf_dir), TARGET, MAXIMUM)


def oversize_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sized(spark, sf_dir)
    first = sharding.oversize_records(rows, 4_096).withColumn("strict", F.lit(False))
    every = sharding.oversize_records(rows, 4_096, strict=True).withColumn("strict", F.lit(True))
    return first.unionByName(every)


def shard_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats(spark, sf_dir)


def shard_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.col("source_id")
    return borders(spark, sf_dir).select(
        "source_id",
        "shard_sequence",
        key_of(source, F.col("shard_sequence")).alias("object_key"),
        keys.manifest_key(source, F.lit(VERSION), run_of(source)).alias("manifest_key"),
    )


def shard_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = borders(spark, sf_dir)
    key = key_of(F.col("source_id"), F.col("shard_sequence"))
    written = stage(
        shard_files.write_shards(
            tagged(spark, sf_dir, edges),
            F.col("payload"),
            key,
            new_path(spark, "objects"),
            shard_files.task_count(edges),
        ),
        "written",
    )
    shard_files.require_verified(written)
    return written


def verify_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = borders(spark, sf_dir)
    root = new_path(spark, "objects")
    key = F.format_string("%s/shard-%06d.txt", "source_id", "shard_sequence")
    written = shard_files.write_shards(
        tagged(spark, sf_dir, edges), F.col("payload"), key, root, shard_files.task_count(edges)
    )
    built = stage(written, "written").select(
        "source_id", "shard_sequence", "object_key", "size_bytes"
    )
    listing = shard_files.list_objects(spark, root)
    number = F.regexp_extract("object_key", r"shard-(\d+)", 1).cast("int")
    changed = F.col("length") + F.when(number % 3 == 0, 1).otherwise(0)
    found = shard_files.verify_written(
        built, listing.where(number % 4 != 2).withColumn("length", changed)
    )
    return found.withColumn("length", F.coalesce("length", F.lit(-1).cast("bigint")))


def token_ids_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ids")
    total = token_files.write_token_ids(token_docs(spark, sf_dir), path, "doc_id")
    lines = token_files.read_token_ids(spark, path)
    return lines.select(joined("ids"), F.lit(total).cast("bigint").alias("total"))


# --- control tables ----------------------------------------------------------


def register_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = source_registry(spark, sf_dir)

    def described(rows: DataFrame, prefix: str) -> DataFrame:
        return rows.select(
            "source_id",
            F.concat(F.lit(prefix), "source_id").alias("source_name"),
            "source_type",
            F.col("source_url").alias("source_uri"),
            "license_name",
            "license_url",
            F.col("notes").alias("source_notes"),
            "dataset_id",
            "dataset_config",
            F.col("max_bytes").alias("configured_quota_bytes"),
            F.lit(None).cast("string").alias("checkpoint_type"),
            "ordinal",
        )

    old_time = F.lit("2026-01-01 00:00:00")
    old = described(entries.where("ordinal % 3 <> 0"), "old ").withColumns(
        {
            "status": F.lit("PAUSED"),
            "downloaded_bytes": F.col("ordinal") * 100,
            "verified_bytes": F.col("ordinal") * 100,
            "completed_shard_count": F.col("ordinal"),
            "checkpoint": F.lit('{"record_index":1}'),
            "created_at": old_time,
            "updated_at": old_time,
        }
    )
    new = described(entries.where("ordinal % 2 = 0"), "new ")
    merged = control.register_sources(old, new, F.lit("2026-02-01 00:00:00"))
    return merged.select(
        "source_id",
        "source_name",
        "configured_quota_bytes",
        "status",
        F.col("verified_bytes").cast("bigint").alias("verified_bytes"),
        "checkpoint",
        "created_at",
        "updated_at",
    )


def open_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = source_registry(spark, sf_dir)
    old_runs = entries.where("ordinal % 2 = 0").select(
        F.concat(F.lit("old-"), "source_id").alias("run_id"),
        "source_id",
        F.lit("v1").alias("version_id"),
        F.lit("2026-01-01 00:00:00").alias("started_at"),
    )
    ids = entries.select(
        "source_id",
        F.concat(F.lit("new-"), "source_id").alias("run_id"),
        F.lit("v2").alias("version_id"),
        F.lit("2026-02-01 00:00:00").alias("started_at"),
    )
    opened = control.open_runs(entries, old_runs, ids)
    return control.current_runs(old_runs.unionByName(opened))


def commit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(shard_rows(spark, sf_dir), "shards")
    existing = rows.where("shard_sequence % 2 = 1")
    replayed = rows.unionByName(rows)
    return control.new_shards(existing, replayed).select(
        "shard_id", "source_id", "shard_sequence", "stored_size_bytes"
    )


def commit_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(shard_rows(spark, sf_dir), "shards")
    status = F.when(F.col("shard_sequence") % 3 == 1, "UPLOADING").otherwise("COMPLETED")
    found = control.commit_conflicts(rows.withColumn("status", status), rows)
    return found.select("shard_id", "stored_status")


def source_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.source_totals(source_registry(spark, sf_dir), shard_rows(spark, sf_dir))


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("shard_sequence") <= 2, "-a").otherwise("-b")
    shards = shard_rows(spark, sf_dir).withColumn("run_id", F.concat("run_id", part))
    source = F.col("source_id")
    runs = source_registry(spark, sf_dir).select(
        F.explode(
            F.array(*[F.concat(run_of(source), F.lit(x)) for x in ("-a", "-b", "-c")])
        ).alias("run_id"),
        "source_id",
    )
    return control.run_totals(runs, shards)


def resume_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    cursor = F.concat(
        F.lit('{"record_index": '), F.col("record_index").cast("string"), F.lit(', "file_index": 0}')
    )
    edges = borders(spark, sf_dir).withColumn(
        "checkpoint", F.when(F.col("shard_sequence") % 4 != 0, cursor)
    )
    entries = source_registry(spark, sf_dir).select("source_id")
    unseen = entries.select(F.concat("source_id", F.lit("-new")).alias("source_id"))
    return control.resume_cursor(entries.unionByName(unseen), edges)


def apply_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = lifecycle.apply_status(status_events(read(spark, sf_dir, "events")))
    times = ("updated_at", "last_started_at", "last_completed_at", "paused_at", "failed_at")
    return current.select("id", "status", "last_error", *[stamp(t) for t in times])


def lifecycle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = status_events(read(spark, sf_dir, "events")).select("id", "seq", "status")
    return lifecycle.lifecycle_audit(history)


def quota_reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.quota_reached(source_registry(spark, sf_dir), shard_rows(spark, sf_dir))


def source_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = source_registry(spark, sf_dir)
    last = entries.agg(F.max("source_id")).first()[0]
    return control.lookup(entries, "source_id", last).select("source_id", "ordinal", "max_bytes")


def run_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = source_registry(spark, sf_dir)
    runs = entries.select(run_of(F.col("source_id")).alias("run_id"), "source_id", "ordinal")
    wanted = runs.where("ordinal % 3 = 1")
    return control.lookup_many(runs, "run_id", wanted)


def run_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = committed(stats(spark, sf_dir)).withColumns(
        {"checksum_algorithm": F.lit("sha256"), "etag": F.col("checksum")}
    )
    first = read(spark, sf_dir, "documents").agg(F.min("source")).first()[0]
    return control.run_shards(rows, f"run-{first}")


def source_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = source_registry(spark, sf_dir)
    return control.source_listing(entries.select("source_id", "source_type", "max_bytes", "enabled"))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    rows = events.select(
        F.lit(None).cast("string").alias("run_id"),
        F.col("user_id").cast("string").alias("source_id"),
        F.lit(None).cast("string").alias("shard_id"),
        "event_type",
        level.alias("event_level"),
        F.lit("").alias("message"),
        F.col("props").alias("event_data"),
        "ts",
    )
    counted = control.event_counts(control.log_events(rows, F.col("ts")))
    return counted.select("event_type", "event_level", "n", stamp("first_at"), stamp("last_at"))


def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = source_registry(spark, sf_dir)
    shards = committed(stats(spark, sf_dir)).withColumns(
        {"checksum_algorithm": F.lit("sha256"), "etag": F.lit(None).cast("string")}
    )
    runs = entries.select(
        run_of(F.col("source_id")).alias("run_id"),
        "source_id",
        F.lit(VERSION).alias("version_id"),
        F.when(F.col("enabled"), "COMPLETED").otherwise("PAUSED").alias("status"),
        F.lit("2025-02-03 10:30:00").alias("started_at"),
        F.when(F.col("enabled"), "2025-02-03 11:00:00").alias("completed_at"),
    )
    sources = entries.withColumnsRenamed({"source_url": "source_uri", "notes": "source_notes"})
    return manifest.manifest_json(manifest.run_manifest(runs, sources, shards))


def reconcile_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    statuses, _ = reconcile.reconcile_interrupted(source_states(spark, sf_dir))
    return statuses


def reconcile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, events = reconcile.reconcile_interrupted(source_states(spark, sf_dir))
    return events


def reconcile_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = stage(shard_rows(spark, sf_dir), "shards")
    found = reconcile.bad_shards(shards, perturbed_listing(shards))
    return found.withColumn("length", F.coalesce("length", F.lit(-1).cast("bigint")))


def reconcile_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = stage(shard_rows(spark, sf_dir), "shards")
    sources = source_registry(spark, sf_dir).select(
        "source_id", status_of(F.col("ordinal")).alias("status")
    )
    bad = reconcile.bad_shards(shards, perturbed_listing(shards))
    statuses, _, violations = reconcile.shard_failures(bad, sources)
    refused = violations.select(
        F.lit("violation").alias("entity"),
        F.col("source_id").alias("id"),
        F.concat_ws(" -> ", "from_status", "to_status").alias("status"),
        "error",
    )
    return statuses.select("entity", "id", "status", "error").unionByName(refused)


def listing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = stage(shard_rows(spark, sf_dir), "shards")
    listing = perturbed_listing(shards)
    orphans = shards.where("shard_sequence = 1").select(
        "bucket", F.concat("object_key", F.lit(".copy")).alias("object_key"), F.lit(1).cast("bigint").alias("length")
    )
    found = reconcile.listing_audit(shards, listing.unionByName(orphans))
    return found.select("object_key", "finding")


def incomplete_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in (".partial", ".ready", ".uploading", ".txt")])
    number = F.col("shard_sequence")
    name = F.concat(
        F.format_string("%s/shard-%06d", "source_id", "shard_sequence"),
        F.get(kinds, ((number + F.length("source_id")) % 4).cast("int")),
    )
    aside = F.when(number % 3 == 0, "quarantine/20260714T103000Z/").otherwise("")
    staged = borders(spark, sf_dir).select(F.concat(aside, name).alias("path"))
    return reconcile.incomplete_files(staged, "20260714T103000Z")


def registry_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = source_registry(spark, sf_dir)
    o = F.col("ordinal")
    broken = entries.where(o % 4 == 1).withColumns(
        {
            "source_id": F.when(o % 8 == 1, F.col("source_id")).when(o % 8 == 5, ""),
            "max_bytes": -F.col("max_bytes"),
            "license_name": F.when(o % 3 == 0, F.col("license_name")),
        }
    )
    return registry.registry_check(entries.unionByName(broken), 100_000)


def progress_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_rows(spark, sf_dir).withColumn("elapsed", (F.col("shard_sequence") % 3) * 0.5)
    return control.progress_report(shards, source_registry(spark, sf_dir), "elapsed")


def nonempty_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Roles of conversations are registered as sources too, but have no shards.
    roles = read(spark, sf_dir, "conversations").select(F.concat(F.lit("role-"), "role")).distinct()
    named = source_registry(spark, sf_dir).select("source_id").union(roles)
    return control.empty_sources(named, shard_rows(spark, sf_dir))


def run_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.run_outcome(source_states(spark, sf_dir))


# --- text --------------------------------------------------------------------


def assemble_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    # Each source is one file; its documents follow each other with a blank line between.
    parts = F.concat(F.split("text", "\n"), F.array(F.lit(" ")))
    lines = docs.select("source", "doc_id", F.posexplode(parts).alias("n", "value")).select(
        "source",
        (F.shiftleft("doc_id", 24) + F.col("n")).alias("line_no"),
        "value",
    )
    return documents.assemble_documents(lines, "source", "line_no", "value", 40)


def text_file_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "texts")
    docs = texts(spark, sf_dir)
    ends = F.concat("text", F.when(F.col("doc_id") % 2 == 0, "\n").otherwise("\n \t"))
    docs.select(ends.alias("value")).write.option("lineSep", "\n\n").text(path)
    found = documents.read_documents(spark, path, 40)
    return found.groupBy("text").agg(F.count("*").alias("n"))


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = texts(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    docs = texts(spark, sf_dir).select((-F.col("doc_id") - 1).alias("page_id"), "text")
    return documents.normalized(pages.unionByName(docs))


def min_chars_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents.normalized(texts(spark, sf_dir).select("doc_id", "source", "text"))
    long = documents.min_chars_filter(docs, 200)
    chars = F.char_length("text").cast("bigint")
    return long.select("doc_id", "source", chars.alias("chars"))


def require_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents.normalized(texts(spark, sf_dir).select("doc_id", "source", "text"))
    found = documents.require_documents(documents.min_chars_filter(docs))
    return found.groupBy("source").agg(F.count("*").alias("documents"))


def split_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    per_source = documents.split_last(docs, "doc_id", ["source"])
    return documents.split_last(
        per_source.withColumnRenamed("split", "source_split"), "doc_id"
    ).withColumnRenamed("split", "overall_split")


# --- tokens ------------------------------------------------------------------


def pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.pretoken_counts(texts(spark, sf_dir))


def bpe_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = bpe.train_bpe(texts(spark, sf_dir))
    columns = "id int, token string, left int, right int"
    return spark.createDataFrame(bpe.vocabulary_rows(learned), columns)


def corpus_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = bpe.train_bpe(texts(spark, sf_dir, "conversations"))
    docs = texts(spark, sf_dir).select("doc_id", "text")
    return tokens.encode(docs, learned).select("doc_id", "ids")


def encode_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts encoded with a vocabulary of their own letters and decoded again."""
    docs = texts(spark, sf_dir).select("doc_id", "text")
    learned = bpe.train_bpe(docs, min_frequency=50)
    ids = tokens.encode(docs, learned)
    return ids.select("doc_id", tokens.decode(F.col("ids"), learned).alias("joined"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir).select("source", pretokens(F.col("text")).alias("ids"))
    per_source = tokens.token_counts(docs, ["source"])
    overall = per_source.agg(
        F.lit("*").alias("source"), F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
    )
    return per_source.unionByName(overall)


def vocab_range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir).select("doc_id", word_ids(F.col("text")).alias("ids"))
    return tokens.vocab_range_check(docs, VOCAB_SIZE - 400).select("doc_id", "bad_id")


def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_blocks(token_docs(spark, sf_dir), SEQUENCE_LENGTH, VOCAB_SIZE)
    return packed.select("block_id", joined("ids"))


def pack_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.require_blocks(blocks(spark, sf_dir))
    return packing.pack_metadata(packed, SEQUENCE_LENGTH, VOCAB_SIZE)


def pack_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = blocks(spark, sf_dir)
    sound = packing.pack_metadata(packed, SEQUENCE_LENGTH, VOCAB_SIZE)
    cases = {
        "sound": sound,
        "short": sound.withColumn("num_blocks", F.col("num_blocks") - 1),
        "wrong_tokens": sound.withColumn("num_tokens", F.col("num_tokens") + 1),
        "no_length": sound.withColumn("sequence_length", F.lit(0)),
    }
    found = [
        packing.pack_check(metadata, packed).withColumn("metadata", F.lit(name))
        for name, metadata in cases.items()
    ]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def packed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "packed")
    written = stage(token_files.write_packed(blocks(spark, sf_dir), root, "train", 1_000), "packed")
    return written.select("object_key", "size_bytes", "record_count", "stored_size_bytes")


def packed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks stored as binary files and read back from them."""
    root = new_path(spark, "packed")
    store_packed(blocks(spark, sf_dir), root, "train", SEQUENCE_LENGTH, VOCAB_SIZE, 1_000)
    return read_packed(spark, root, "train").select("block_id", joined("ids"))


def shifted_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = packing.shifted_examples(blocks(spark, sf_dir), SEQUENCE_LENGTH)
    return examples.select("block_id", joined("inputs"), joined("targets"))


def sequential_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = packing.sequential_batches(blocks(spark, sf_dir), 2)
    ids = F.array_join(F.transform(F.flatten("ids"), lambda x: x.cast("string")), " ")
    return batches.select("batch_id", "examples", ids.alias("ids"))


def weighted_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = evaluation.unigram_scores(
        read(spark, sf_dir, "benchmark"), texts(spark, sf_dir), "item_id"
    )
    result = evaluation.weighted_perplexity(scores)
    return result.select(
        F.round("loss", 6).alias("loss"), F.round("perplexity", 3).alias("perplexity")
    )


def encoded_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, split, learn, encode, pack: the whole preparation of a training set."""
    docs = documents.normalized(texts(spark, sf_dir, "conversations"))
    docs = documents.min_chars_filter(docs).withColumn(
        "doc_id", F.shiftleft("conv_id", 16) + F.col("turn")
    )
    train = documents.split_last(docs, "doc_id").where("split = 'train'")
    learned = bpe.train_bpe(train)
    ids = stage(tokens.encode(train, learned).select("doc_id", "ids"), "token_docs")
    return packing.pack_blocks(ids, SEQUENCE_LENGTH, learned.size)


# --- streaming ---------------------------------------------------------------


def _record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arriving file by file."""
    docs = read(spark, sf_dir, "documents").select("source", "doc_id", "text")
    path = new_path(spark, "arriving")
    docs.write.option("maxRecordsPerFile", max(docs.count() // 4, 1)).parquet(path)
    files = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 2).parquet(path)
    return files.select(
        F.col("source").alias("source_id"),
        F.col("doc_id").alias("pos"),
        json_payload(F.col("text")).alias("payload"),
    )


def _committer(spark: SparkSession, pause_requested=None) -> ShardCommitter:
    return ShardCommitter(
        spark,
        new_path(spark, "objects"),
        new_path(spark, "committed"),
        "run1",
        VERSION,
        DATE,
        TARGET,
        pause_requested,
    )


def _committed_totals(shards: DataFrame) -> DataFrame:
    return shards.groupBy("source_id").agg(
        F.sum("record_count").alias("records"),
        F.sum("stored_size_bytes").alias("bytes"),
        F.max("last_pos").alias("last_pos"),
        (F.count("*") == F.countDistinct("shard_id")).alias("ids_unique"),
    )


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    commit = _committer(spark)
    start_ingest(_record_stream(spark, sf_dir), commit, new_path(spark, "progress")).awaitTermination()
    return _committed_totals(commit.committed())


def exactly_once_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir)
    commit = _committer(spark)
    first, second = rows.where("pos % 2 = 0"), rows.where("pos % 2 = 1")
    for batch_id, batch in ((0, first), (0, first), (1, second), (0, first)):
        commit(batch, batch_id)
    return _committed_totals(commit.committed())


def stream_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    # A pattern, since a stream reads folders or patterns and the table may be one file.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    return status_events(events).select("id", "seq", "status")


def lifecycle_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judge = StatusJudge(spark, new_path(spark, "lifecycle"))
    judge_stream(stream_of_events(spark, sf_dir), judge, new_path(spark, "progress")).awaitTermination()
    return judge.verdicts()


def graceful_pause(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, progress = _record_stream(spark, sf_dir), new_path(spark, "progress")
    asked = iter([False, True])
    commit = _committer(spark, lambda: next(asked, False))
    paused = run_until_paused(stream, commit, progress)
    resumed = run_until_paused(stream, commit, progress)
    return _committed_totals(commit.committed()).withColumns(
        {"paused_first": F.lit(paused), "paused_again": F.lit(resumed)}
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "line_scan": line_scan,
    "dataset_text_scan": dataset_text_scan,
    "manifest_scan": manifest_scan,
    "resume_from_cursor": resume_from_cursor,
    "resume_byte_offset": resume_byte_offset,
    "resume_file_record": resume_file_record,
    "quota_prefix": quota_prefix,
    "record_limit": record_limit,
    "source_plan": source_plan,
    "shard_assign": shard_assign,
    "oversize_guard": oversize_guard,
    "shard_stats": shard_stats,
    "shard_layout": shard_layout,
    "shard_write": shard_write,
    "verify_written": verify_written,
    "token_ids_sink": token_ids_sink,
    "register_sources": register_sources,
    "open_run": open_run,
    "commit_shards": commit_shards,
    "commit_conflicts": commit_conflicts,
    "source_totals": source_totals,
    "run_totals": run_totals,
    "resume_cursor": resume_cursor,
    "apply_status": apply_status,
    "lifecycle_audit": lifecycle_audit,
    "quota_reached": quota_reached,
    "source_by_id": source_by_id,
    "run_by_id": run_by_id,
    "run_shards": run_shards,
    "source_listing": source_listing,
    "event_log": event_log,
    "run_manifest": run_manifest,
    "reconcile_interrupted": reconcile_interrupted,
    "reconcile_events": reconcile_events,
    "reconcile_shards": reconcile_shards,
    "reconcile_failures": reconcile_failures,
    "listing_audit": listing_audit,
    "incomplete_files": incomplete_files,
    "registry_check": registry_check,
    "progress_report": progress_report,
    "nonempty_sources": nonempty_sources,
    "run_outcome": run_outcome,
    "assemble_documents": assemble_documents,
    "text_file_documents": text_file_documents,
    "normalize_text": normalize_text,
    "min_chars_filter": min_chars_filter,
    "require_documents": require_documents,
    "split_last": split_last,
    "pretoken_counts": pretoken_counts,
    "bpe_train": bpe_train,
    "corpus_encode": corpus_encode,
    "encode_round_trip": encode_round_trip,
    "token_counts": token_counts,
    "vocab_range_check": vocab_range_check,
    "pack_blocks": pack_blocks,
    "pack_metadata": pack_metadata,
    "pack_check": pack_check,
    "packed_file": packed_file,
    "packed_read": packed_read,
    "shifted_examples": shifted_examples,
    "sequential_batches": sequential_batches,
    "weighted_perplexity": weighted_perplexity,
    "encoded_blocks": encoded_blocks,
    "incremental_ingest": incremental_ingest,
    "exactly_once_commit": exactly_once_commit,
    "lifecycle_stream": lifecycle_stream_query,
    "graceful_pause": graceful_pause,
}
