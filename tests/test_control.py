import json
import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.functions import keys
from corpusmill.operators import control, lifecycle, manifest, reconcile, registry
from corpusmill.schemas import STATES, TRANSITIONS

SHARD = (
    "shard_id string, run_id string, source_id string, shard_sequence bigint, status string, "
    "bucket string, object_key string, stored_size_bytes bigint, downloaded_size_bytes bigint, "
    "checksum_algorithm string, checksum string, etag string, checkpoint string"
)


def shard(source, sequence, size=100, status="COMPLETED", checkpoint=None, run="run-1"):
    return (
        f"{run}-{sequence:06d}", run, source, sequence, status, "raw",
        f"{source}/shard-{sequence:06d}.txt", size, size, "sha256", "abc", None, checkpoint,
    )


def shards(spark, *rows):
    return spark.createDataFrame(list(rows), SHARD)


def entry(ordinal, source_id, max_bytes=10, enabled=True, source_type="filesystem"):
    return (
        ordinal, source_id, source_type, "https://example.test", "license",
        "https://example.test/license", max_bytes, None, None, "train", enabled, "",
    )


def entries(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.REGISTRY)


# --- keys and cursors --------------------------------------------------------


def key(spark, **parts):
    given = {
        "source_id": "Open_Notes", "dataset_name": "open-notes",
        "version_id": "2025-02-03T04-05-06Z-0f1e2d3c", "ingestion_date": "2025-02-03",
        "run_id": "0f1e2d3c", "shard_sequence": 7, "extension": "jsonl.zst", **parts,
    }
    columns = {k: F.lit(v).cast("bigint" if k == "shard_sequence" else "string") for k, v in given.items()}
    return spark.range(1).select(keys.object_key(**columns)).first()[0]


def test_object_key(spark):
    expected = (
        "Open_Notes/open-notes/version=2025-02-03T04-05-06Z-0f1e2d3c/"
        "ingestion_date=2025-02-03/run_id=0f1e2d3c/shard-000007.jsonl.zst"
    )
    assert key(spark) == expected
    assert key(spark, extension="..txt").endswith("shard-000007.txt")
    assert key(spark, shard_sequence=1234567).endswith("shard-1234567.jsonl.zst")


@pytest.mark.parametrize(
    "parts",
    [{"source_id": "a/b"}, {"run_id": ""}, {"dataset_name": ".."}, {"version_id": "a\n"},
     {"shard_sequence": -1}, {"extension": "..."}, {"run_id": None}],
)
def test_object_key_refuses(spark, parts):
    with pytest.raises(PySparkException, match="invalid|non-negative"):
        key(spark, **parts)


def test_cursors(spark):
    values = ['{"b": 1, "a": {"y": "é", "x": [1, 2]}}', None, "{}"]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    found = [r[0] for r in df.select(keys.canonical_cursor(F.col("c"))).collect()]
    assert found == ['{"a":{"x":[1,2],"y":"é"},"b":1}', "{}", "{}"]
    assert json.loads(keys.encode_cursor({"b": 1, "a": 2})) == {"a": 2, "b": 1}
    with pytest.raises(PySparkException, match="JSON object"):
        spark.createDataFrame([("[1]",)], "c string").select(keys.canonical_cursor(F.col("c"))).collect()


def test_version_ids_sort_by_time():
    version = keys.new_version_id()
    assert datetime.strptime(version[:20], "%Y-%m-%dT%H:%M:%SZ")
    assert len(version) == 29 and version[20] == "-"


# --- tables ------------------------------------------------------------------


def test_commit_is_idempotent(spark):
    old = shards(spark, shard("a", 1))
    new = shards(spark, shard("a", 1), shard("a", 2), shard("a", 2))
    assert [r["shard_id"] for r in control.new_shards(old, new).collect()] == ["run-1-000002"]
    control.require_no_conflicts(old, new)
    with pytest.raises(ValueError, match="status UPLOADING"):
        control.require_no_conflicts(shards(spark, shard("a", 1, status="UPLOADING")), new)


def test_totals_quota_and_cursor(spark):
    registered = entries(spark, entry(0, "a", 300), entry(1, "b", 300), entry(2, "c", 1))
    done = shards(
        spark,
        shard("a", 1, 100, checkpoint='{"byte_offset":8}'),
        shard("a", 2, 200, checkpoint='{"byte_offset":19}'),
        shard("b", 1, 50, run="run-2"),
        shard("b", 2, 500, status="FAILED", run="run-2"),
    )
    totals = {r["source_id"]: tuple(r)[1:] for r in control.source_totals(registered, done).collect()}
    assert totals == {"a": (300, 300, 2), "b": (50, 50, 1), "c": (0, 0, 0)}
    reached = {r["source_id"]: r["reached"] for r in control.quota_reached(registered, done).collect()}
    assert reached == {"a": True, "b": False, "c": False}
    cursors = {r["source_id"]: r["checkpoint"] for r in control.resume_cursor(registered, done).collect()}
    assert cursors == {"a": '{"byte_offset":19}', "b": "{}", "c": "{}"}
    assert [r["source_id"] for r in control.empty_sources(registered, done).collect()] == ["c"]
    listed = control.run_shards(done, "run-1").collect()
    assert [r["shard_sequence"] for r in listed] == [1, 2]
    assert control.lookup(registered, "source_id", "b").first()["max_bytes"] == 300
    with pytest.raises(KeyError):
        control.lookup(registered, "source_id", "zzz")


def test_status_history(spark):
    ts = [datetime(2026, 1, 1, 0, 0, i) for i in range(6)]
    rows = [("x", i, s, "boom" if s == "FAILED" else None, ts[i]) for i, s in
            enumerate(["PENDING", "RUNNING", "FAILED", "RETRYING", "RUNNING", "COMPLETED"])]
    df = spark.createDataFrame(rows, "id string, seq bigint, status string, error string, ts timestamp")
    now = lifecycle.apply_status(df).first()
    assert (now["status"], now["last_error"]) == ("COMPLETED", None)
    assert (now["last_started_at"], now["last_completed_at"], now["failed_at"]) == (ts[4], ts[5], ts[2])
    then = lifecycle.apply_status(df.where("seq <= 2")).first()
    assert (then["status"], then["last_error"], then["last_completed_at"]) == ("FAILED", "boom", None)


def test_every_transition(spark):
    pairs = [(a, b) for a in STATES for b in STATES]
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", lifecycle.transition_allowed(F.col("a"), F.col("b")).alias("ok")
    )
    for r in rows.collect():
        assert r["ok"] == (r["a"] == r["b"] or (r["a"], r["b"]) in TRANSITIONS)
    assert len(TRANSITIONS) == 22
    assert schemas.allowed_transitions(spark).count() == 22


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_audit_does_not_depend_on_the_block_size(spark, bits):
    rng = random.Random(bits)
    rows = [(rng.choice("aaab"), seq, rng.choice(STATES)) for seq in rng.sample(range(10_000), 500)]
    df = spark.createDataFrame(rows, "id string, seq bigint, status string")
    previous = lifecycle.with_previous(df, "id", "seq", "status", "PENDING", bits=bits)
    found = {(r["id"], r["seq"]): r["previous"] for r in previous.collect()}
    last = {}
    for key_, seq, status in sorted(rows, key=lambda r: r[1]):
        assert found[key_, seq] == last.get(key_, "PENDING")
        last[key_] = status
    bad = lifecycle.lifecycle_audit(df).collect()
    assert all((r["previous"], r["status"]) not in TRANSITIONS for r in bad)


def test_unknown_status_is_an_error(spark):
    df = spark.createDataFrame([("a", 1, "LOST")], "id string, seq bigint, status string")
    with pytest.raises(Exception, match="unknown status"):
        lifecycle.lifecycle_audit(df).collect()


# --- registry ----------------------------------------------------------------


def problems(df):
    return {(r["source_id"], r["problem"]) for r in df.collect()}


def test_registry_rules(spark):
    good = entries(spark, entry(0, "wikipedia", 60), entry(1, "books", 40))
    assert registry.require_valid(good, 100) is good
    assert problems(registry.registry_check(good, 99)) == {
        (None, "enabled source max_bytes exceed raw budget")
    }
    off = entries(spark, entry(0, "a", 60), entry(1, "b", 400, enabled=False))
    assert problems(registry.registry_check(off, 100)) == set()
    bad = entries(spark, entry(0, "a"), entry(1, "a"), entry(2, ""), entry(3, "z", 0))
    assert problems(registry.registry_check(bad)) == {
        ("a", "source IDs must be unique"),
        ("", "id must not be empty"),
        ("z", "max_bytes must be positive"),
    }
    with pytest.raises(registry.RegistryError, match="unique"):
        registry.require_valid(entries(spark, entry(0, "a"), entry(1, "a")))
    with pytest.raises(registry.RegistryError, match="shard size"):
        registry.require_valid(good, 100, 500, 200)
    with pytest.raises(registry.RegistryError, match="non-negative"):
        registry.require_valid(good, 100, min_chars=-1)


def test_source_plan(spark):
    rows = entries(
        spark, entry(1, "b"), entry(0, "a", source_type="dolma_manifest"), entry(2, "c", enabled=False)
    )
    plan = registry.source_plan(rows).orderBy("ordinal").collect()
    assert [(r["source_id"], r["reader"]) for r in plan] == [("a", "manifest"), ("b", "lines")]
    assert registry.source_plan(rows, "b").count() == 1
    for missing in ("c", "zzz"):
        with pytest.raises(ValueError, match="unknown or disabled"):
            registry.source_plan(rows, missing)
    other = entries(spark, entry(0, "a", source_type="ftp"))
    with pytest.raises(PySparkException, match="unsupported source type"):
        registry.source_plan(other).collect()


# --- recovery and manifests --------------------------------------------------


def test_reconcile(spark):
    sources = spark.createDataFrame(
        [("r", "RUNNING", "run-1"), ("p", "PAUSE_REQUESTED", None), ("d", "COMPLETED", "run-3")],
        "source_id string, status string, current_run_id string",
    )
    statuses, events = reconcile.reconcile_interrupted(sources)
    found = {(r["entity"], r["id"], r["step"], r["status"]) for r in statuses.collect()}
    assert found == {
        ("source", "r", 0, "PAUSE_REQUESTED"), ("source", "r", 1, "PAUSED"),
        ("run", "run-1", 0, "PAUSE_REQUESTED"), ("run", "run-1", 1, "PAUSED"),
        ("source", "p", 0, "PAUSED"),
    }
    assert {r["source_id"] for r in events.collect()} == {"r", "p"}

    stored = shards(spark, shard("r", 1, 10), shard("r", 2, 10), shard("d", 1, 10, run="run-3"))
    listing = spark.createDataFrame(
        [("raw", "r/shard-000001.txt", 9), ("raw", "other", 1)], "bucket string, object_key string, length bigint"
    )
    bad = reconcile.bad_shards(stored, listing, sources)
    assert {(r["source_id"], r["shard_sequence"], r["message"]) for r in bad.collect()} == {
        ("r", 1, reconcile.SIZE_ERROR), ("r", 2, reconcile.MISSING_ERROR), ("d", 1, reconcile.MISSING_ERROR),
    }
    statuses, events, violations = reconcile.shard_failures(bad, sources)
    assert {(r["entity"], r["id"]) for r in statuses.collect()} == {("source", "r"), ("run", "run-1")}
    assert {json.loads(r["event_data"])["object_key"] for r in events.collect()} == {
        "r/shard-000001.txt", "r/shard-000002.txt", "d/shard-000001.txt"
    }
    assert [(r["source_id"], r["from_status"]) for r in violations.collect()] == [("d", "COMPLETED")]
    audit = {(r["object_key"], r["finding"]) for r in reconcile.listing_audit(stored, listing).collect()}
    assert ("other", "orphan") in audit and len(audit) == 4


def test_incomplete_files(spark):
    paths = ["s/r/shard-1.partial", "s/r/a.ready", "b.uploading", "s/x.txt", "s/.partial", "quarantine/now/c.ready",
             "quarantine/old/d.ready"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    found = {(r["path"], r["kind"], r["destination"]) for r in reconcile.incomplete_files(df, "now").collect()}
    assert found == {
        ("s/r/shard-1.partial", "partial", "quarantine/now/s/r/shard-1.partial"),
        ("s/r/a.ready", "ready", "quarantine/now/s/r/a.ready"),
        ("b.uploading", "uploading", "quarantine/now/b.uploading"),
        ("quarantine/old/d.ready", "ready", "quarantine/now/quarantine/old/d.ready"),
    }


def test_manifest(spark):
    runs = spark.createDataFrame(
        [("run-1", "books", "v1", "COMPLETED", datetime(2026, 1, 1), None), ("run-2", "books", "v2", "PENDING", datetime(2026, 1, 2), None)],
        "run_id string, source_id string, version_id string, status string, started_at timestamp, completed_at timestamp",
    )
    sources = spark.createDataFrame(
        [("books", "huggingface_dataset", "https://example.test/books", "Public Domain",
          "https://example.test/license", "filtered books", "example/books", "english")],
        "source_id string, source_type string, source_uri string, license_name string, license_url string, source_notes string, dataset_id string, dataset_config string",
    )
    rows = manifest.run_manifest(runs, sources, shards(spark, shard("books", 2), shard("books", 1)))
    found = {r["run_id"]: json.loads(r["manifest"]) for r in manifest.manifest_json(rows).collect()}
    assert found["run-1"]["source"] == {
        "dataset_config": "english", "dataset_id": "example/books", "license_name": "Public Domain",
        "license_url": "https://example.test/license", "notes": "filtered books",
        "source_type": "huggingface_dataset", "source_uri": "https://example.test/books",
    }
    assert [s["shard_sequence"] for s in found["run-1"]["shards"]] == [1, 2]
    assert found["run-1"]["total_stored_bytes"] == 200 and found["run-1"]["completed_at"] is None
    assert found["run-2"]["shards"] == [] and found["run-2"]["total_shards"] == 0
