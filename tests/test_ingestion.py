import json
import os

import pytest
from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.plans.ingestion import Settings, cursor_of, position_of, recover, run_ingestion
from corpusmill.plans.tables import ControlTables
from corpusmill.streaming.ingest import ShardCommitter, run_until_paused
from corpusmill.streaming.lifecycle import lifecycle_stream


def registry(spark, *sources):
    rows = [
        (i, name, kind, url, "test", "https://example.test/license", quota, None, None, "train", True, "")
        for i, (name, kind, url, quota) in enumerate(sources)
    ]
    return spark.createDataFrame(rows, schemas.REGISTRY)


def four_lines(folder):
    path = f"{folder}/source.txt"
    with open(path, "wb") as handle:
        handle.write(b"one\ntwo\nthree\nfour\n")
    return path


def setup(spark, folder, **more):
    tables = ControlTables(spark, f"{folder}/control")
    return tables, Settings(f"{folder}/objects", target_bytes=8, maximum_bytes=20, **more)


def state(tables, name):
    return tables.sources().where(F.col("source_id") == name).first()


def test_lines_are_stored_as_verified_shards(spark, folder):
    tables, settings = setup(spark, folder)
    sources = registry(spark, ("local", "filesystem", four_lines(folder), 100))
    assert run_ingestion(tables, sources, settings) == {"local": "COMPLETED"}
    row = state(tables, "local")
    assert (row["status"], row["completed_shard_count"], row["verified_bytes"]) == ("COMPLETED", 2, 19)
    assert json.loads(row["checkpoint"]) == {"byte_offset": 19}
    stored = tables.read("shards").orderBy("shard_sequence").collect()
    bodies = [open(f"{folder}/objects/raw/{r['object_key']}", "rb").read() for r in stored]
    assert bodies == [b"one\ntwo\n", b"three\nfour\n"]
    manifests = [os.path.join(d, f) for d, _, fs in os.walk(f"{folder}/objects") for f in fs if f == "manifest.json"]
    body = json.load(open(manifests[0]))
    assert [s["stored_size_bytes"] for s in body["shards"]] == [8, 11]
    assert run_ingestion(tables, sources, settings) == {"local": "COMPLETED"}
    assert state(tables, "local")["completed_shard_count"] == 2
    os.remove(f"{folder}/objects/raw/{stored[0]['object_key']}")
    violations = recover(tables, settings).collect()
    assert [(r["source_id"], r["from_status"]) for r in violations] == [("local", "COMPLETED")]
    gone = Settings(f"{folder}/elsewhere", target_bytes=8, maximum_bytes=20)
    assert [r["source_id"] for r in recover(tables, gone).collect()] == ["local"]


@pytest.mark.parametrize("quota,verified,count", [(100, 19, 2), (15, 14, 2)])
def test_pause_then_resume(spark, folder, quota, verified, count):
    tables, settings = setup(spark, folder, shards_per_wave=1)
    path = four_lines(folder)
    sources = registry(spark, ("local", "filesystem", path, quota), ("later", "filesystem", path, 50))
    assert run_ingestion(tables, sources, settings, pause_requested=lambda: True) == {"local": "PAUSED"}
    row = state(tables, "local")
    assert (row["status"], row["completed_shard_count"], row["verified_bytes"]) == ("PAUSED", 1, 8)
    done = run_ingestion(tables, sources, settings)
    assert done == {"local": "COMPLETED", "later": "COMPLETED"}
    row = state(tables, "local")
    assert (row["completed_shard_count"], row["verified_bytes"]) == (count, verified)
    assert tables.read("runs").where("source_id = 'local'").count() == 1


def test_an_empty_source_fails_and_the_next_one_runs(spark, folder):
    tables, settings = setup(spark, folder)
    open(f"{folder}/empty.txt", "w").close()
    sources = registry(
        spark,
        ("empty", "filesystem", f"{folder}/empty.txt", 100),
        ("local", "filesystem", four_lines(folder), 100),
    )
    done = run_ingestion(tables, sources, settings)
    assert done["empty"].startswith("FAILED: source produced no records")
    assert done["local"] == "COMPLETED"
    assert state(tables, "empty")["status"] == "FAILED"
    assert tables.read("event_log").where("event_type = 'source_failed'").count() == 1
    with open(f"{folder}/empty.txt", "w") as handle:
        handle.write("now\n")
    assert run_ingestion(tables, sources, settings, "empty") == {"empty": "COMPLETED"}


def test_datasets_resume_and_oversize_records_fail(spark, folder):
    tables, settings = setup(spark, folder, shards_per_wave=1)
    settings = Settings(settings.store, target_bytes=30, maximum_bytes=60, shards_per_wave=1)
    rows = spark.createDataFrame([(t,) for t in ("zero", "one", "two", "three")], "text string")
    rows.coalesce(1).write.parquet(f"{folder}/d")
    spark.createDataFrame([("x" * 100,)], "text string").write.parquet(f"{folder}/big")
    sources = registry(
        spark,
        ("d", "huggingface_dataset", f"{folder}/d", 1000),
        ("big", "huggingface_dataset", f"{folder}/big", 1000),
    )
    assert run_ingestion(tables, sources, settings, "d", pause_requested=lambda: True) == {"d": "PAUSED"}
    assert json.loads(state(tables, "d")["checkpoint"]) == {"record_index": 2}
    done = run_ingestion(tables, sources, settings)
    assert done["d"] == "COMPLETED"
    assert "exceeds maximum shard size" in done["big"]
    stored = tables.read("shards").where("source_id = 'd'").orderBy("shard_sequence").collect()
    text = b"".join(open(f"{folder}/objects/raw/{r['object_key']}", "rb").read() for r in stored)
    assert [json.loads(line)["text"] for line in text.splitlines()] == ["zero", "one", "two", "three"]


def test_other_source_types_bring_their_own_reader(spark, folder):
    def numbers(spark, source, settings):
        return spark.range(1, int(source["source_url"]) + 1).select(
            F.lit(source["source_id"]).alias("source_id"),
            F.col("id").alias("pos"),
            F.col("id").cast("string").alias("payload"),
        )

    tables, settings = setup(spark, folder, readers={"numbers": numbers})
    sources = registry(spark, ("n", "numbers", "9", 10))
    assert run_ingestion(tables, sources, settings) == {"n": "COMPLETED"}
    assert state(tables, "n")["verified_bytes"] == 10


def test_cursors_round_trip():
    assert position_of(cursor_of("filesystem", 19)) == 19
    assert position_of(cursor_of("huggingface_dataset", 2)) == 2
    manifest = (5 << 40) + 7
    assert cursor_of("dolma_manifest", manifest) == {"file_index": 5, "record_index": 7}
    assert position_of(cursor_of("dolma_manifest", manifest)) == manifest
    assert position_of({}) == 0


def committer(spark, folder, pause=None):
    return ShardCommitter(
        spark, f"{folder}/objects", f"{folder}/committed", "run1", "v1", "2025-02-03", 50, pause
    )


def batch(spark, low, high):
    return spark.range(low, high).selectExpr(
        "concat('s', id % 2) AS source_id", "id AS pos", "concat('row ', id) AS payload"
    )


def test_a_replayed_batch_counts_once(spark, folder):
    commit = committer(spark, folder)
    commit(batch(spark, 0, 40), 0)
    once = sorted(map(tuple, commit.committed().collect()))
    commit(batch(spark, 0, 40), 0)
    assert sorted(map(tuple, commit.committed().collect())) == once
    commit(batch(spark, 40, 60), 1)
    commit(batch(spark, 0, 40), 0)
    rows = commit.committed().collect()
    assert sum(r["record_count"] for r in rows) == 60
    assert len({r["shard_id"] for r in rows}) == len(rows)
    for source in ("s0", "s1"):
        mine = sorted(r["shard_sequence"] for r in rows if r["source_id"] == source)
        assert mine == list(range(1, len(mine) + 1))


def test_a_paused_stream_goes_on_where_it_stopped(spark, folder):
    for i in range(3):
        batch(spark, i * 20, i * 20 + 20).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    schema = batch(spark, 0, 1).schema
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    answers = iter([False, True])
    commit = committer(spark, folder, lambda: next(answers, False))
    assert run_until_paused(files, commit, f"{folder}/progress")
    assert sum(r["record_count"] for r in commit.committed().collect()) == 20
    assert not run_until_paused(files, commit, f"{folder}/progress")
    assert sum(r["record_count"] for r in commit.committed().collect()) == 60


def test_lifecycle_stream_keeps_state_between_batches(spark, folder):
    batches = [
        [("a", 2, "COMPLETED"), ("a", 1, "RUNNING"), ("b", 3, "PAUSED")],
        [("a", 4, "RUNNING"), ("b", 5, "RUNNING"), ("b", 6, "RUNNING")],
    ]
    schema = "id string, seq bigint, status string"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = (
            lifecycle_stream(stream)
            .writeStream.format("parquet")
            .option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/progress")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    found = {(r["id"], r["seq"]): (r["from_status"], r["accepted"]) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert found == {
        ("a", 1): ("PENDING", True),
        ("a", 2): ("RUNNING", True),
        ("a", 4): ("COMPLETED", False),
        ("b", 3): ("PENDING", False),
        ("b", 5): ("PENDING", True),
        ("b", 6): ("RUNNING", True),
    }


def test_what_lies_behind_the_quota_is_not_looked_at(spark, folder):
    tables, settings = setup(spark, folder)
    settings = Settings(settings.store, target_bytes=30, maximum_bytes=60)
    for i, texts in enumerate((["zero", "one"], ["two", None])):
        spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.parquet(f"{folder}/d/part={i}")
    size = sum(len(json.dumps({"text": t})) + 1 for t in ("zero", "one", "two"))
    sources = registry(
        spark,
        ("cut", "huggingface_dataset", f"{folder}/d", size - 1),
        ("broken", "huggingface_dataset", f"{folder}/d", size + 100),
    )
    done = run_ingestion(tables, sources, settings)
    assert done["cut"] == "COMPLETED" and "no text" in done["broken"]
    assert state(tables, "cut")["verified_bytes"] == size - len(json.dumps({"text": "two"})) - 1


def test_a_dataset_without_the_configured_part_fails(spark, folder):
    tables, settings = setup(spark, folder)
    settings = Settings(settings.store, target_bytes=30, maximum_bytes=60)
    spark.createDataFrame([("a", "train"), ("b", "test")], "text string, split string").write.parquet(f"{folder}/d")
    spark.createDataFrame([("a",)], "text string").write.parquet(f"{folder}/e")
    sources = registry(spark, ("d", "huggingface_dataset", f"{folder}/d", 100), ("e", "huggingface_dataset", f"{folder}/e", 100))
    sources = sources.withColumn("split", F.when(F.col("source_id") == "e", "test").otherwise("test"))
    done = run_ingestion(tables, sources, settings)
    assert done["d"] == "COMPLETED" and "no column split" in done["e"]
    stored = tables.read("shards").where("source_id = 'd'").collect()
    assert [r["record_count"] for r in stored] == [1]
