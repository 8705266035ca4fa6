"""Packed blocks read back, statuses judged by maps, line streams that go on."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import status_maps
from corpusmill.plans.staging import shared_folder
from corpusmill.schemas import PENDING, STATES, TRANSITIONS
from corpusmill.sources.packed import packed_description, read_packed, store_packed
from corpusmill.streaming.ingest import ShardCommitter, ingest_lines
from corpusmill.streaming.lifecycle import StatusJudge


def test_packed_blocks_are_read_back_and_damage_is_refused(spark, folder):
    rows = [(k, [k * 3 + j for j in range(4)]) for k in range(25)]
    blocks = spark.createDataFrame(rows, "block_id long, ids array<int>")
    stored = store_packed(blocks, f"{folder}/p", "train", 3, 100, blocks_per_file=10)
    assert stored["num_blocks"] == 25 and stored["num_tokens"] == 75
    got = lambda **more: {r["block_id"]: r["ids"] for r in read_packed(spark, f"{folder}/p", "train", **more).collect()}
    assert got() == got(range_blocks=7) == dict(rows)
    assert got(first_block=8, last_block=21, range_blocks=4) == dict(rows[8:21])
    assert got(first_block=25) == got(first_block=9, last_block=9) == {}
    sidecar = f"{folder}/p/train.json"
    for change, message in (
        ({"num_tokens": 74}, "contradicts"), ({"num_blocks": 0, "num_tokens": 0}, "positive"), ({"vocab_size": "9"}, "positive"),
        ({"dtype": "<u2"}, "contradicts"), ({"num_blocks": 24, "num_tokens": 72}, "described are"), ({"vocab_size": 50}, "beyond the vocabulary"),
    ):
        with open(sidecar, "w") as out:
            json.dump(stored | change, out)
        with pytest.raises(Exception, match=message):
            got()
    for body in ("{", "[]", "{}"):
        with open(sidecar, "w") as out:
            out.write(body)
        with pytest.raises(ValueError, match="no sound description"):
            packed_description(spark, f"{folder}/p", "train")
    with open(sidecar, "w") as out:
        json.dump(stored, out)
    with open(f"{folder}/p/train-000002.bin", "ab") as out:
        out.write(b"\0")
    with pytest.raises(ValueError, match="train-000002|file 000002"):
        got()
    os.remove(f"{folder}/p/train-000002.bin")
    with pytest.raises(ValueError, match="000002 has None bytes"):
        got()
    with pytest.raises(ValueError, match="no whole block"):
        store_packed(blocks.limit(0), f"{folder}/q", "train", 3, 100)


def walked(events, states):
    at, found = dict(states), {}
    for key, seq, status in sorted(events):
        before = at.get(key, PENDING)
        accepted = before == status or (before, status) in TRANSITIONS
        found[key, seq, status] = (before, accepted)
        at[key] = status if accepted else before
    return found, at


def test_maps_compose_to_the_walk(spark, monkeypatch):
    random = np.random.default_rng(6)
    ids = ["hot"] * 900 + [f"u{k}" for k in random.integers(0, 20, 100)]
    events = [(i, int(s), STATES[int(e)]) for i, s, e in zip(ids, random.permutation(5000), random.integers(0, 8, 1000))]
    states = {"hot": "PAUSED", "u1": "FAILED", "other": "CANCELLED"}
    monkeypatch.setattr(status_maps, "CHUNK_ROWS", 64)
    monkeypatch.setattr(status_maps, "FAN_BITS", 3)
    rows = spark.createDataFrame(events, "id string, seq long, status string").repartition(5)
    found, after = status_maps.judged(rows, spark.createDataFrame(list(states.items()), "id string, status string"), bits=6)
    wanted, last = walked(events, states)
    assert {(r["id"], r["seq"], r["to_status"]): (r["from_status"], r["accepted"]) for r in found.collect()} == wanted
    assert {r["id"]: r["status"] for r in after.collect()} == last
    # The hot entity's events go to many tasks: no group is larger than a block.
    sizes = rows.groupBy("id", F.shiftright("seq", 6)).count().agg(F.max("count")).first()[0]
    assert sizes <= 64
    with pytest.raises(Exception, match="unknown status"):
        status_maps.judged(spark.createDataFrame([("a", 1, "LOST")], rows.schema), after)[0].collect()


def test_judge_replays_and_keeps_two_states(spark, folder):
    judge = StatusJudge(spark, f"{folder}/j")
    kind = "id string, seq long, status string"
    batches = [[("a", 1, "RUNNING")], [("a", 2, "COMPLETED"), ("b", 3, "PAUSED")], [("a", 4, "RUNNING")], [("b", 5, "RUNNING")]]
    for number, rows in enumerate(batches):
        for _ in range(2):
            judge(spark.createDataFrame(rows, kind), number)
    found, _ = walked([r for b in batches for r in b], {})
    assert {(r["id"], r["seq"], r["to_status"]): (r["from_status"], r["accepted"]) for r in judge.verdicts().collect()} == found
    assert sorted(os.listdir(f"{folder}/j/states")) == ["2", "3"]


def test_line_stream_goes_on_after_the_last_committed_shard(spark, folder):
    bodies = [b"".join(b"line %03d of %d\n" % (k, f) for k in range(40)) for f in range(2)]
    files = [(f, f"{folder}/{f}.txt") for f in range(2)]
    for (_, path), body in zip(files, bodies, strict=True):
        open(path, "wb").write(body)
    asked = iter([False, False, True])

    def committer(pause=None):
        return ShardCommitter(spark, f"{folder}/objects", f"{folder}/committed", "run1", "v1", "2025-02-03", 100, pause, by_position=True)

    staged = lambda: set(os.listdir(f"{shared_folder(spark).removeprefix('file:')}/corpusmill"))
    commit = committer(lambda: next(asked, False))
    spark.range(1).write.mode("overwrite").parquet(f"{shared_folder(spark)}/corpusmill/marker")
    before = staged()
    assert ingest_lines(spark, "s", files, commit, f"{folder}/progress", bytes_per_trigger=300)
    first = sum(r["record_count"] for r in commit.committed().collect())
    assert first == 44 and commit.cursor("s") == (1 << 40) + 4 * 14
    # Another checkpoint: only the committed shards tell where to go on.
    assert not ingest_lines(spark, "s", files, committer(), f"{folder}/other", bytes_per_trigger=500)
    done = commit.committed().orderBy("shard_sequence").collect()
    assert [r["shard_sequence"] for r in done] == list(range(1, len(done) + 1))
    stored = b"".join(open(f"{folder}/objects/{r['object_key']}", "rb").read() for r in done)
    assert stored == b"".join(bodies) and staged() == before
    with open(files[1][1], "ab") as out:
        out.write(b"more\n")
    assert not ingest_lines(spark, "s", files, committer(), f"{folder}/other", bytes_per_trigger=500)
    assert sum(r["record_count"] for r in commit.committed().collect()) == 81
