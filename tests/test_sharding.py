import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import quota, sharding
from corpusmill.operators.prefix import running_totals
from corpusmill.plans.staging import stage
from corpusmill.sources import shards as shard_files

SIZED = "source_id string, pos bigint, size bigint"


def greedy(rows, target):
    """Shard number of each record, cut one record after the other."""
    numbers, size, number = {}, 0, 1
    for pos, n in rows:
        numbers[pos] = number
        size += n
        if size >= target:
            size, number = 0, number + 1
    return numbers


def random_sources(seed, sources=4, longest=400, largest=30):
    rng = random.Random(seed)
    made = {}
    for s in range(sources):
        positions = sorted(rng.sample(range(100_000), rng.randint(1, longest)))
        made[f"s{s}"] = [(p, rng.randint(1, largest)) for p in positions]
    return made


def table(spark, sources):
    rows = [(s, p, n) for s, records in sources.items() for p, n in records]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SIZED)


@pytest.mark.parametrize("bits", [2, 5, 12])
def test_running_totals_do_not_depend_on_the_block_size(spark, bits):
    sources = random_sources(3)
    rows = running_totals(
        table(spark, sources), ["source_id"], "pos", {"total": F.col("size")}, bits=bits
    ).collect()
    for name, records in sources.items():
        found = {r["pos"]: r["total"] for r in rows if r["source_id"] == name}
        total = 0
        for pos, n in records:
            total += n
            assert found[pos] == total


def test_quota_is_a_prefix_and_never_skips(spark):
    sources = {"a": [(1, 5), (2, 9), (3, 1)], "b": [(7, 4), (9, 4), (11, 4)]}
    sized = table(spark, sources)
    kept = {(r["source_id"], r["pos"]) for r in quota.quota_prefix(sized, 10, bits=1).collect()}
    assert kept == {("a", 1), ("b", 7), ("b", 9)}
    limits = spark.createDataFrame([("a", 14), ("b", 3)], "source_id string, limit_bytes bigint")
    kept = {(r["source_id"], r["pos"]) for r in quota.quota_prefix(sized, limits).collect()}
    assert kept == {("a", 1), ("a", 2)}
    kept = quota.quota_prefix(sized, 100, max_records=1).collect()
    assert {(r["source_id"], r["pos"]) for r in kept} == {("a", 1), ("b", 7)}


def test_resume(spark):
    sized = table(spark, {"a": [(1, 5), (2, 9)], "b": [(7, 4)]})
    cursors = spark.createDataFrame([("a", 1)], "source_id string, cursor bigint")
    left = quota.resume_after(sized, cursors).collect()
    assert {(r["source_id"], r["pos"]) for r in left} == {("a", 2), ("b", 7)}
    files = spark.createDataFrame(
        [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1)], "file_index int, record_index bigint"
    )
    left = quota.resume_after_file(files, 1, 1).collect()
    assert {tuple(r) for r in left} == {(1, 2), (2, 1)}


@pytest.mark.parametrize(
    "seed,target,leaf_rows,fan_in",
    [(1, 50, 1 << 20, 16), (2, 50, 7, 2), (3, 200, 5, 3), (4, 1, 3, 2), (5, 3000, 4, 2), (6, 90, 64, 4)],
)
def test_shards_equal_the_greedy_cut(spark, seed, target, leaf_rows, fan_in):
    sources = random_sources(seed)
    sized = table(spark, sources)
    cut = sharding.shard_assign(sized, target, leaf_rows=leaf_rows, fan_in=fan_in, bits=6).collect()
    borders = sharding.shard_borders(sized, target, leaf_rows=leaf_rows, fan_in=fan_in).collect()
    for name, records in sources.items():
        expected = greedy(records, target)
        assert {r["pos"]: r["shard_sequence"] for r in cut if r["source_id"] == name} == expected
        mine = sorted((r for r in borders if r["source_id"] == name), key=lambda r: r["shard_sequence"])
        for border in mine:
            held = [(p, n) for p, n in records if expected[p] == border["shard_sequence"]]
            assert border["size_bytes"] == sum(n for _, n in held)
            assert border["record_count"] == len(held)
            assert border["last_pos"] == held[-1][0]
        assert len(mine) == max(expected.values())


@pytest.mark.parametrize("searched", [True, False])
def test_tagging_matches_the_assignment(spark, monkeypatch, searched):
    if not searched:
        monkeypatch.setattr(sharding, "SEARCHED_SHARDS", -1)
    sources = random_sources(11)
    sized = table(spark, sources)
    kept = stage(quota.quota_prefix(sized, 2500), "kept")
    borders = stage(sharding.shard_borders(kept, 70), "borders")
    tagged = sharding.tag_shards(sized, borders).collect()
    expected = sharding.shard_assign(kept, 70).collect()
    assert {(r["source_id"], r["pos"], r["shard_sequence"]) for r in tagged} == {
        (r["source_id"], r["pos"], r["shard_sequence"]) for r in expected
    }


def test_four_lines_make_two_shards(spark, folder):
    lines = [b"one", b"two", b"three", b"four"]
    records = spark.createDataFrame(
        [("local", i + 1, bytearray(p)) for i, p in enumerate(lines)],
        "source_id string, pos bigint, payload binary",
    )
    sized = quota.sized_records(records, "source_id", "pos", F.col("payload"))
    borders = stage(sharding.shard_borders(sized, 8, 20), "borders")
    tagged = sharding.tag_shards(records, borders)
    rows = shard_files.shard_stats(tagged, F.col("payload")).orderBy("shard_sequence").collect()
    assert [(r["size_bytes"], r["record_count"]) for r in rows] == [(8, 2), (11, 2)]
    assert rows[0]["checksum"] == hashlib.sha256(b"one\ntwo\n").hexdigest()
    key = F.format_string("local/shard-%06d.txt", "shard_sequence")
    written = stage(shard_files.write_shards(tagged, F.col("payload"), key, folder), "written")
    assert open(f"{folder}/local/shard-000002.txt", "rb").read() == b"three\nfour\n"
    shard_files.require_verified(written)
    listing = shard_files.list_objects(spark, folder)
    assert shard_files.verify_written(written, listing).count() == 0
    short = listing.withColumn("length", F.col("length") - 1)
    assert shard_files.verify_written(written, short).count() == 2
    assert shard_files.verify_written(written, listing.limit(0)).count() == 2


def test_shards_of_many_batches_are_hashed_as_one(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        records = spark.range(1, 500).selectExpr(
            "concat('s', id % 3) AS source_id", "id AS pos", "concat('row ', id, repeat('é', id % 5)) AS payload"
        )
        sized = quota.sized_records(records, "source_id", "pos", F.col("payload"))
        borders = stage(sharding.shard_borders(sized, 700), "borders")
        stats = shard_files.shard_stats(sharding.tag_shards(records, borders), F.col("payload"), 3)
        found = {(r["source_id"], r["shard_sequence"]): r for r in stats.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = records.orderBy("pos").collect()
    for s in ("s0", "s1", "s2"):
        mine = [(r["pos"], (r["payload"] + "\n").encode()) for r in rows if r["source_id"] == s]
        numbers = greedy([(p, len(b)) for p, b in mine], 700)
        for number in set(numbers.values()):
            body = b"".join(b for p, b in mine if numbers[p] == number)
            assert found[s, number]["checksum"] == hashlib.sha256(body).hexdigest()
            assert found[s, number]["size_bytes"] == len(body)


def test_oversize_records(spark):
    sized = table(spark, {"a": [(1, 30), (2, 5)], "b": [(1, 5), (2, 30)]})
    found = sharding.oversize_records(sized, 20).collect()
    assert [(r["source_id"], r["pos"]) for r in found] == [("a", 1)]
    found = sharding.oversize_records(sized, 20, strict=True).collect()
    assert {(r["source_id"], r["pos"]) for r in found} == {("a", 1), ("b", 2)}


def test_bounds(spark):
    for target, maximum in ((0, 5), (6, 5), (-1, 5)):
        with pytest.raises(ValueError, match="shard sizes"):
            sharding.check_bounds(target, maximum)


def test_join_and_search_agree_on_borders_of_a_later_wave(spark, monkeypatch):
    sources = random_sources(12)
    sized = table(spark, sources)
    # A second source whose positions lie far apart must not widen the blocks of the first.
    far = sized.select(
        F.concat(F.lit("far-"), "source_id").alias("source_id"),
        *[(F.col(c) * 1_000_003).alias(c) if c == "pos" else c for c in sized.columns if c != "source_id"],
    )
    sized = stage(sized.unionByName(far), "sized")
    every = stage(sharding.shard_borders(sized, 70), "borders")
    for first in (1, 3):
        borders = stage(every.where(F.col("shard_sequence") >= first), "later")
        found = []
        for limit in (sharding.SEARCHED_SHARDS, -1):
            monkeypatch.setattr(sharding, "SEARCHED_SHARDS", limit)
            rows = sharding.tag_shards(sized, borders).select("source_id", "pos", "shard_sequence")
            found.append(sorted(map(tuple, rows.collect())))
        monkeypatch.undo()
        assert found[0] == found[1] and found[0]
