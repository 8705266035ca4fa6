"""Packing, token files, archives and shards, against plain Python on small tables."""

import hashlib
import itertools
from base64 import b32encode
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm import bin_completion, encoding, splitters, token_files, warc

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "a", "The cat.", "The cat.", "two  spaces\n\nand lines \n", "Zoë said: 1,234.5 <|endoftext|>",
    "x᠎y z  w", "word " * 3000 + "end.", "﻿mark", "日本語 テキスト。 again, again.",
]
SCHEMA = "doc_id long, text string, id string, length int, __row string"


def table(spark, texts=TEXTS):
    rows = [(None if k == 3 else k, t, "x", 1, "y") for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4]] if len(rows) > 4 else rows, SCHEMA)


def ids_of(text, end):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return crc32(np.array(ids, "<u4").tobytes())


def test_pieces_encode_like_whole_texts():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", ".", ",", "12", "😀", "\x1c", "\x85", "\r\n", "the", " ", "\x00", "ing"]
    random = np.random.default_rng(1)
    texts = ["".join(random.choice(parts, random.integers(0, 25))) for _ in range(4000)]
    found = encoding.PieceEncoder(VOCABULARY).encode(texts)
    expected = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in found] == [x.ids for x in expected]


def test_encoder_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(encoding, "CACHED_PIECES", 3)
    own = encoding.PieceEncoder(VOCABULARY)
    for text in ("one two three four five", "four five six", "one two"):
        assert own.encode([text])[0].tolist() == ids_of(text, 0)[:-1]


def test_token_files_hold_every_document_in_order(spark, folder):
    docs = table(spark)
    parts = token_files.write_token_files(docs, folder, VOCABULARY, 2, "doc_id", "text")
    found = [tuple(r) for r in token_files.read_token_files(spark, parts, folder).collect()]
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    expected, start = [], 0
    for key, text in rows:
        ids = ids_of(text, 2)
        expected.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(found, key=lambda r: r[1]) == expected
    none = token_files.write_token_files(docs.limit(0), folder + "/none", VOCABULARY, 2, "doc_id", "text")
    assert token_files.read_token_files(spark, none, folder + "/none").count() == 0


@pytest.mark.parametrize("rows_together", [2, 100_000])
def test_packing_places_every_piece_once(spark, monkeypatch, rows_together):
    monkeypatch.setattr(bin_completion, "NUMBERED_ROWS", rows_together)
    docs = table(spark)
    pieces = bin_completion.token_pieces(docs, VOCABULARY, 0, 64, "doc_id", "text")
    found = [r.asDict() for r in bin_completion.pack(pieces, 64).collect()]
    expected = []
    for r in docs.collect():
        ids, at = ids_of(r["text"], 0), 0
        first = len(ids) % 64 or 64
        for k, size in enumerate([first, *[64] * ((len(ids) - first) // 64)]):
            expected.append((r["doc_id"], k, at, size, crc(ids[at : at + size])))
            at += size
    names = ("id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(str, [tuple(r[n] for n in names) for r in found])) == sorted(map(str, expected))
    for _, own in itertools.groupby(sorted(found, key=lambda r: (r["sequence_id"], r["offset"])), lambda r: r["sequence_id"]):
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    assert bin_completion.pack(pieces.limit(0), 64).count() == 0


def fewest(lengths, capacity):
    """The optimum by trying every bin for each item."""
    best = [len(lengths)]

    def put(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(bins)
            return
        for b in sorted(set(bins)):
            if b + lengths[k] <= capacity:
                other = list(bins)
                other[other.index(b)] += lengths[k]
                put(k + 1, other)
        put(k + 1, [*bins, lengths[k]])

    put(0, [])
    return best[0]


def test_plans_are_valid_and_near_the_optimum():
    random = np.random.default_rng(2)
    wasted = 0
    for _ in range(60):
        lengths = sorted(random.integers(1, 21, random.integers(1, 10)).tolist(), reverse=True)
        counts = {x: lengths.count(x) for x in lengths}
        plan = bin_completion.completion_plan(counts, 20)
        used = {}
        for times, items in plan:
            assert sum(x * n for x, n in items) <= 20
            for x, n in items:
                used[x] = used.get(x, 0) + times * n
        assert used == counts
        best = fewest(lengths, 20)
        assert bin_completion.lower_bound(counts, 20) <= best
        wasted += sum(t for t, _ in plan) - best
    assert wasted <= 2


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, row long")


def test_archive_round_trip(spark, folder):
    rows = [(1, "u1", "same"), (7, "u\r\n7", "same"), (3, None, "same"), (4, "u4", None), (9, "u9", ""), (5, "u5", "é" * 9), (5, "u5", "é" * 9), (None, "n", "alone")]
    warc.write_archive(pages(spark, [(*r, "x", 0) for r in rows]), folder + "/a")
    found = warc.read_index(spark, folder + "/a").collect()
    assert len(found) == len(rows)
    first = {}
    for page, _, html in rows:
        first[html or ""] = max(first.get(html or "", -1), -1 if page is None else page)
    payload = {(p, (h or "").encode()) for p, _, h in rows}
    digests = {b32encode(hashlib.sha1(b).digest()).decode(): b for _, b in payload}
    responses = set()
    for r in found:
        body = digests[r["payload_digest"]]
        assert (r["page_id"], body) in payload and r["payload_bytes"] == len(body)
        if r["record_type"] == "response":
            assert r["refers_to"] is None and body not in responses
            assert (r["page_id"] if r["page_id"] is not None else -1) == first[body.decode()]
            responses.add(body)
        else:
            assert r["refers_to"] == first[body.decode()]
    assert responses == {b for _, b in payload}
    files = warc.export_warc(spark, folder + "/a", folder + "/out").collect()
    text = b"".join(open(f"{folder}/out/{f['file']}", "rb").read() for f in sorted(files))
    assert text.count(b"WARC/1.1\r\n") == len(rows) and sum(f["bytes"] for f in files) == len(text)


def test_small_payloads_are_not_shared(spark, folder):
    warc.write_archive(pages(spark, [(1, "a", "xy", "", 0), (2, "b", "xy", "", 0)]), folder + "/a", min_bytes=3)
    assert {r["record_type"] for r in warc.read_index(spark, folder + "/a").collect()} == {"response"}
    warc.write_archive(pages(spark, []), folder + "/none")
    assert warc.read_index(spark, folder + "/none").count() == 0


def test_damaged_payload_is_noticed(spark, folder):
    warc.write_archive(pages(spark, [(1, "a", "xy", "", 0)]), folder + "/a")
    stored = spark.read.parquet(folder + "/a/payloads").withColumn("payload", F.lit(b"zz"))
    stored.write.parquet(folder + "/b/payloads")
    spark.read.parquet(folder + "/a/headers").write.parquet(folder + "/b/headers")
    with pytest.raises(Exception, match="does not match"):
        warc.read_index(spark, folder + "/b").collect()


def test_torn_and_missing_records_are_noticed(spark, folder):
    warc.write_archive(pages(spark, [(1, "a", "xy", "", 0), (2, "b", "xy", "", 0), (3, "c", "z\r\n\r\nz", "", 0)]), folder + "/a")
    records = warc.read_archive(spark, folder + "/a")
    assert sorted(r["bytes"] for r in warc.parse_records(records).collect()) == [0, 2, 6]
    torn = records.withColumn("record", F.expr("substring(record, 1, octet_length(record) - 1)"))
    with pytest.raises(Exception, match="length is not"):
        warc.parse_records(torn).collect()
    spark.read.parquet(folder + "/a/payloads").write.parquet(folder + "/c/payloads")
    spark.read.parquet(folder + "/a/headers").where(~F.col("header").contains("page:2:")).write.parquet(folder + "/c/headers")
    assert warc.read_index(spark, folder + "/c").count() == 1
    bare = spark.read.parquet(folder + "/a/headers").where(~F.col("header").contains("-ID: <urn:page:2:"))
    bare.write.parquet(folder + "/d/headers")
    spark.read.parquet(folder + "/a/payloads").write.parquet(folder + "/d/payloads")
    with pytest.raises(Exception, match="response is missing"):
        warc.read_index(spark, folder + "/d").collect()


@pytest.mark.parametrize("range_rows", [3, 200_000])
def test_shards_are_whole_gapless_and_even(spark, range_rows):
    texts = [*TEXTS[:9], *["copy of one text"] * 150, *[f"text {k} " * (k % 9) for k in range(120)]]
    docs = table(spark, texts)
    found = splitters.shard_by_bytes(docs, 7, "doc_id", "text", range_rows).collect()
    rows = docs.collect()
    expected = [(r["doc_id"], len((r["text"] or "").encode()) + 16, crc32((r["text"] or "").encode())) for r in rows]
    assert sorted(map(str, [tuple(r)[:3] for r in found])) == sorted(map(str, expected))
    sizes = dict.fromkeys(range(7), 0)
    for shard, own in itertools.groupby(sorted(found, key=lambda r: (r["shard"], r["slot"])), lambda r: r["shard"]):
        own = list(own)
        assert [r["slot"] for r in own] == list(range(len(own)))
        sizes[shard] = sum(r["size"] for r in own)
    largest = max(e[1] for e in expected)
    assert all(abs(s - sum(sizes.values()) / 7) <= largest for s in sizes.values())
    assert splitters.shard_by_bytes(docs.limit(0), 7, "doc_id", "text").count() == 0
