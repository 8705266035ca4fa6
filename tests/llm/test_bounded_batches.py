"""What a task makes of a large Arrow batch is bounded."""

import os
import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline
from corpusmill.functions import slices
from corpusmill.llm import fm_index, pii, queries
from corpusmill.llm.encoding import PieceEncoder


def test_slices_keep_the_rows_and_are_small(monkeypatch):
    monkeypatch.setattr(slices, "SLICE_BYTES", 4000)
    random = np.random.default_rng(6)
    texts = ["x" * int(n) for n in random.integers(0, 900, 300)] + ["y" * 9000, None]
    batch = pa.RecordBatch.from_pydict({"id": list(range(302)), "text": texts, "n": [[k] * 3 for k in range(302)]})
    found = list(slices.slices([batch, batch.slice(0, 0), batch.slice(7, 5)]))
    rows = [r for x in found for r in x.to_pylist()]
    assert rows == batch.to_pylist() + batch.slice(7, 5).to_pylist()
    assert len(found) > 30 and all(x.num_rows == 1 or x.nbytes <= 4000 for x in found)


def test_answers_come_in_slices(spark, monkeypatch):
    """One partition and one batch give the same rows whole and in slices."""
    texts = [f"mail a{k}@b.org or call +44 20 7946 0{k:03d} " + "some more words " * (k % 9) for k in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(k, k % 2, k % 3 // 2) for k in range(200)], "doc_id long, quality int, toxic int")

    def answers():
        yield sorted(map(str, pii.mask(docs, "doc_id", "text").collect()))
        yield sorted(map(str, queries.toxicity_scores(spark, docs, labels).collect()))
        yield sorted(map(str, queries.packed(docs).collect()))

    whole = list(answers())
    monkeypatch.setattr(slices, "SLICE_BYTES", 1500)
    assert list(answers()) == whole


def test_a_shard_of_words_is_small(spark, tmp_path, monkeypatch):
    """Words wait for the index as 32-bit numbers, not as an object each."""
    held = {}

    def seen(ids, texts, numbers, folder, size):
        held["bytes"] = tracemalloc.get_traced_memory()[0] - before
        return iter([(1, 0, 0, [], [])])

    monkeypatch.setattr(fm_index, "_shard", seen)
    caught = []
    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", lambda self, f, schema: caught.append(f))
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    monkeypatch.setattr(fm_index, "new_path", lambda *a: os.path.join(tmp_path, "items"))
    fm_index.benchmark_hits(docs, spark.createDataFrame([("a", "b")], "item_id string, text string"))
    words = fm_index.SHARD_WORDS - 2
    batch = pa.RecordBatch.from_pydict({"id": [1], "text": ["one two three " * (words // 3)]})
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        list(caught[0](iter([batch])))
    finally:
        tracemalloc.stop()
    assert held["bytes"] < 8 * words


def test_the_pipeline_keeps_fewer_pieces():
    small = PieceEncoder(queries.vocabulary(), True, 100)
    large = PieceEncoder(queries.vocabulary(), True)
    for k in range(20):
        texts = [" ".join(f"w{k}x{n}" for n in range(40)), "again and again"]
        for a, b in zip(small.encode(texts), large.encode(texts), strict=True):
            assert a.tolist() == b.tolist()
        assert small._known.size < 200
    assert large._known.size > 400 and corpus_pipeline.CACHED_PIECES < 1 << 19
