"""Toxicity and language-model scores: held-out quality, base scores and odd rows."""

import math
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import context_mixing, queries, toxicity

SMALL = "/root/testdata/sf0.01"


def test_chain_finds_held_out_toxic_documents(spark):
    docs = queries.read(spark, SMALL, "documents").select("doc_id", "text")
    labels = queries.read(spark, SMALL, "labels")
    held = (F.col("doc_id") % 4 == 0) & F.col("toxic").isNotNull()
    models = toxicity.train(docs, labels.where(~held), toxicity.categories(), "doc_id", "text")
    names = list(toxicity.categories())
    scored = toxicity.score(docs, models, names, "text").join(labels.where(held), "doc_id").collect()
    right = sum((r["p_toxic"] >= 0.5) == (r["toxic"] == 1) for r in scored)
    assert right >= 0.95 * len(scored)


def test_chain_on_odd_rows(spark):
    rows = [(k, "bad awful text" if k % 2 else "kind gentle text", "x") for k in range(40)]
    rows += [(None, "bad awful", "x"), (100, None, "x"), (101, "", "x"), (3, rows[3][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p string")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(30)] + [(None, 0, 1), (31, None, 1), (32, 1, None)], "doc_id long, quality int, toxic int")
    scored = queries.toxicity_scores(spark, docs, labels)
    assert scored.columns[:3] == docs.columns and scored.count() == len(rows)
    found = [(r["doc_id"], r["is_toxic"]) for r in scored.collect()]
    assert all(t == (k % 2 == 1) for k, t in found if k is not None and k < 100)
    assert not dict(found)[100] and not dict(found)[101]
    none = queries.toxicity_scores(spark, docs, labels.limit(0))
    assert none.where("is_toxic").count() == 0
    assert queries.toxicity_scores(spark, docs.limit(0), labels).count() == 0


def test_scores_and_base(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "HEAD_SHARE", 64)
    texts = [None, "", " \n", "The the THE cat", "É é zebra", *[f"the cat sat on mat {k % 5}" for k in range(60)], "long " * 3000]
    rows = [(None if k == 4 else k, t, "x") for k, t in enumerate(texts)]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = context_mixing.score(docs, "doc_id", "text").collect()
    words = [(t or "").encode().lower().split() for _, t, _ in rows]
    held = [crc32(str("" if k is None else k).encode()) % 7 == 2 for k, _, _ in rows]
    counts = Counter(w for t, h in zip(words, held, strict=True) if not h for w in [*t, None])
    total, distinct = sum(counts.values()), len(counts)
    expected = [
        (k, h, len(t) + 1, sum(counts[w] > 0 for w in [*t, None]), total,
         sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in [*t, None]))
        for (k, _, _), t, h in zip(rows, words, held, strict=True)
    ]
    order = lambda x: (str(x[0]), x[5])
    for a, b in zip(sorted(expected, key=order), sorted(map(tuple, found), key=order), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9)
        assert b[6] < 0
    assert context_mixing.score(docs.limit(0), "doc_id", "text").count() == 0


def test_model_probabilities_add_up_to_one():
    """Over every text of one or two symbols, with the rest of the mass on longer ones."""
    random = np.random.default_rng(10)
    pairs = random.integers(0, 3, (257, 257)) * (random.random((257, 257)) < 0.05)
    codes = context_mixing.Codes(pairs)
    for a in (0, 65, 256):
        assert math.isclose(sum(0.5 ** int(s) for s in codes.sizes[a * 257 : a * 257 + 257]), 1.0)
    size = 1 << context_mixing.SLOT_BITS
    slots = [(random.integers(0, 4, size), random.integers(0, 4, size)) for _ in context_mixing.ORDERS]
    mixer = context_mixing.Mixer(codes, slots)
    one = 10 ** mixer.log10([b""] + [bytes([x]) for x in range(256)])
    firsts = mixer.log10([bytes([65, x]) for x in range(256)])
    assert one.sum() + (10**firsts).sum() < 1 + 1e-6
    alone = mixer.log10([b"some text", b"other"])
    assert np.allclose(alone, [mixer.log10([b"some text"])[0], mixer.log10([b"other"])[0]], atol=1e-5)


def test_score_beats_the_base_on_held_out_texts(spark):
    found = context_mixing.score(queries.read(spark, "/root/testdata/sf0.1", "documents"), "doc_id", "text")
    held = found.where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held["s"] > held["b"]


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    docs = queries.read(spark, "/root/testdata/sf0.001", "documents")
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, docs, "/root/testdata/sf0.001")
        assert after.columns == docs.columns, name
        assert 0.6 * docs.count() < after.count() <= docs.count()
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, odd, "/root/testdata/sf0.001").count() >= 1
        function(spark, odd.limit(0), "/root/testdata/sf0.001").count()
