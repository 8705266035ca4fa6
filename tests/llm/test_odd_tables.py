"""Columns with clashing names, rows without or with repeated ids, and long runs of characters."""

import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import pii, queries, toxicity

SMALL = "/root/testdata/sf0.001"


@settings(max_examples=400, deadline=None)
@given(st.text("ab1.@-_% +0", max_size=40))
def test_base_spans_are_the_matches_of_the_patterns(text):
    expected = [
        (kind, m.start(), m.end())
        for kind, pattern in pii.PATTERNS.items()
        for m in re.finditer(pattern, text)
        if pii._accepted(kind, m.group())
    ]
    assert pii.base_spans(text) == expected


def test_long_runs_take_linear_time():
    began = time.monotonic()
    for text in ("1" * 300_000 + ". @", "a" * 300_000 + " @ 1.", "1." * 150_000 + "@", "a@" * 150_000 + "1"):
        pii.base_spans(text)
    assert time.monotonic() - began < 20


def _odd(spark, rows, extra):
    fields = ", ".join(f"{n} string" for n in extra)
    return spark.createDataFrame([(k, t, *extra) for k, t in rows], f"doc_id long, text string, {fields}")


EXTRA = ["p_toxic", "is_toxic", "__features", "features", "more", "__key", "text_key", "id", "row", "others", "component"]


def test_stages_keep_columns_whose_names_clash(spark):
    rows = [(k, f"plain words number {k} say nothing at all mail me at a{k}@b.org") for k in range(3)]
    docs = _odd(spark, [*rows, (None, None), (9, "")], EXTRA)
    for name, function in corpus_pipeline.STAGES[:-1]:
        kept = function(spark, docs, SMALL)
        assert kept.schema.simpleString() == docs.schema.simpleString(), name
        for r in kept.collect():
            assert [r[n] for n in EXTRA] == EXTRA, name
    assert function(spark, docs.limit(0), SMALL).count() == 0


def test_scores_replace_columns_of_their_names(spark):
    docs = _odd(spark, [(1, "some text")], ["p_toxic", "p_low_quality", "features"])
    scored = queries.toxicity_scores(spark, docs, queries.read(spark, SMALL, "labels"))
    assert dict(scored.dtypes)["p_toxic"] == "double" and scored.first()["features"] == "features"
    assert toxicity.score(docs.limit(0), [], [], "text").count() == 0


def test_decisions_are_by_row(spark):
    passage = queries.read(spark, SMALL, "benchmark").where(F.length("text") > 100).first()["text"]
    clean = "clean words that no benchmark has " * 3
    rows = [(None, passage), (1, passage), (1, clean), (None, clean + "x"), (2, passage), (2, clean + " y z")]
    left = corpus_pipeline.drop_contaminated(spark, _odd(spark, rows, ["x"]), SMALL)
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in left.collect()])) == sorted(
        map(str, [(k, t) for k, t in rows if t != passage])
    )
    base = " ".join(f"w{k}" for k in range(150))
    other = " ".join(f"v{k}" for k in range(150))
    rows = [(None, base), (None, base), (5, base), (5, base), (4, other), (5, other), (None, "alone in its group")]
    left = corpus_pipeline.keep_one_of_group(spark, _odd(spark, rows, ["x"]), SMALL)
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in left.collect()])) == sorted(
        map(str, [(5, base), (4, other), (None, "alone in its group")])
    )
