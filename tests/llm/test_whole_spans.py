"""Base matches as seeds of contexts, and candidates of several tokens."""

from corpusmill.llm import pii


def near(text):
    return [(text[a:b], patterns, kind) for a, b, _, patterns, kind in pii.tokens_in_context(text, pii.base_spans(text))]


def test_whole_matches_are_seeds():
    assert near("please Call +1 (017) 555-7713 now") == [("+1 (017) 555-7713", ["call", "please call"], "phone")]
    assert near("my card 4111 1111 1111 1111, ok") == [("4111 1111 1111 1111", ["card", "my card"], "card")]
    assert near("write to jane@mail.example.com") == [("jane@mail.example.com", ["to", "write to"], "email")]


def test_tokens_of_any_length():
    long, word = "x" * 300 + "1" * 300, "w" * 500
    assert near(f"a {word} {long} b") == [(long, [word, f"a {word}"], None)]
    assert near("room 12 34 56-78, 99 1.2.3.4 5") == [("12 34 56-78", ["room"], None), ("1.2.3.4", ["99", "56-78, 99"], "ip")]


def test_contexts_of_phones_find_other_numbers(spark):
    known = [f"please call +1 (017) 555-7{k}13 today" for k in range(10, 40)]
    texts = [*known, "please call 017 5557 x13 today", "nothing 017 5557 x13b here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["id"]: r for r in pii.personal_data(docs, "doc_id", "text").collect()}
    more = {k: [texts[k][s["start"] : s["end"]] for s in r["more"]] for k, r in found.items() if r["more"]}
    assert more == {30: ["017 5557 x13"]}
