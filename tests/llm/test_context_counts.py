"""Counts of contexts, against plain Python."""

from collections import Counter

import numpy as np

from corpusmill.llm import context_mixing


def test_contexts_are_not_added_together():
    """What the mixer reads is what the corpus has, however many contexts there are."""
    random = np.random.default_rng(4)
    texts = ["".join(random.choice(list("abcdefgh "), 60)) for _ in range(300)]
    rows = [b" ".join(t.encode().split()) for t in texts]
    codes = context_mixing.Codes(np.ones((257, 257), np.int64))
    batch = context_mixing._Batch(rows)


    def contexts(text, k):
        return (text[max(0, k - 5) : k], min(k, 5)), (text[:k].split(b" ")[-1], text[k - 1] if k else 256)

    expected = [Counter(), Counter()]
    names = [[], []]
    for text in rows:
        for k in range(len(text) + 1):
            for kind, name in enumerate(contexts(text, k)):
                names[kind].append((name, text[k] if k < len(text) else 256))
                expected[kind][names[kind][-1]] += 1
    answers = []
    for kind, pairs in enumerate(batch.contexts()):
        # Equal keys stand for equal contexts and symbols, and the other way round.
        assert len(set(zip(pairs.tolist(), names[kind], strict=True))) == len(set(pairs.tolist())) == len(expected[kind])
        known, n = np.unique(pairs, return_counts=True)
        heads, sizes = np.unique(known >> np.uint64(9), return_counts=True)
        answers.append((sizes, (known & np.uint64(511)).astype(np.int32), n))
    own = context_mixing.Contexts(rows, codes)
    counts = own.learn(answers)
    _, path, slots = own.decisions(slice(0, len(own.pair)))
    for kind, (slot, (zero, one)) in enumerate(zip(slots, counts, strict=True)):
        totals = Counter(name for name, _ in names[kind])
        first = np.concatenate([[0], np.cumsum(codes.sizes[own.pair])[:-1]])
        assert [int(zero[s] + one[s]) for s in slot[first]] == [totals[name] for name, _ in names[kind]]


def test_table_grows_with_the_corpus(spark, monkeypatch):
    """Scores don't depend on how the table and the texts are cut into parts and blocks."""
    random = np.random.default_rng(5)
    rows = [(k, "".join(random.choice(list("abcde "), 200))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    one = {r["id"]: r["score"] for r in context_mixing.score(docs, "doc_id", "text").collect()}
    for name, value in (("TABLE_TOKENS", 100), ("BATCH_BYTES", 4000), ("BLOCK_BYTES", 3000), ("PAIRS_HELD", 500)):
        monkeypatch.setattr(context_mixing, name, value)
    two = {r["id"]: r["score"] for r in context_mixing.score(docs, "doc_id", "text").collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-3 for k in one)


def test_blocks_of_a_group_ask_once(monkeypatch):
    """Contexts that several blocks share are asked for, and so shuffled, once."""
    import pyarrow as pa

    class Task:
        get = classmethod(lambda cls: cls())
        partitionId = lambda self: 3

    monkeypatch.setattr(context_mixing, "TaskContext", Task)
    monkeypatch.setattr(context_mixing, "BLOCK_BYTES", 2000)
    texts = ["the same words in every text of the batch " * 10] * 40
    batch = pa.RecordBatch.from_pydict({"row": list(range(40)), "id": list(range(40)), "held_out": [False] * 40, "text": texts})
    asked = [[], []]
    for _, kind, block, keys, _ in context_mixing._rows_of(context_mixing._questions(iter([batch]), 4)):
        if kind == context_mixing.ASKED:
            asked[0].append(block)
            asked[1] += np.cumsum(context_mixing._unpacked(keys, np.uint64), dtype=np.uint64).tolist()
    groups = len(set(asked[0]))
    known = [np.unique(x >> np.uint64(9)) for x in context_mixing._Batch([" ".join(t.split()).encode() for t in texts]).contexts()]
    assert groups <= 2 and len(asked[1]) == groups * sum(map(len, known))


def test_texts_and_contexts_travel_once(spark, monkeypatch):
    """Answers repeat neither contexts nor texts, so less is shuffled than is asked."""
    import pyarrow as pa

    random = np.random.default_rng(6)
    texts = ["".join(random.choice(list("abcdefgh "), 300)) for _ in range(50)]
    batch = pa.RecordBatch.from_pydict({"row": list(range(50)), "id": list(range(50)), "held_out": [False] * 50, "text": texts})

    class Task:
        get = classmethod(lambda cls: cls())
        partitionId = lambda self: 2

    monkeypatch.setattr(context_mixing, "TaskContext", Task)
    learnt = list(context_mixing._pair_counts(iter([batch.select(["text"])]), 4))
    asked = list(context_mixing._questions(iter([batch]), 4))
    rows = sorted(context_mixing._rows_of(learnt + asked), key=lambda r: r[:2])
    found = list(context_mixing._rows_of(context_mixing._answers(context_mixing._route(*r) for r in rows)))
    assert {r[1] for r in found} == {context_mixing.ASKED}
    size = lambda rows: sum(len(r[3]) + len(r[4]) for r in rows if r[1] == context_mixing.ASKED)
    assert size(found) < size(rows)
    # They still are the counts of every context, in the order of the question.
    codes = context_mixing.Codes(np.ones((257, 257), np.int64))
    held = [r[3] for r in rows if r[1] == context_mixing.TEXTS]
    scores = [s for _, _, block in context_mixing._scored(held, {r[0]: r[3] for r in found}, 4, codes) for s in block]
    own = context_mixing.Contexts([" ".join(t.split()).encode() for t in texts], codes)
    answers = []
    for pairs in context_mixing._Batch([" ".join(t.split()).encode() for t in texts]).contexts():
        known, n = np.unique(pairs, return_counts=True)
        heads, sizes = np.unique(known >> np.uint64(9), return_counts=True)
        answers.append((sizes, (known & np.uint64(511)).astype(np.int32), n))
    plain = context_mixing.Mixer(codes, own.learn(answers)).log10([" ".join(t.split()).encode() for t in texts], own)
    assert np.allclose(scores, plain)


def test_contexts_are_counted_by_word():
    """Counts taken from distinct words are those of every symbol, at the borders of texts as well."""
    random = np.random.default_rng(7)
    texts = ["".join(random.choice(list("abé "), k % 40)) for k in range(120)] + ["", "a", "a a", "a"]
    texts = [b" ".join(t.encode().split()) for t in texts]
    for some in (texts, texts[-1:], texts[-4:-3]):
        batch = context_mixing._Batch(some)
        for pairs, (known, n), asked in zip(batch.contexts(), batch.counted(), batch.asks(), strict=True):
            expected, times = np.unique(pairs, return_counts=True)
            assert known.tolist() == expected.tolist() and n.tolist() == times.tolist()
            assert asked.tolist() == np.unique(expected >> np.uint64(9)).tolist()


def test_a_group_of_blocks_learns_once(monkeypatch):
    """Contexts that several blocks share are learnt once, not once in each block."""
    import pyarrow as pa

    class Task:
        get = classmethod(lambda cls: cls())
        partitionId = lambda self: 1

    monkeypatch.setattr(context_mixing, "TaskContext", Task)
    monkeypatch.setattr(context_mixing, "BLOCK_BYTES", 2000)
    texts = ["words that all of the texts have " * 10 + str(k) for k in range(30)]
    batch = pa.RecordBatch.from_pydict({"row": list(range(30)), "id": list(range(30)), "held_out": [False] * 30, "text": texts})
    learnt = list(context_mixing._pair_counts(iter([batch.select(["text"])]), 4))
    rows = sorted(context_mixing._rows_of(learnt + list(context_mixing._questions(iter([batch]), 4))), key=lambda r: r[:2])
    found = list(context_mixing._rows_of(context_mixing._answers(context_mixing._route(*r) for r in rows)))
    calls, learn = [], context_mixing.Contexts.learn
    monkeypatch.setattr(context_mixing.Contexts, "learn", lambda own, answers: calls.append(own) or learn(own, answers))
    codes = context_mixing.Codes(np.ones((257, 257), np.int64))
    for group in {r[2] for r in rows if r[1] == context_mixing.TEXTS}:
        blocks = [r[3] for r in rows if r[1] == context_mixing.TEXTS and r[2] == group]
        calls.clear()
        list(context_mixing._scored(blocks, {r[0]: r[3] for r in found if r[2] == group}, 4, codes))
        assert len(blocks) > 1 and len(calls) == 1
