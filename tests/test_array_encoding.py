import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions.symbols import PAIR_BITS, Symbols
from corpusmill.operators import bpe, tokens


@pytest.mark.parametrize("seed", range(6))
def test_merges_and_pair_counts_equal_string_replacement(seed):
    random = np.random.default_rng(seed)
    words = ["".join(random.choice(list("abc"), random.integers(1, 12))) for _ in range(60)]
    times = random.integers(1, 9, len(words))
    points = np.array([ord(c) for w in words for c in w], np.int32)
    joined = Symbols(points, np.array([len(w) for w in words]), times)

    def counted():
        total = {}
        for word, n in zip(words, times.tolist()):
            for pair in zip(word, word[1:]):
                total[pair] = total.get(pair, 0) + n
        return total

    for left, right, new in ("aaX", "abY", "XXZ", "cbW", "YYV", "Xcc"):
        before = counted()
        words = [w.replace(left + right, new) for w in words]
        after = counted()
        keys, n = joined.changes(ord(left), ord(right), ord(new))
        found = {(chr(k >> PAIR_BITS), chr(k & ((1 << PAIR_BITS) - 1))): c for k, c in zip(keys.tolist(), n.tolist())}
        assert found == {p: after.get(p, 0) - before.get(p, 0) for p in before | after if after.get(p, 0) != before.get(p, 0)}
        assert "".join(map(chr, joined.numbers.tolist())).split("\0")[1:-1] == words


def test_slices_and_both_ways_of_encoding_agree(spark, monkeypatch):
    texts = ["low lower lowest <eos> new", None, "", "widest wid\x00\x00est \U0001f600 zé", "a" * 40, "newer <eos><eos> x"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    learned = bpe.train_bpe(docs.where("doc_id <> 4"), vocab_size=40)
    assert tokens._rising(learned.merges)
    for unknown in ("<unk>", None):
        vocabulary = tokens.Vocabulary(learned.tokens[:-3] + ("?a", "?b", "?c"), learned.merges[:-3], learned.special_tokens, unknown)
        found = []
        for words, merges, characters in ((200_000, 1000, 1_000_000), (3, 1000, 9), (3, 0, 9), (200_000, 0, 1_000_000)):
            monkeypatch.setattr(tokens, "_WORDS_AT_ONCE", words)
            monkeypatch.setattr(tokens, "_ARRAY_MERGES", merges)
            monkeypatch.setattr(tokens, "_CACHED_CHARACTERS", characters)
            found.append([r["ids"] for r in tokens.encode(docs, vocabulary).orderBy("doc_id").collect()])
        assert found[0] == found[1] == found[2] == found[3]
        assert found[0][1] is None and found[0][2] == []
    assert tokens.encode(docs, learned).where(F.size("ids") > 0).count() == 12


def test_merges_whose_token_was_taken_before_are_not_in_order():
    assert tokens._rising(((0, 1, 3), (3, 2, 4)))
    assert not tokens._rising(((0, 1, 3), (3, 2, 4), (5, 2, 3)))
    assert not tokens._rising(((0, 1, 3), (0, 1, 4)))
