import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.operators import bpe, evaluation, packing, tokens
from corpusmill.sources.tokens import read_token_ids, write_packed, write_token_ids

tokenizers = pytest.importorskip("tokenizers")


def library(texts, vocab_size, min_frequency, specials=("<pad>", "<unk>", "<bos>", "<eos>")):
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import Whitespace
    from tokenizers.trainers import BpeTrainer

    made = tokenizers.Tokenizer(BPE(unk_token="<unk>"))
    made.pre_tokenizer = Whitespace()
    trainer = BpeTrainer(
        vocab_size=vocab_size,
        min_frequency=min_frequency,
        special_tokens=list(specials),
        show_progress=False,
    )
    made.train_from_iterator(texts, trainer=trainer)
    return made


def random_texts(seed, count=60, letters="abcé"):
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(80)]
    return [
        " ".join(rng.choices(words, k=rng.randint(0, 30))) + rng.choice(["", ".", "!!", " <eos> x"])
        for _ in range(count)
    ]


def check_against_library(spark, texts, vocab_size, min_frequency, unseen=()):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    learned = bpe.train_bpe(df, vocab_size=vocab_size, min_frequency=min_frequency)
    made = library(texts, vocab_size, min_frequency)
    assert {t: i for i, t in enumerate(learned.tokens)} == made.get_vocab()
    probe = [*texts, *unseen]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(probe)], "doc_id int, text string")
    for row in tokens.encode(rows, learned).collect():
        assert row["ids"] == made.encode(row["text"]).ids, row["text"]
    return learned


UNSEEN = ["", "zzz é?", "the<eos>", "!!<eos>!<pad>", "日本語 abc", "a" * 200, "abab" * 40, "_a1-b"]


@pytest.mark.parametrize("seed,vocab_size,min_frequency", [(1, 40, 1), (2, 300, 1), (3, 120, 5)])
def test_vocabulary_and_ids_equal_the_library(spark, seed, vocab_size, min_frequency):
    check_against_library(spark, random_texts(seed), vocab_size, min_frequency, UNSEEN)


def test_repeated_letters_and_reused_tokens(spark):
    texts = ["aaa aaaa aaaaa ab abab ababab ba bab", "abc ab c bc a bca abcabc aabb", "aab aba baa " * 5]
    check_against_library(spark, texts * 3, 64, 1, UNSEEN)


def test_few_kept_pairs_and_few_guesses_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(bpe, "_KEPT_PAIRS", 7)
    monkeypatch.setattr(bpe, "_GUESSES", 3)
    monkeypatch.setattr(bpe, "_GUESS_WORDS", 5)
    monkeypatch.setattr(bpe, "_REPLACEMENTS_KEPT", 2)
    check_against_library(spark, random_texts(9, 20), 40, 1)


def test_small_vocabulary_keeps_the_alphabet(spark):
    df = spark.createDataFrame([("xyz",)], "text string")
    learned = bpe.train_bpe(df, vocab_size=2)
    assert learned.tokens == ("<pad>", "<unk>", "<bos>", "<eos>", "x", "y", "z")
    assert learned.merges == ()


def test_vocabulary_file(spark, folder):
    df = spark.createDataFrame([("low lower lowest",)], "text string")
    learned = bpe.train_bpe(df, vocab_size=20)
    bpe.save_vocabulary(spark, learned, f"{folder}/v")
    assert bpe.load_vocabulary(spark, f"{folder}/v") == learned
    with pytest.raises(PySparkException):
        bpe.load_vocabulary(spark, f"{folder}/missing")


def test_token_files(spark, folder):
    df = spark.createDataFrame(
        [(i, list(range(i % 4))) for i in range(20)], "doc_id bigint, ids array<int>"
    )
    assert write_token_ids(df, f"{folder}/ids", "doc_id") == sum(i % 4 for i in range(20))
    rows = read_token_ids(spark, f"{folder}/ids").orderBy("file", "split_start", "row").collect()
    assert [r["ids"] for r in rows] == [list(range(i % 4)) for i in range(20)]


def windows(stream, n):
    return [stream[i : i + n + 1] for i in range(0, len(stream) - n, n)]


@pytest.mark.parametrize("seed,n,bits", [(1, 1, 1), (2, 3, 2), (3, 7, 12), (4, 50, 3), (5, 1000, 3)])
def test_blocks_equal_the_windows_of_the_stream(spark, seed, n, bits):
    rng = random.Random(seed)
    docs = [[rng.randrange(8) for _ in range(rng.choice([0, 1, 2, 5, 40]))] for _ in range(60)]
    rows = [(i * 3, ids) for i, ids in enumerate(docs)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, ids array<int>")
    found = packing.pack_blocks(df, n, 8, bits=bits).orderBy("block_id").collect()
    expected = windows([x for ids in docs for x in ids], n)
    assert [r["block_id"] for r in found] == list(range(len(expected)))
    assert [r["ids"] for r in found] == expected


def test_pack_checks_and_examples(spark, folder):
    df = spark.createDataFrame([(0, [0, 1, 2]), (1, [3, 4])], "doc_id bigint, ids array<int>")
    blocks = packing.require_blocks(packing.pack_blocks(df, 2, 8))
    meta = packing.pack_metadata(blocks, 2, 8)
    assert tuple(meta.first()) == (2, 8, 2, 4, "<u4")
    assert packing.pack_check(meta, blocks).count() == 0
    wrong = packing.pack_check(meta.withColumn("num_tokens", F.lit(5)), blocks).collect()
    assert [r["problem"] for r in wrong] == ["invalid token count in pack metadata"]
    examples = packing.shifted_examples(blocks, 2).orderBy("block_id")
    assert tuple(examples.first()) == (0, [0, 1], [1, 2])
    batches = packing.sequential_batches(examples, 2).collect()
    assert [(r["batch_id"], r["examples"], r["inputs"]) for r in batches] == [(0, 2, [[0, 1], [2, 3]])]
    written = write_packed(blocks, folder, "train", 1).orderBy("object_key").collect()
    assert [r["object_key"] for r in written] == ["train-000001.bin", "train-000002.bin"]
    stored = b"".join(open(f"{folder}/{r['object_key']}", "rb").read() for r in written)
    assert np.frombuffer(stored, "<u4").tolist() == [0, 1, 2, 2, 3, 4]
    with pytest.raises(Exception, match="an id is not below 4"):
        packing.pack_blocks(df, 2, 4).collect()
    with pytest.raises(ValueError, match="do not fill one block"):
        packing.require_blocks(packing.pack_blocks(df, 9, 8))
    with pytest.raises(ValueError, match="above 0|needs entries"):
        packing.pack_blocks(df, 0, 8)


def test_vocab_range(spark):
    df = spark.createDataFrame([(0, [0, 9]), (1, [1]), (2, [-1])], "doc_id int, ids array<int>")
    found = tokens.vocab_range_check(df, 8).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["bad_id"]) for r in found] == [(0, 9), (2, -1)]
    assert tuple(tokens.token_counts(df).first()) == (3, 4)


def test_perplexity_is_weighted_by_tokens(spark):
    scores = spark.createDataFrame([(1.0, 1), (2.0, 3)], "loss double, items int")
    row = evaluation.weighted_perplexity(scores).first()
    assert row["loss"] == pytest.approx(1.75)
    assert row["perplexity"] == pytest.approx(np.exp(1.75))
    with pytest.raises(PySparkException, match="no items"):
        evaluation.weighted_perplexity(scores.limit(0)).collect()
    with pytest.raises(PySparkException, match="loss of a batch"):
        nulls = spark.createDataFrame([(None, 1)], "loss double, items int")
        evaluation.weighted_perplexity(nulls).collect()


@pytest.mark.parametrize("kept", [1, 2, 7])
def test_few_kept_pairs_do_not_end_the_training(spark, monkeypatch, kept):
    rows = spark.createDataFrame([("low lower lowest new newer newest wide wider widest",)] * 3, "text string")
    whole = bpe.train_bpe(rows, vocab_size=40)
    monkeypatch.setattr(bpe, "_KEPT_PAIRS", kept)
    assert bpe.train_bpe(rows, vocab_size=40) == whole
