"""Added tokens in texts, against the library as it comes."""

from zlib import crc32

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from corpusmill.llm import encoding, queries

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "no such token.", "x<|endoftext|><|endoftext|>\n y", "", "<|endoftext|", "again, a b"]


def ids_of(text):
    return Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids


def test_encoder_recognises_added_tokens():
    assert ids_of(TEXTS[0]) == [64, 220, 50256, 275]
    own = encoding.PieceEncoder.of(VOCABULARY, added_tokens=True)
    assert [x.tolist() for x in own.encode(TEXTS)] == [ids_of(t) for t in TEXTS]


def test_queries_recognise_added_tokens(spark, folder):
    rows = list(enumerate(TEXTS))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(folder + "/documents.parquet")
    crc = lambda ids: crc32(np.array(ids, "<u4").tobytes())
    found = queries.op7_token_files(spark, folder).orderBy("doc_id").collect()
    ids = [[*ids_of(t), 2] for t in TEXTS]
    starts = np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [tuple(r) for r in found] == [(k, s, len(x), crc(x)) for (k, x), s in zip(enumerate(ids), starts, strict=True)]
    ids = [[*ids_of(t), 0] for t in TEXTS]
    found = queries.op10_packing(spark, folder).orderBy("doc_id").collect()
    assert [(r["length"], r["ids_crc32"]) for r in found] == [(len(x), crc(x)) for x in ids]
