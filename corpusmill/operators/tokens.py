"""Pre-token counts and encoding with a learned vocabulary."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.symbols import Symbols, code_points
from corpusmill.functions.text import pretokens
from corpusmill.schemas import DEFAULT_SPECIAL_TOKENS

# Characters of the words a worker remembers the ids of, and words it encodes at once.
_CACHED_CHARACTERS = 1_000_000
_WORDS_AT_ONCE = 200_000
# Up to so many merges are made one after the other on all words at once.
_ARRAY_MERGES = 1_000


@dataclass(frozen=True)
class Vocabulary:
    """Tokens in id order and merges in rank order as ``(left, right, new)`` ids.

    Its size is set by the requested vocabulary size, not by the corpus.
    """

    tokens: tuple[str, ...]
    merges: tuple[tuple[int, int, int], ...]
    special_tokens: tuple[str, ...] = DEFAULT_SPECIAL_TOKENS
    unknown: str | None = "<unk>"

    @property
    def size(self) -> int:
        return len(self.tokens)


def pretoken_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """How often each word or punctuation run occurs: ``word, n``."""
    words = df.select(F.explode(pretokens(F.col(text))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of each text. Rows stay where they are; nothing is shuffled."""
    words = pretokens(F.col(text), vocabulary.special_tokens)
    return df.withColumn(ids, _encoder(df, vocabulary)(words))


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The token strings of a list of ids, one after the other."""
    names = F.array(*[F.lit(token) for token in vocabulary.tokens])
    return F.array_join(F.transform(ids, lambda i: F.get(names, i)), "")


def token_counts(df: DataFrame, group: list[str] | None = None, ids: str = "ids") -> DataFrame:
    """Documents and tokens, overall or per group."""
    return df.groupBy(*(group or [])).agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(F.size(ids).cast("bigint")), F.lit(0)).alias("tokens"),
    )


def vocab_range_check(df: DataFrame, vocab_size: int, ids: str = "ids") -> DataFrame:
    """Documents that hold an id outside the vocabulary, with the first such id."""
    if vocab_size <= 0:
        raise ValueError(f"a vocabulary needs entries, got vocab_size={vocab_size}")
    outside = F.filter(F.col(ids), lambda x: x.isNull() | (x < 0) | (x >= vocab_size))
    return df.where(F.size(outside) > 0).withColumn("bad_id", outside[0])


def checked_ids(ids: Column, vocab_size: int) -> Column:
    """The ids themselves; an id outside the vocabulary is an error."""
    inside = F.forall(ids, lambda x: (x >= 0) & (x < vocab_size))
    problem = F.raise_error(F.lit(f"an id is not below {vocab_size}, the number of entries"))
    return F.when(inside, ids).otherwise(problem.cast("array<int>"))


def _encoder(df: DataFrame, vocabulary: Vocabulary):
    number = {token: i for i, token in enumerate(vocabulary.tokens)}
    ranks = {(left, right): (rank, new) for rank, (left, right, new) in enumerate(vocabulary.merges)}
    specials = {t: number[t] for t in vocabulary.special_tokens if t in number}
    unknown = number.get(vocabulary.unknown) if vocabulary.unknown else None
    shared = df.sparkSession.sparkContext.broadcast((number, ranks, specials, unknown))
    in_order = _rising(vocabulary.merges) and len(vocabulary.merges) <= _ARRAY_MERGES
    cache: dict[str, np.ndarray] = {}
    size = [0]

    def one_by_one(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        number, ranks, specials, unknown = shared.value
        pieces = []
        for word in words.to_pylist():
            found = cache.get(word)
            if found is None:
                ids = [specials[word]] if word in specials else _merge_word(word, number, ranks, unknown)
                found = np.array(ids, dtype=np.int32)
                if size[0] > _CACHED_CHARACTERS:
                    cache.clear()
                    size[0] = 0
                if len(word) <= _CACHED_CHARACTERS:
                    cache[word] = found
                    size[0] += len(word) + 1
            pieces.append(found)
        return np.concatenate([*pieces, np.empty(0, np.int32)]), np.array([len(p) for p in pieces], dtype=np.int64)

    @F.arrow_udf("array<int>")
    def encode_words(texts: pa.Array) -> pa.Array:
        number, ranks, specials, unknown = shared.value
        counts = np.array(texts.value_lengths().fill_null(0), dtype=np.int64)
        ends = np.cumsum(counts)
        lengths, parts = [], []
        row = 0
        while row < len(texts):
            # As many rows as have a bounded number of words, one at least.
            upto = max(row + 1, int(np.searchsorted(ends, ends[row] - counts[row] + _WORDS_AT_ONCE, "right")))
            flat = texts.slice(row, upto - row).flatten().dictionary_encode()
            pool, sizes = (
                _array_ids(flat.dictionary, number, ranks, specials, unknown) if in_order else one_by_one(flat.dictionary)
            )
            # Ids per word, laid out word after word, then grouped per text.
            code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            begins = np.cumsum(sizes) - sizes
            length = sizes[code]
            after = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
            parts.append(pool[np.arange(after[-1]) + np.repeat(begins[code] - after[:-1], length)])
            lengths.append(np.diff(after[np.concatenate([[0], np.cumsum(counts[row:upto])])]))
            row = upto
        ids = np.concatenate([*parts, np.empty(0, np.int32)])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([*lengths, np.empty(0, np.int64)]))])
        return pa.ListArray.from_arrays(
            pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32, copy=False)), mask=texts.is_null()
        )

    return encode_words


def _rising(merges: tuple[tuple[int, int, int], ...]) -> bool:
    """Whether no merge makes a token that it or an earlier one takes, and none occurs twice.

    Then making the merges one after the other gives what lowest rank first gives.
    """
    used: set[int] = set()
    for left, right, new in merges:
        used |= {left, right}
        if new in used:
            return False
    return len({merge[:2] for merge in merges}) == len(merges)


def _array_ids(words: pa.Array, number: dict, ranks: dict, specials: dict, unknown: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after the other, and how many each word has."""
    points, lengths = code_points(words)
    letters = {ord(token): i for token, i in number.items() if len(token) == 1}
    # Symbols are ids and 1, so that none is zero; -1 stands for nothing.
    table = np.full(max(letters, default=0) + 2, -1 if unknown is None else unknown + 1, np.int32)
    table[list(letters)] = np.array(list(letters.values()), np.int32) + 1
    symbols = table[np.minimum(points, len(table) - 1)]
    word = np.repeat(np.arange(len(lengths)), lengths)
    begins = np.cumsum(lengths) - lengths
    for at in np.flatnonzero(pc.is_in(words, pa.array(list(specials), words.type)).to_numpy(zero_copy_only=False)).tolist():
        symbols[begins[at] : begins[at] + lengths[at]] = -1
        symbols[begins[at]] = specials[words[at].as_py()] + 1
    there = symbols > 0
    joined = Symbols(symbols[there], np.bincount(word[there], minlength=len(lengths)).astype(np.int64))
    for (left, right), (_, new) in ranks.items():
        joined.merge(left + 1, right + 1, new + 1)
    borders = np.flatnonzero(joined.numbers == 0)
    return joined.numbers[joined.numbers > 0] - 1, np.diff(borders) - 1


def _merge_word(word: str, number: dict, ranks: dict, unknown: int | None) -> list[int]:
    """Merge neighbours, lowest rank first and leftmost among equals, until none is left."""
    ids = [number.get(c, unknown) for c in word]
    ids = [i for i in ids if i is not None]
    after = list(range(1, len(ids) + 1))
    before = list(range(-1, len(ids) - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < len(ids):
            hit = ranks.get((ids[left], ids[right]))
            if hit is not None:
                heapq.heappush(heap, (hit[0], left, hit[1], ids[left], ids[right]))

    for i in range(len(ids) - 1):
        offer(i)
    gone = [False] * len(ids)
    while heap:
        _, left, new, left_id, right_id = heapq.heappop(heap)
        right = after[left] if not gone[left] else len(ids)
        if right >= len(ids) or ids[left] != left_id or ids[right] != right_id:
            continue
        ids[left] = new
        gone[right] = True
        after[left] = after[right]
        if after[left] < len(ids):
            before[after[left]] = left
        if before[left] >= 0:
            offer(before[left])
        offer(left)
    return [token for token, dead in zip(ids, gone) if not dead]
