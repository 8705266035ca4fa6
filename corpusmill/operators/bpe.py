"""Learning a byte-pair vocabulary from word counts.

Each symbol is one character whose code stands for its id, so a word is a short
string; a merge is made on many words at once, as an array of symbols, inside Spark tasks.

One Spark job settles many merges. The driver guesses the next ones from the exact
pair counts and the most frequent words; the job replays them on all words and
returns how each step changes the pair counts; the driver then keeps the guesses
that the exact counts confirm. A wrong guess costs time, never a wrong merge.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.symbols import PAIR_BITS, Symbols, code_points, summed
from corpusmill.operators.tokens import Vocabulary, pretoken_counts
from corpusmill.plans.staging import stage
from corpusmill.schemas import DEFAULT_SPECIAL_TOKENS

# Merges guessed per job, words the guesses are made on, pairs the driver keeps.
_GUESSES = 64
_GUESS_WORDS = 200_000
_KEPT_PAIRS = 200_000
# Replacements after which the rewritten words are written out again.
_REPLACEMENTS_KEPT = 24
# Words that a task merges at once, and counts it holds before it hands them on.
_WORDS_AT_ONCE = 10_000
_HELD_COUNTS = 1_000_000
_FIRST_CODE = 0x20
_SURROGATES = 0xD800

Merge = tuple[int, int, int]


def train_bpe(
    df: DataFrame,
    text: str = "text",
    vocab_size: int = 256,
    min_frequency: int = 1,
    special_tokens: tuple[str, ...] | None = None,
) -> Vocabulary:
    """Learn a vocabulary of ``vocab_size`` tokens from a text column."""
    counts = stage(pretoken_counts(df, text), "pretokens")
    return train_bpe_from_counts(counts, vocab_size, min_frequency, special_tokens)


def train_bpe_from_counts(
    counts: DataFrame,
    vocab_size: int = 256,
    min_frequency: int = 1,
    special_tokens: tuple[str, ...] | None = None,
) -> Vocabulary:
    """Learn from a staged table ``word, n`` of distinct words."""
    specials = tuple(special_tokens or DEFAULT_SPECIAL_TOKENS)
    # At most as many rows as there are characters in Unicode.
    letters = counts.select("word").mapInArrow(_letters, "c int").distinct().collect()
    alphabet = sorted(chr(row["c"]) for row in letters)
    tokens = list(dict.fromkeys([*specials, *alphabet]))
    number = {token: i for i, token in enumerate(tokens)}
    coded = "".join(_code(number[c]) for c in alphabet)
    first = F.translate(F.col("word"), "".join(alphabet), coded) if alphabet else F.col("word")
    base = _stage_words(counts.select(first.alias("w"), "n"))
    frequent = base.orderBy(F.desc("n"), "w").limit(_GUESS_WORDS).collect()
    sample = _Sample([row["w"] for row in frequent], [row["n"] for row in frequent])
    merges: list[Merge] = []
    pending: list[Merge] = []
    ranking, fresh = _count_pairs(base, pending), True
    while len(tokens) < vocab_size:
        guesses = _guess(ranking, sample, tokens, number, vocab_size, min_frequency)
        if not guesses:
            # Kept pairs have run out, but pairs that were not kept may be frequent enough.
            if fresh or ranking.floor < max(min_frequency, 1):
                break
            ranking, fresh = _count_pairs(base, pending), True
            continue
        changes = _replay(base, pending, guesses)
        settled = 0
        for merge, change in zip(guesses, changes):
            pair, n = ranking.best()
            # Pairs that were not kept may be as frequent as the least frequent kept one.
            uncertain = n <= ranking.floor and not fresh
            if uncertain or pair != _code(merge[0]) + _code(merge[1]) or n < max(min_frequency, 1):
                break
            left, right, new = merge
            token = tokens[left] + tokens[right]
            reused = token in number
            if not reused:
                number[token] = len(tokens)
                tokens.append(token)
            settled += 1
            fresh = False
            ranking.change(change)
            if reused and ranking.floor:
                break
        done = guesses[:settled]
        merges += done
        pending += done
        sample.take_back(len(guesses) - settled)
        if len(pending) > _REPLACEMENTS_KEPT and len(tokens) < vocab_size:
            base = _stage_words(_rewritten(base, pending))
            pending = []
        if settled < len(guesses) and ranking.floor:
            ranking, fresh = _count_pairs(base, pending), True
    return Vocabulary(tuple(tokens), tuple(merges), specials, "<unk>" if "<unk>" in number else None)


def vocabulary_rows(vocabulary: Vocabulary) -> list[tuple[int, str, int | None, int | None]]:
    """``id, token, left, right``: the artifact in table form."""
    made = {}
    for left, right, new in vocabulary.merges:
        made.setdefault(new, (left, right))
    return [(i, t, *made.get(i, (None, None))) for i, t in enumerate(vocabulary.tokens)]


def save_vocabulary(spark: SparkSession, vocabulary: Vocabulary, path: str) -> None:
    """Write the vocabulary as one small JSON file."""
    text = json.dumps(
        {
            "tokens": vocabulary.tokens,
            "merges": vocabulary.merges,
            "special_tokens": vocabulary.special_tokens,
            "unknown": vocabulary.unknown,
        }
    )
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    """Read a saved vocabulary; a missing one is an error."""
    raw = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    return Vocabulary(
        tuple(raw["tokens"]),
        tuple(tuple(m) for m in raw["merges"]),
        tuple(raw["special_tokens"]),
        raw["unknown"],
    )


def _code(symbol: int) -> str:
    point = symbol + _FIRST_CODE
    return chr(point if point < _SURROGATES else point + 0x800)


def _symbol(code: str) -> int:
    point = ord(code)
    return (point if point < _SURROGATES else point - 0x800) - _FIRST_CODE


def _stage_words(words: DataFrame) -> DataFrame:
    """Write the words that can still be merged, spread over at least all cores."""
    words = words.where(F.char_length("w") > 1)
    cores = words.sparkSession.sparkContext.defaultParallelism
    if words.rdd.getNumPartitions() < cores:
        words = words.repartition(cores)
    return stage(words, "words")


class _Ranking:
    """Pair counts with the best pair at hand; equal counts go by ids."""

    def __init__(self, counts: dict[str, int], floor: int) -> None:
        self.counts, self.floor = counts, floor
        self._heap = [(-n, pair) for pair, n in counts.items()]
        heapq.heapify(self._heap)

    def best(self) -> tuple[str, int]:
        while self._heap:
            n, pair = self._heap[0]
            if self.counts.get(pair) == -n:
                return pair, -n
            heapq.heappop(self._heap)
        return "", 0

    def change(self, changes: dict[str, int]) -> None:
        for pair, n in changes.items():
            total = self.counts.get(pair, 0) + n
            if total > 0:
                self.counts[pair] = total
                heapq.heappush(self._heap, (-total, pair))
            else:
                self.counts.pop(pair, None)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.empty(0, np.int32)
    for batch in batches:
        seen = np.union1d(seen, code_points(batch.column(0))[0])
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32))], ["c"])


def _numbers(merges: list[Merge]) -> list[Merge]:
    """Merges of the symbols' codes."""
    return [tuple(ord(_code(symbol)) for symbol in merge) for merge in merges]


def _pair_names(keys: np.ndarray) -> list[str]:
    low = (1 << PAIR_BITS) - 1
    return [chr(k >> PAIR_BITS) + chr(k & low) for k in keys.tolist()]


def _merged(batches: Iterator[pa.RecordBatch], merges: list[Merge]) -> Iterator[Symbols]:
    """Words ``w, n`` after some merges, a bounded number of them at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _WORDS_AT_ONCE):
            part = batch.slice(at, _WORDS_AT_ONCE)
            words = Symbols(*code_points(part.column("w")), part.column("n").to_numpy())
            for merge in merges:
                words.merge(*merge)
            yield words


def _summed_rows(found: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Counts of a task ``step, pair, n``, added up; handed on when they get many."""
    held, size = [], 0

    def rows() -> pa.RecordBatch:
        empty = np.empty(0, np.int64)
        keys, n = summed(np.concatenate([empty, *[k for k, _ in held]]), np.concatenate([empty, *[n for _, n in held]]))
        held[:] = [(keys, n)]
        steps, pairs = keys >> 2 * PAIR_BITS, keys & ((1 << 2 * PAIR_BITS) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(steps, pa.int64()), pa.array(_pair_names(pairs), pa.string()), pa.array(n, pa.int64())], ["step", "pair", "n"]
        )

    for step, keys, n in found:
        held.append(((step << 2 * PAIR_BITS) | keys, n))
        size += len(keys)
        if size > _HELD_COUNTS:
            batch = rows()
            size = batch.num_rows
            if size > _HELD_COUNTS // 2:
                yield batch
                held, size = [], 0
    yield rows()


def _rewritten(base: DataFrame, merges: list[Merge]) -> DataFrame:
    """The words after some merges."""
    steps = _numbers(merges)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times = batch.column("n")
            at = 0
            for words in _merged([batch], steps):
                text = words.numbers[1:-1].astype("<u4").tobytes().decode("utf-32-le").split("\0")
                yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), times.slice(at, len(text))], ["w", "n"])
                at += len(text)

    return base.mapInArrow(rewrite, "w string, n bigint")


def _count_pairs(base: DataFrame, pending: list[Merge]) -> _Ranking:
    """Exact counts of the most frequent pairs; the floor is what an unlisted pair may have."""
    before = _numbers(pending)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed_rows((0, *summed(*words.pairs())) for words in _merged(batches, before))

    counted = base.mapInArrow(count, "step bigint, pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "pair").limit(_KEPT_PAIRS).collect()
    floor = top[-1]["n"] if len(top) == _KEPT_PAIRS else 0
    return _Ranking({row["pair"]: row["n"] for row in top}, floor)


def _guess(
    ranking: _Ranking,
    sample: _Sample,
    tokens: list[str],
    number: dict[str, int],
    vocab_size: int,
    min_frequency: int,
) -> list[Merge]:
    """The next merges if all words behaved like the most frequent ones; the first is certain."""
    ahead = _Ranking(dict(ranking.counts), ranking.floor)
    names, ids = list(tokens), dict(number)
    merges: list[Merge] = []
    while len(merges) < _GUESSES and len(names) < vocab_size:
        pair, n = ahead.best()
        if n < max(min_frequency, 1):
            break
        left, right = _symbol(pair[0]), _symbol(pair[1])
        new = ids.setdefault(names[left] + names[right], len(names))
        if new == len(names):
            names.append(names[left] + names[right])
        merges.append((left, right, new))
        change = sample.merge(pair, _code(new))
        # The pair itself is gone, whatever the sample says.
        change[pair] = -n
        ahead.change(change)
    return merges


class _Sample:
    """The most frequent words, merged ahead of what is settled."""

    def __init__(self, words: list[str], times: list[int]) -> None:
        self._words = Symbols(*code_points(pa.array(words, pa.string())), np.array(times, np.int64))
        self._mark()

    def _mark(self) -> None:
        # Merges make new arrays, so the old ones stay as they are.
        self._settled, self._ahead = (self._words.numbers, self._words.times), []

    def merge(self, pair: str, new: str) -> dict[str, int]:
        merge = (ord(pair[0]), ord(pair[1]), ord(new))
        self._ahead.append(merge)
        keys, n = self._words.changes(*merge)
        return dict(zip(_pair_names(keys), n.tolist()))

    def take_back(self, steps: int) -> None:
        """Undo the last merges; the others are settled."""
        if steps:
            again = self._ahead[: len(self._ahead) - steps]
            self._words.numbers, self._words.times = self._settled
            for merge in again:
                self._words.merge(*merge)
        self._mark()


def _replay(base: DataFrame, pending: list[Merge], guesses: list[Merge]) -> list[dict[str, int]]:
    """How each guessed merge, made after those before it, changes the pair counts."""
    before, steps = _numbers(pending), _numbers(guesses)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed_rows(
            (step, *words.changes(*merge)) for words in _merged(batches, before) for step, merge in enumerate(steps)
        )

    # Each task returns its changes added up, a few rows per guess.
    changed = (
        base.mapInArrow(follow, "step bigint, pair string, n bigint")
        .groupBy("step", "pair")
        .agg(F.sum("n").alias("n"))
        .where("n <> 0")
    )
    found: list[dict[str, int]] = [{} for _ in guesses]
    for row in changed.collect():
        found[row["step"]][row["pair"]] = row["n"]
    return found
