"""Benchmark passages found with an FM-index over each training shard.

A shard is a run of documents that one task reads. Its words become numbers, the suffix
array of the shard gives its Burrows-Wheeler transform, a wavelet matrix answers ranks on
it, and every 16th position is kept. All windows of a block of benchmark items
are searched backwards together; rows of the found intervals walk to the next kept
position. Occurrences are merged to spans of hit words.

Benchmark items are read in blocks from the shared folder, so no size of the benchmark
is assumed. Equal texts of a shard are indexed once; each document of a shard ends with a
separator of its own, so repeated suffixes are no longer than a document.

Defined results: a NULL or wordless text has no words and no hits; a NULL or wordless item
has no window; a NULL item id is written as an empty string; rows with equal ids are each
answered; an empty benchmark hits nothing; other columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.slices import slices
from corpusmill.plans.staging import new_path
from corpusmill.sources.files import open_folder

SHARD_WORDS = 1 << 18
KEPT_EVERY = 16  # suffix positions that are kept
BLOCK_ROWS = 4096  # benchmark items searched together
CACHED_BYTES = 1 << 24  # a benchmark file below this size is parsed once per worker

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and characters beyond ASCII."""
    return text.encode().translate(_LETTERS).split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


# --- the index ---------------------------------------------------------------


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Sorted suffixes, by doubling the compared length where suffixes are still equal."""
    n = len(symbols)
    bits = int(symbols.max() + 2).bit_length()
    length = max(1, min(3, 62 // bits))
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(length, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(length):
        key = (key << bits) | padded[k : k + n]
    order = np.argsort(key)
    ranks = np.empty(n, np.int64)
    starts = _run_starts(key[order])
    ranks[order] = starts
    # Places whose run has more than one suffix.
    open_places = np.flatnonzero(_shared(starts))
    while len(open_places):
        own = order[open_places]
        follow = own + length
        after = np.where(follow < n, ranks[np.minimum(follow, n - 1)] + 1, 0)
        key = ranks[own] * (n + 1) + after
        inner = np.argsort(key)
        own, key = own[inner], key[inner]
        order[open_places] = own
        starts = open_places[_run_starts(key)]
        ranks[own] = starts
        open_places = open_places[_shared(starts)]
        length *= 2
    return order


def _run_starts(values: np.ndarray) -> np.ndarray:
    """For sorted values, the first index of each value's run."""
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return np.maximum.accumulate(np.where(first, np.arange(len(values)), 0))


def _shared(starts: np.ndarray) -> np.ndarray:
    same = starts[1:] == starts[:-1]
    out = np.zeros(len(starts), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


class FMIndex:
    """Backward search and location over a sequence of small whole numbers."""

    def __init__(self, symbols: np.ndarray, every: int = KEPT_EVERY) -> None:
        order = suffix_array(symbols)
        last = symbols[order - 1].astype(np.int32)
        self.last = last
        self.levels = max(1, int(symbols.max()).bit_length())
        self.ones, self.zeros = [], []
        now = last
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1
            ones = np.zeros(len(now) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(now) - int(ones[-1]))
            up = bit.astype(bool)
            now = np.concatenate([now[~up], now[up]])
        # Where the suffixes that start with each symbol begin.
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols))])
        kept = order % every == 0
        self.kept = kept
        self.kept_before = np.cumsum(kept) - kept
        self.positions = order[kept]

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows of suffixes that start with the symbol, before those of ``row``."""
        at, base = row, np.zeros_like(row)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            up = (symbol >> (self.levels - 1 - k)) & 1 == 1
            at = np.where(up, zeros + ones[at], at - ones[at])
            base = np.where(up, zeros + ones[base], base - ones[base])
        return self.first[symbol] + at - base

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of patterns of one length, all of whose symbols occur."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.last), np.int64)
        alive = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, k]
            low[alive] = self.step(symbol, low[alive])
            high[alive] = self.step(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        out, walked, todo = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            done = self.kept[rows]
            out[todo[done]] = self.positions[self.kept_before[rows[done]]] + walked
            todo, rows = todo[~done], rows[~done]
            rows = self.step(self.last[rows], rows)
            walked += 1
        return out


# --- benchmark blocks ----------------------------------------------------------

_parsed: dict[str, list] = {}


def _windows(names: list[str], texts: list[str], size: int) -> list[tuple[np.ndarray, np.ndarray, list[bytes], list[str]]]:
    """Distinct windows of a block by length: word numbers, items, vocabulary, item names."""
    numbers = _Numbers()
    by_length: dict[int, dict[tuple, set[int]]] = {}
    for item, text in enumerate(texts):
        own = [numbers[w] for w in words_of(text)]
        if own:
            length = min(size, len(own))
            for k in range(len(own) - length + 1):
                by_length.setdefault(length, {}).setdefault(tuple(own[k : k + length]), set()).add(item)
    return [
        (np.array(list(windows), np.int64), [np.array(sorted(x)) for x in windows.values()], list(numbers), names)
        for windows in by_length.values()
    ]


def _blocks(folder: str, size: int) -> Iterator[tuple]:
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSelector

    files, root = open_folder(folder)
    for info in sorted(files.get_file_info(FileSelector(root)), key=lambda x: x.path):
        if not info.path.endswith(".parquet"):
            continue
        if info.path in _parsed:
            yield from _parsed[info.path]
            continue
        kept, small = [], info.size <= CACHED_BYTES
        with files.open_input_file(info.path) as stream:
            for batch in pq.ParquetFile(stream).iter_batches(BLOCK_ROWS):
                names = [x or "" for x in batch.column("item").to_pylist()]
                for found in _windows(names, batch.column("text").to_pylist(), size):
                    kept += [found] if small else []
                    yield found
        if small:
            _parsed[info.path] = kept


# --- shards --------------------------------------------------------------------


def _shard(ids: list, texts: list[bytes], numbers: _Numbers, folder: str, size: int) -> Iterator[tuple]:
    """Rows ``id, n_words, n_hit, items, spans`` of the documents of one shard.

    A text is the 32-bit numbers of its words, as bytes.
    """
    own: dict[bytes, int] = {}
    which = [own.setdefault(w, len(own)) for w in texts]
    distinct = list(own)
    counts = np.array([len(w) // 4 for w in distinct], np.int64)
    ends = np.cumsum(counts + 1)
    starts = ends - counts - 1
    total = int(ends[-1])
    # Separators are 0 to the number of documents - 1; words follow.
    symbols = np.empty(total, np.int64)
    is_word = np.ones(total, bool)
    is_word[ends - 1] = False
    symbols[ends - 1] = np.arange(len(distinct))
    flat = np.frombuffer(b"".join(distinct), np.int32)
    symbols[is_word] = flat + np.int64(len(distinct))
    change = np.zeros(total + 1, np.int64)
    named: dict[int, set[str]] = {}
    if len(flat):
        index = FMIndex(symbols)
        for windows, items, vocabulary, names in _blocks(folder, size):
            table = np.array([numbers.get(w, -1) for w in vocabulary], np.int64)
            patterns = table[windows]
            there = np.flatnonzero((patterns >= 0).all(axis=1))
            low, high = index.search(patterns[there] + len(distinct))
            there, low, high = there[low < high], low[low < high], high[low < high]
            if not len(there):
                continue
            found = high - low
            rows = np.repeat(low - np.cumsum(found) + found, found) + np.arange(found.sum())
            place = index.locate(rows)
            np.add.at(change, place, 1)
            np.add.at(change, place + windows.shape[1], -1)
            doc = np.searchsorted(ends, place, "right")
            pairs = np.unique(np.stack([doc, np.repeat(there, found)]), axis=1)
            for d, w in pairs.T.tolist():
                named.setdefault(d, set()).update(names[i] for i in items[w].tolist())
    hit = np.cumsum(change[:-1]) > 0
    hits = np.add.reduceat(hit, starts) if total else np.zeros(0, np.int64)
    for key, d in zip(ids, which, strict=True):
        spans = []
        if hits[d]:
            edge = np.diff(np.concatenate([[0], hit[starts[d] : ends[d]].astype(np.int8), [0]]))
            spans = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1).tolist()
        yield key, int(counts[d]), int(hits[d]), sorted(named.get(d, ())), spans


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
) -> DataFrame:
    """``id, n_words, n_hit, items, spans`` for every document.

    ``items`` are the ids (as strings, sorted) of items with a window that occurs; ``spans``
    are merged ranges ``[first, end)`` of hit words.
    """
    folder = new_path(docs.sparkSession, "benchmark")
    benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.coalesce(item_text_col, F.lit("")).alias("text")
    ).write.parquet(folder)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, numbers = [], [], 0, _Numbers()
        for batch in slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # Numbers take a tenth of the words' memory.
                own = array("i", map(numbers.__getitem__, words_of(text.as_py()))).tobytes()
                ids.append(key)
                texts.append(own)
                held += len(own) // 4 + 1
                if held >= SHARD_WORDS:
                    yield _batch(_shard(ids, texts, numbers, folder, window))
                    ids, texts, held, numbers = [], [], 0, _Numbers()
        if ids:
            yield _batch(_shard(ids, texts, numbers, folder, window))

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    return rows.mapInArrow(
        answer, "id long, n_words long, n_hit long, items array<string>, spans array<array<int>>"
    )


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """Whether at least a twentieth of a document's words is hit."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def _batch(rows: Iterator[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int32())))
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "n_hit", "items", "spans"])
