"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is lower-cased (A-Z) and read as its words, joined by single spaces, and an end
symbol. Each symbol becomes a few binary decisions on the path of a prefix code that
depends on the symbol before it. Every decision is predicted from several contexts: the
code's own node, the earlier symbols, and the current word so far, whose counts are
gathered from all training documents. For each context that occurs there, the symbols that
follow it are counted in a partitioned table, which grows with the corpus; contexts are not
added together (earlier symbols are the key themselves, words have 55 bits of a hash). Texts
are read in blocks: some blocks ask the table for their contexts together, and each turns the
answers into the counts of its own decisions. The predictions are combined in the logistic domain
by weights that a gate selects, the gate being how often the word context was seen. The
weights start equal for every document and are refined while it is read, so a score
depends on the document and the corpus counts only.

Defined results: a NULL or wordless text is the end symbol alone; a NULL id has the
remainder of an empty text; repeated rows are each counted and scored; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from corpusmill.functions.worker import give_back
from corpusmill.plans.staging import stage

END = 256
SYMBOLS = 257
SLOT_BITS = 22  # of a table that ``Symbols`` addresses by hash; ``score`` uses ``Contexts``
SYMBOL_BITS = 9
PAIRS_HELD = 1 << 22  # distinct contexts with a next symbol that a task holds, about
TABLE_TOKENS = 1 << 22  # tokens of the corpus for each part of the table of a context
ORDERS = (5, "word")  # contexts: earlier symbols, or the current word so far
GATE_COUNTS = (1, 4, 16, 64, 512)  # sightings of the word context at which the next gate starts
BATCH_BYTES = 1 << 22  # texts that are counted together, as they share most words and contexts
BLOCK_BYTES = 1 << 20  # texts that travel together
ASKING_BLOCKS = 6  # blocks of a task that ask the table and learn together, as they share most contexts
MIXED_TEXTS = 16  # texts that are mixed together, so that their arrays stay in the cache
MIXED_SYMBOLS = 1 << 13  # symbols whose decisions are looked up together, about
SLICE = 1 << 14  # symbols whose contexts are computed together, so that they stay in the cache
WORDS_HELD = 1 << 19  # distinct words a task counts before it hands them on
HEAD_SHARE = 1 << 20  # words with at least this share of all tokens are looked up in the task,
HEAD_WORDS = 1 << 19  # and rarer ones while there are at most so many
PLAIN = np.arange(SYMBOLS, dtype=np.uint32)
RATE = 0.7
# Where the weights start: a column per gate; rows for the node and each hashed context.
FIRST_WEIGHTS = (
    (0.5, 0.4, 0.3, 0.2, 0.1, 0.0),
    (0.8, 0.8, 0.75, 0.6, 0.5, 0.7),
    (0.5, 0.3, 0.4, 0.4, 0.45, 0.3),
)


def held_out_remainder(id_col: str) -> Column:
    """The remainder that decides whether a document is held out (2) or learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7


# --- prefix codes -----------------------------------------------------------------


class Codes:
    """A prefix code for each symbol before; decisions are numbered over all codes."""

    def __init__(self, pairs: np.ndarray) -> None:
        """``pairs[a, b]``: how often symbol b follows symbol a."""
        nodes, bits, sizes, chances, ranks, borders = [], [], [], [], [], []
        for a in range(SYMBOLS):
            weights = pairs[a].astype(np.float64) * SYMBOLS + 1
            first = len(chances)
            heap = [(w, s, s) for s, w in enumerate(weights)]
            heapq.heapify(heap)
            above, mass, number = {}, {s: w for s, w in enumerate(weights)}, SYMBOLS
            below, leaves = [], [1] * SYMBOLS
            while len(heap) > 1:
                (w0, _, low), (w1, _, high) = heapq.heappop(heap), heapq.heappop(heap)
                above[low], above[high] = (number, 0), (number, 1)
                mass[number] = w0 + w1
                below.append((low, high))
                leaves.append(leaves[low] + leaves[high])
                chances.append(w1 / (w0 + w1))
                heapq.heappush(heap, (w0 + w1, number, number))
                number += 1
            # Symbols from left to right below the code's nodes.
            left = [0] * number
            for at in range(number - 1, SYMBOLS - 1, -1):
                low, high = below[at - SYMBOLS]
                left[low], left[high] = left[at], left[at] + leaves[low]
            ranks += left[:SYMBOLS]
            borders += [left[high] for _, high in below]
            for s in range(SYMBOLS):
                path = []
                at = s
                while at in above:
                    at, bit = above[at]
                    path.append((first + at - SYMBOLS, bit))
                sizes.append(len(path))
                nodes += [n for n, _ in reversed(path)]
                bits += [b for _, b in reversed(path)]
        self.sizes = np.array(sizes, np.int32)
        self.starts = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)
        # Per decision on a path: its bit, its node's hash and its node's own prediction.
        at = np.array(nodes, np.uint32)
        chance = np.array(chances)
        self.bits, self.steps = np.array(bits, np.uint8), at * np.uint32(0x9E3779B1)
        self.stretched = np.log(chance / (1 - chance)).astype(np.float32)[at]
        #: The same, as a prediction of the bit that is taken instead of a one.
        self.toward = np.where(self.bits == 1, self.stretched, -self.stretched)
        # Per pair its symbol's rank from the left; per decision the first rank behind a one.
        self.ranks, self.borders = np.array(ranks, np.int16), np.array(borders, np.int16)[at]


class _Batch:
    """The symbols of a batch of texts, and where they stand."""

    def __init__(self, texts: list[bytes]) -> None:
        self.lengths = np.array([len(t) + 1 for t in texts])
        self.ends = np.cumsum(self.lengths)
        #: An end symbol is a line end here, which no word has.
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        self.symbols = self.data.astype(np.int32)
        self.symbols[self.ends - 1] = END

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The symbol before each symbol, and both as one number."""
        # The first symbol of a text follows the end of the text before.
        before = np.full(len(self.symbols), END, np.int32)
        before[1:] = self.symbols[:-1]
        return before, before * np.int32(SYMBOLS) + self.symbols

    def earlier(self, numbers: np.ndarray, base: int, own: int, shift: int = 0) -> np.ndarray:
        """Five earlier symbols as a number of that base, the last one first, then the symbol itself.

        ``numbers`` stand for the symbols. ``own`` is what the number is multiplied by
        before the symbol is added; a ``shift`` makes room for the place, which is put there.
        """
        n, base, end = len(self.symbols), np.uint32(base), numbers[END]
        out = np.empty(n, np.uint64)
        starts = self.ends - self.lengths
        for first in range(0, n, SLICE):
            last = min(first + SLICE, n)
            low = first - min(first, 5)
            some = np.full(last - first + 5, end, np.uint32)
            some[5 - first + low :] = numbers[self.symbols[low:last]]
            two = some[4:-1] * base + some[3:-2]
            three = (some[2:-3] * base + some[1:-4]) * base + some[:-5]
            key = two.astype(np.uint64)
            key *= np.uint64(int(base) ** 3)
            key += three
            # The texts stand apart, with end symbols before each.
            opened = starts[np.searchsorted(starts, first - 4) : np.searchsorted(starts, last)]
            ends = opened + np.minimum(self.lengths[np.searchsorted(starts, opened)], 5)
            for place in range(5):
                at = opened + place
                at = at[(at < ends) & (at >= first) & (at < last)] - first
                fresh = np.zeros(len(at), np.uint64)
                for k in range(1, 6):
                    fresh *= np.uint64(base)
                    fresh += some[at + 5 - k].astype(np.uint64) if k <= place else np.uint64(end)
                key[at] = fresh
            key *= np.uint64(own)
            key += some[5:]
            if shift:
                key <<= np.uint64(shift)
                key += np.arange(first, last, dtype=np.uint64)
            out[first:last] = key
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct words with the space or end behind them, and the word at each place.

        Words come as their bytes in a row and the places where they begin, with one more
        place behind the last; then follow the number of each word of the texts and where
        it begins, likewise.
        """
        gaps = self.symbols == 32
        gaps[self.ends - 1] = True
        begins = np.append(0, np.flatnonzero(gaps) + 1).astype(np.int32)
        rows = pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(self.data)])
        coded = rows.dictionary_encode()
        _, borders, data = coded.dictionary.buffers()
        borders = np.frombuffer(borders, np.int32)[: len(coded.dictionary) + 1]
        return np.frombuffer(data, np.uint8)[: borders[-1]], borders, coded.indices.to_numpy(), begins

    def word_contexts(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each symbol of some words, its context and the symbol in the low bits; then such
        for the symbols that open a text, which have an end before them instead of a space.

        Also the symbol before and the symbol as one number.
        """
        ends = borders[1:] - 1
        symbols = data.astype(np.int32)
        symbols[ends[data[ends] == 10]] = END
        before = np.full(len(symbols), 32, np.int32)
        before[1:] = symbols[:-1]
        before[borders[:-1]] = 32
        first = np.unique(self.symbols[self.ends - self.lengths])
        symbols, before = np.append(symbols, first), np.append(before, np.full(len(first), END, np.int32))
        key = _word_prefix(symbols, before)
        key = (key * np.uint64(SYMBOLS) + before.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        key >>= np.uint64(SYMBOL_BITS)
        key <<= np.uint64(SYMBOL_BITS)
        key |= symbols.astype(np.uint64)
        return key, before * np.int32(SYMBOLS) + symbols

    def openings(self, contexts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where texts begin, and where ``word_contexts`` has their first symbols."""
        at = self.ends - self.lengths
        known = (contexts[size:] & np.uint64((1 << SYMBOL_BITS) - 1)).astype(np.int32)
        return at, size + np.searchsorted(known, self.symbols[at])

    def counted(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per kind of context, the distinct pairs of a context and a symbol, rising, with their counts."""
        pairs = self.earlier(PLAIN, SYMBOLS, 1 << SYMBOL_BITS)
        pairs.sort()
        first = np.flatnonzero(_fresh(pairs))
        out = [(pairs[first], np.diff(first, append=len(pairs)))]
        del pairs
        data, borders, word, begins = self.words()
        contexts, _ = self.word_contexts(data, borders)
        times = np.zeros(len(contexts), np.int64)
        times[: len(data)] = np.repeat(np.bincount(word, minlength=len(borders) - 1), np.diff(borders))
        # The first word of a text has another first context.
        _, opening = self.openings(contexts, len(data))
        np.add.at(times, opening, 1)
        np.subtract.at(times, borders[word[np.searchsorted(begins, self.ends - self.lengths)]], 1)
        some = times > 0
        return [*out, _summed(contexts[some], times[some])]

    def asks(self) -> list[np.ndarray]:
        """Per kind of context, the distinct contexts, rising."""
        earlier = self.earlier(PLAIN, SYMBOLS, 1 << SYMBOL_BITS)
        earlier >>= np.uint64(SYMBOL_BITS)
        data, borders, word, begins = self.words()
        contexts, _ = self.word_contexts(data, borders)
        # A word that only opens texts has no space before it.
        at, _ = self.openings(contexts, len(data))
        later = np.ones(len(word), bool)
        later[np.searchsorted(begins, at)] = False
        some = np.ones(len(contexts), bool)
        some[borders[:-1]] = np.bincount(word[later], minlength=len(borders) - 1) > 0
        return [_distinct(earlier), _distinct(contexts[some] >> np.uint64(SYMBOL_BITS))]

    def contexts(self) -> list[np.ndarray]:
        """Per kind of context, each symbol's context and the symbol in the low bits."""
        data, borders, word, begins = self.words()
        contexts, _ = self.word_contexts(data, borders)
        inner = contexts[_runs(borders[word].astype(np.int64), np.diff(begins))]
        at, opening = self.openings(contexts, len(data))
        inner[at] = contexts[opening]
        return [self.earlier(PLAIN, SYMBOLS, 1 << SYMBOL_BITS), inner]


class Symbols(_Batch):
    """The symbols of a batch of texts, with a hash per context."""


    def __init__(self, texts: list[bytes], codes: Codes) -> None:
        super().__init__(texts)
        self._codes = codes
        self.before, self.pair = self.pairs()
        self.place = np.arange(len(self.symbols)) - np.repeat(self.ends - self.lengths, self.lengths)
        self.hashes = [
            _word_hash(self.symbols, self.before)
            if order == "word"
            else _order_hash(self.symbols, self.place, order)
            for order in ORDERS
        ]

    def decisions(self, at: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Of the symbols ``at``: decisions each, their places on the paths, their slots."""
        pair = self.pair[at]
        sizes = self._codes.sizes[pair]
        upto = np.cumsum(sizes, dtype=np.int32)
        path = np.repeat(self._codes.starts[pair] - upto + sizes, sizes)
        path += np.arange(len(path), dtype=np.int32)
        step = self._codes.steps.take(path)
        slots = []
        for hashed in self.hashes:
            slot = np.repeat(hashed[at], sizes)
            slot ^= step
            slot *= np.uint32(0x85EBCA6B)
            slot >>= np.uint32(32 - SLOT_BITS)
            slots.append(slot)
        return sizes, path, slots

    def inputs(self, at: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Of the symbols ``at``: decisions each, predictions of the bits taken, and gates."""
        sizes, path, slots = self.decisions(at)
        found = [t.take(s) for t, s in zip(tables, slots, strict=True)]
        sign = np.where(self._codes.bits.take(path) == 1, np.float32(1), np.float32(-1))
        return sizes, [self._codes.toward.take(path), *[x * sign for x in found]], _gates(found[-1])


class Contexts(_Batch):
    """The symbols of a batch of texts, with exact places in the counts of its own decisions."""

    def __init__(self, texts: list[bytes], codes: Codes) -> None:
        super().__init__(texts)
        self._codes = codes
        self.pair = self.pairs()[1]
        self._pair_of, self._context_of, self._firsts, self._slots = [], [], [], []
        self._beside = self._both = None
        #: The distinct contexts of each kind, rising.
        self.asked = []
        self._slots.append(self._by_earlier())
        #: The words of the texts, as ``words`` gives them.
        self.known = data, borders, word, begins = self.words()
        contexts, pair = self.word_contexts(data, borders)
        order = np.argsort(contexts)
        pairs = contexts[order]
        fresh = _fresh(pairs)
        which = np.empty(len(pairs), np.int32)
        which[order] = np.cumsum(fresh, dtype=np.int32) - 1
        times = np.zeros(len(pairs), np.int64)
        times[: len(data)] = np.repeat(np.bincount(word), np.diff(borders))
        slots = self._place(pairs[fresh], pair[order[fresh]], np.add.reduceat(times[order], np.flatnonzero(fresh)))[which]
        # Where texts begin, another entry than the word's own stands for its first symbol.
        at, opening = self.openings(contexts, len(data))
        del pairs, contexts, order, fresh, which, times
        own = np.empty(len(self.symbols), np.int32)
        for k in range(0, len(word), SLICE):
            ends = begins[k : k + SLICE + 1]
            own[ends[0] : ends[-1]] = slots[_runs(borders[word[k : k + SLICE]].astype(np.int64), np.diff(ends))]
        own[at] = slots[opening]
        self._slots.append(own)
        del self.symbols, self.data  # the rest is enough from here on

    def _by_earlier(self) -> np.ndarray:
        """The first slot of each symbol behind five earlier ones."""
        n = len(self.symbols)
        there = np.flatnonzero(np.bincount(self.symbols, minlength=SYMBOLS))
        dense, bits = len(there), n.bit_length()
        # Numbers of the symbols that occur leave room for the place, so numbers are sorted alone.
        alone = dense**6 < 1 << (64 - bits)
        if alone:
            numbers = np.zeros(SYMBOLS, np.uint32)
            numbers[there] = np.arange(dense)
            key = self.earlier(numbers, dense, dense, bits)
            key.sort()
        else:
            key = self.earlier(PLAIN, SYMBOLS, 1 << SYMBOL_BITS)
            places = np.argsort(key)
            key = key[places]

        def sliced() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for first in range(0, n, SLICE):
                some = key[first : first + SLICE]
                if alone:
                    yield first, (some & np.uint64((1 << bits) - 1)).view(np.int64), some >> np.uint64(bits)
                else:
                    yield first, places[first : first + SLICE], some

        pairs, pair, begins, last = [], [], [], None
        for first, order, some in sliced():
            fresh = _fresh(some)
            fresh[0] = some[0] != last
            fresh = np.flatnonzero(fresh)
            pairs.append(some[fresh])
            pair.append(self.pair[order[fresh]])
            begins.append(fresh + first)
            last = some[-1]
        pairs, times = np.concatenate(pairs), np.diff(np.concatenate(begins), append=n)
        if alone:
            rest, pairs = pairs, np.zeros(len(pairs), np.uint64)
            for k in range(6):
                rest, digit = np.divmod(rest, np.uint64(dense))
                pairs += there.astype(np.uint64)[digit.view(np.int64)] * np.uint64(SYMBOLS ** (k - 1) << SYMBOL_BITS if k else 1)
        found = np.repeat(self._place(pairs, np.concatenate(pair), times), times)
        slots = np.empty(n, np.int32)
        for first, order, _ in sliced():
            slots[order] = found[first : first + SLICE]
        return slots

    def _place(self, pairs: np.ndarray, pair: np.ndarray, times: np.ndarray) -> np.ndarray:
        """A slot for each decision of each distinct pair of a context and a symbol; the first ones."""
        heads = pairs >> np.uint64(SYMBOL_BITS)
        begins = _fresh(heads)
        self.asked.append(heads[begins])
        self._context_of.append(np.cumsum(begins, dtype=np.int32) - 1)
        self._pair_of.append(pair)
        # Frequent pairs stand together, so that the cache holds them.
        order = np.argsort(-np.minimum(times, (1 << 15) - 1).astype(np.int16), kind="stable")
        sizes = self._codes.sizes[pair][order]
        firsts = np.empty(len(pair), np.int32)
        firsts[order] = np.cumsum(sizes, dtype=np.int32) - sizes
        self._firsts.append(firsts)
        return firsts

    def learn(self, answers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Counts of the decisions (otherwise, as here), from what followed each asked context.

        An answer has the number of symbols that followed each context, the symbols, and
        how often each did.
        """
        return [self._learnt(*x) for x in zip(self._pair_of, self._context_of, self._firsts, answers, strict=True)]

    def _learnt(self, pair: np.ndarray, context: np.ndarray, slot: np.ndarray, answer: tuple) -> tuple[np.ndarray, np.ndarray]:
        codes, (sizes, symbols, times) = self._codes, answer
        before = np.zeros(len(sizes), np.int32)
        before[context] = pair // SYMBOLS
        # The followers of a context from left to right in its code, and their running sums:
        # those below a node are a run, which its border cuts into zeros and ones.
        bits = len(symbols).bit_length()
        leaf = np.repeat(np.arange(len(sizes)) << SYMBOL_BITS, sizes)
        leaf |= codes.ranks[np.repeat(before * np.int32(SYMBOLS), sizes) + symbols]
        leaf <<= bits
        leaf |= np.arange(len(leaf))
        leaf.sort()  # with the places in the low bits
        upto = np.append(0, np.cumsum(times[leaf & ((1 << bits) - 1)]))
        leaf >>= bits
        leaf = np.append(leaf, -1)
        left = codes.sizes[pair]
        counts = np.zeros((2, int(left.sum())), np.float32)
        ends = np.cumsum(sizes)
        low, high = (ends - sizes)[context], ends[context]
        own, path = (context.astype(np.int64) << SYMBOL_BITS) | codes.ranks[pair], codes.starts[pair]
        total = upto[high] - upto[low]
        while True:
            # Where the symbol itself is all that followed, the rest of its path is known.
            there = (total > 0) & (left > 0)
            only = there & (high - low == 1) & (leaf[low] == own)
            at = np.flatnonzero(only)
            rest = left[at]
            counts[1][_runs(slot[at].astype(np.int64), rest)] = np.repeat(total[at], rest)
            go = np.flatnonzero(there & ~only)
            if not len(go):
                return counts[0], counts[1]
            own, low, high, path, slot, left, total = [x[go] for x in (own, low, high, path, slot, left, total)]
            border = (own & -(1 << SYMBOL_BITS)) + codes.borders[path]
            middle = low + (leaf[low] < border)
            many = np.flatnonzero(high - low > 1)
            middle[many] = np.searchsorted(leaf[:-1], border[many])
            one = codes.bits[path] == 1
            low, high = np.where(one, middle, low), np.where(one, high, middle)
            taken = upto[high] - upto[low]
            counts[0][slot], counts[1][slot] = total - taken, taken
            path, slot, left, total = path + 1, slot + 1, left - 1, taken

    def decisions(self, at: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Of the symbols ``at``: decisions each, their places on the paths, their slots."""
        pair = self.pair[at]
        sizes = self._codes.sizes[pair]
        upto = np.cumsum(sizes, dtype=np.intp)
        before, number = upto - sizes, np.arange(int(upto[-1]) if len(upto) else 0)
        path, *slots = [np.repeat(x - before, sizes) for x in (self._codes.starts[pair], *[s[at] for s in self._slots])]
        for x in (path, *slots):
            x += number
        return sizes, path, slots

    def inputs(self, at: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Of the symbols ``at``: decisions each, predictions of the bits taken, and gates."""
        if self._beside is not tables[0]:
            # A node's own prediction stands beside that of the earlier symbols, which have its code.
            pair = self._pair_of[0]
            self._both = np.empty((len(tables[0]), 2), np.float32)
            sizes = self._codes.sizes[pair]
            slot, path = _runs(self._firsts[0].astype(np.int64), sizes), _runs(self._codes.starts[pair].astype(np.int64), sizes)
            self._both[slot, 0] = self._codes.toward[path]
            self._both[:, 1] = self._beside = tables[0]
        sizes = self._codes.sizes[self.pair[at]]
        upto = np.cumsum(sizes, dtype=np.int64)
        # Both places in one number, as repeating takes longer than taking them apart.
        first, second = [s[at] - upto + sizes for s in self._slots]
        number = np.repeat((first << 32) + second, sizes)
        number += _PLACES[: len(number)] if len(number) <= len(_PLACES) else np.arange(len(number)) * ((1 << 32) + 1)
        both = self._both.view(np.complex64).reshape(-1).take(number >> 32, mode="clip")
        number &= (1 << 32) - 1
        word = tables[1].take(number, mode="clip")
        return sizes, [both.real.copy(), both.imag.copy(), word], _gates(word)


_PLACES = np.arange(1 << 18) * ((1 << 32) + 1)


def _gates(predictions: np.ndarray) -> np.ndarray:
    """The gates in the lowest bits of the word context's predictions."""
    return (predictions.view(np.uint32) & np.uint32(7)).astype(np.intp)


def _fresh(numbers: np.ndarray) -> np.ndarray:
    """Where another number begins."""
    out = np.ones(len(numbers), bool)
    np.not_equal(numbers[1:], numbers[:-1], out=out[1:])
    return out


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """The distinct numbers, rising; they are sorted in place, faster than ``np.unique`` hashes."""
    numbers.sort()
    return numbers[_fresh(numbers)]


def _shifted(symbols: np.ndarray, place: np.ndarray, by: int) -> np.ndarray:
    """The symbol so many places earlier in the text; the end symbol before its start."""
    out = np.full(len(symbols), END, symbols.dtype)
    out[by:] = symbols[:-by] if by < len(symbols) else symbols[:0]
    out[place < by] = END
    return out


def _order_hash(symbols: np.ndarray, place: np.ndarray, order: int) -> np.ndarray:
    # The symbol just before is part of the node already.
    out = np.full(len(symbols), order, np.uint32)
    for k in range(2, order + 1):
        out = out * np.uint32(0x01000193) + _shifted(symbols, place, k).astype(np.uint32) + np.uint32(1)
    return out * np.uint32(0xC2B2AE35)


def _word_hash(symbols: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A hash of the symbols from the start of the word up to the one before."""
    inner = _word_prefix(symbols, before)
    return (inner * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def _word_prefix(symbols: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The symbols from the start of the word up to the one before, as a polynomial."""
    base, inverse = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
    n = len(symbols)
    powers, undone = _powers(base, n), _powers(inverse, n)
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * powers, out=upto[1:])
    opens = (before == 32) | (before == END)
    first = np.flatnonzero(opens)  # the first symbol of a text has an end before it
    out = upto[:n] - np.repeat(upto[first], np.diff(first, append=n))
    return out * np.repeat(undone[first], np.diff(first, append=n))


_power_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    table = _power_tables.get(base)
    if table is None or len(table) < n:
        factors = np.full(max(n, 1 << 20), base, np.uint64)
        factors[0] = 1
        table = _power_tables[base] = np.cumprod(factors)
    return table[:n]


# --- mixing -------------------------------------------------------------------------


def _schedule(longest: int) -> np.ndarray:
    """Where the blocks of a text end: they grow from 16 to 1,024 symbols."""
    out, size = [16], 16
    while out[-1] < longest:
        size = min(size * 2, 1024)
        out.append(out[-1] + size)
    return np.array(out)


class Mixer:
    """Stretched predictions per slot, and the rule that mixes them."""

    def __init__(self, codes: Codes, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.codes = codes
        self.tables = []
        for zero, one in counts:
            chances = np.asarray(one, np.float32) + np.float32(0.4)
            chances /= np.asarray(zero, np.float32) + np.float32(0.4)
            self.tables.append(np.log(chances, out=chances))
        # The gate of a slot is in the three lowest bits of the word context's prediction.
        seen = counts[-1][0] + counts[-1][1]
        last = self.tables[-1].view(np.uint32)
        last &= np.uint32(0xFFFFFFF8)
        for k in GATE_COUNTS:
            last += seen >= k

    def log10(self, texts: list[bytes], own: _Batch | None = None) -> np.ndarray:
        """The log10 probability of each text; ``own`` are its symbols, hashed ones if left out."""
        own = own or Symbols(texts, self.codes)
        edges = np.append(0, _schedule(int(own.lengths.max())))
        total = np.zeros(len(texts))
        # Texts of like length are mixed together, as they have as many blocks.
        order = np.argsort(own.lengths, kind="stable")
        for k in range(0, len(order), MIXED_TEXTS):
            some = order[k : k + MIXED_TEXTS]
            total[some] = self._mixed(own, (own.ends - own.lengths)[some], own.lengths[some], edges)
        return total / np.log(10)

    def _mixed(self, own: _Batch, starts: np.ndarray, lengths: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """The log probabilities of some texts, the shorter ones first."""
        gates, docs = len(GATE_COUNTS) + 1, len(lengths)
        weights = np.tile(np.array(FIRST_WEIGHTS, np.float32), (1, docs))
        total = np.zeros(docs)
        # Runs of symbols: block by block, the texts that reach it.
        blocks = int(np.searchsorted(edges, lengths[-1]))
        sizes = np.clip(lengths[None, :] - edges[:blocks, None], 0, np.diff(edges)[:blocks, None])
        block, doc = np.nonzero(sizes)
        sizes, begins = sizes[block, doc], starts[doc] + edges[block]
        ends = np.cumsum(sizes)
        first = np.searchsorted(block, np.arange(blocks + 1))
        at = 0
        while at < blocks:
            # Some blocks' decisions are looked up at once; their number is bounded.
            done = ends[first[at]] - sizes[first[at]]
            upto = max(at + 1, int(np.searchsorted(ends[first[at + 1 :] - 1], done + MIXED_SYMBOLS, "right")) + at)
            runs = slice(first[at], first[upto])
            steps, inputs, gate = own.inputs(_runs(begins[runs], sizes[runs]), self.tables)
            held = np.append(0, np.cumsum(steps))[np.append(0, ends[runs] - done)]
            # One block at a time: the weights are refined between blocks.
            for b in range(at, upto):
                borders = held[first[b] - first[at] : first[b + 1] - first[at] + 1]
                span, whose = slice(borders[0], borders[-1]), doc[first[b] : first[b + 1]]
                cells = np.repeat(whose * gates, np.diff(borders))
                cells += gate[span]
                own_inputs = [x[span] for x in inputs]
                mixed = weights[0].take(cells, mode="clip")
                mixed *= own_inputs[0]
                for w, x in zip(weights[1:], own_inputs[1:], strict=True):
                    part = w.take(cells, mode="clip")
                    part *= x
                    mixed += part
                # What the bits taken were not given: 1 - 1 / (1 + exp(-mixed)).
                np.clip(mixed, -14, 14, out=mixed)
                np.negative(mixed, out=mixed)
                error = np.exp(mixed, out=mixed)
                whole = error + np.float32(1)
                error /= whole
                np.log(whole, out=whole)
                total[whose] -= np.add.reduceat(whole, borders[:-1] - borders[0])
                if b == blocks - 1:
                    break
                sums = RATE / (np.bincount(cells, minlength=docs * gates) + 24)
                for w, x in zip(weights, own_inputs, strict=True):
                    w += (np.bincount(cells, error * x, docs * gates) * sums).astype(np.float32)
            at = upto
        return total


# --- on DataFrames --------------------------------------------------------------------


_PLAINLY = bytes(k + 32 if 65 <= k <= 90 else 32 if 9 <= k <= 13 else k for k in range(256))


def _words(text: bytes) -> bytes:
    """The lower-cased words, with single spaces between them."""
    text = text.translate(_PLAINLY)
    return b" ".join(text.split()) if b"  " in text or text[:1] == b" " or text[-1:] == b" " else text


def _batches(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[list, list[bytes]]]:
    """Groups of rows (the columns before the text) and their texts in words, of bounded size."""
    keys, texts, size = [], [], 0
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns - 1)]
        named = zip(*columns, strict=True) if columns else repeat((), batch.num_rows)
        for key, text in zip(named, batch.column(batch.num_columns - 1).cast(pa.binary()), strict=True):
            text = text.as_py()
            keys.append(key)
            texts.append(_words(text))
            size += len(text) + 16  # many empty texts fill a batch as well
            if size >= (most or BATCH_BYTES):
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _corpus_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``kind, key, n``: word hashes (0), the end token (1), symbol pairs (2)."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    held, fresh, pairs, docs = none, [], np.zeros(SYMBOLS * SYMBOLS, np.int64), 0

    def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)], ["kind", "key", "n"]
        )

    for keys, texts in _batches(batches):
        docs += len(keys)
        batch = _Batch(texts)
        data, borders, word, _ = batch.words()
        times = np.bincount(word, minlength=len(borders) - 1)
        fresh.append(_kept(_hashes(data), times, borders))
        # Symbols of a word follow each other as often as it occurs; its first follows a space or an end.
        symbols = data.astype(np.int32)
        symbols[data == 10] = END
        before = np.append(np.int32(32), symbols[:-1])
        before[borders[:-1]] = 32
        pairs += np.bincount(before * SYMBOLS + symbols, np.repeat(times, np.diff(borders)), len(pairs)).astype(np.int64)
        first = batch.symbols[batch.ends - batch.lengths]
        pairs += np.bincount(END * SYMBOLS + first, minlength=len(pairs))
        pairs -= np.bincount(32 * SYMBOLS + first, minlength=len(pairs))
        if sum(len(x) for x, _ in fresh) > WORDS_HELD // 2:
            held = _summed(*map(np.concatenate, zip(held, *fresh, strict=True)))
            fresh.clear()
            if len(held[0]) >= WORDS_HELD:
                yield rows(0, *held)
                held = none
    yield rows(0, *_summed(*map(np.concatenate, zip(held, *fresh, strict=True))))
    yield rows(1, np.zeros(1, np.int64), np.array([docs]))
    some = np.flatnonzero(pairs)
    yield rows(2, some, pairs[some])


def _hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of words, each with a space or an end behind it."""
    from xxhash import xxh64_intdigest

    words = data.tobytes().replace(b"\n", b" ").split(b" ")[:-1]
    return np.fromiter(map(xxh64_intdigest, words, repeat(42)), np.uint64, len(words)).view(np.int64)


def _kept(hashes: np.ndarray, times: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the empty word that stands for a text of none."""
    some = np.diff(borders) > 1
    return hashes[some], times[some]


def _summed(pairs: np.ndarray, n: np.ndarray, kind: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Equal pairs once, rising, with the sum of their counts."""
    order = np.argsort(pairs, kind=kind)
    pairs, n = pairs[order], n[order]
    first = np.flatnonzero(_fresh(pairs))
    return pairs[first], np.add.reduceat(n, first) if len(first) else n


def _parts_of(contexts: np.ndarray, parts: int) -> np.ndarray:
    mixed = (contexts ^ (contexts >> np.uint64(23))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _by_part(contexts: np.ndarray, parts: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of contexts by part, in which they stay as they are, and where it has each part."""
    part = _parts_of(contexts, parts)
    order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
    upto = np.cumsum(np.bincount(part, minlength=parts)).tolist()
    return order, [(p, slice(a, b)) for p, (a, b) in enumerate(zip([0, *upto], upto)) if b > a]


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _restored(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers byte place by byte place, so that the empty high bytes compress."""
    return _squeezed(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(_restored(data), np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def _narrow(numbers: np.ndarray) -> bytes:
    """Unsigned numbers of as few bytes as the largest of them needs, with that number in front."""
    kind = np.min_scalar_type(int(numbers.max()) if len(numbers) else 0)
    return bytes([kind.itemsize]) + _packed(numbers.astype(kind))


def _widened(data: bytes) -> np.ndarray:
    return _unpacked(data[1:], np.dtype(f"u{data[0]}")).astype(np.int64)


# Rows on their way: counts of pairs (0) and questions (1) to a part, texts (2) to their own
# group of blocks, which has a negative number; answers (1) to that group.
ROUTE = "part long, kind int, block long, keys binary, n binary"
COUNTS, ASKED, TEXTS = 0, 1, 2


def _route(part: int, kind: int, block: int, keys: bytes, n: bytes = b"") -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([kind], pa.int32()), pa.array([block], pa.int64()),
         pa.array([keys], pa.binary()), pa.array([n], pa.binary())],
        ["part", "kind", "block", "keys", "n"],
    )


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(batch.column(c)[k].as_py() for c in range(5))


class _PairCounts:
    """What follows each context, added up in the task before it goes to the parts."""

    def __init__(self, parts: int) -> None:
        self._parts = parts
        self._held, self._fresh = [_NO_PAIRS for _ in ORDERS], [[] for _ in ORDERS]

    def add(self, counted: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for new, one in zip(self._fresh, counted, strict=True):
            new.append(one)
        if sum(len(x) for new in self._fresh for x, _ in new) > PAIRS_HELD // 2:
            self._added()
            if sum(len(x) for x, _ in self._held) > PAIRS_HELD:
                yield from self.handed()

    def _added(self) -> None:
        for kind, new in enumerate(self._fresh):
            if new:
                # Each of them rises already.
                self._held[kind] = _summed(*map(np.concatenate, zip(self._held[kind], *new, strict=True)), "stable")
                new.clear()

    def handed(self) -> Iterator[pa.RecordBatch]:
        self._added()
        for kind, (pairs, n) in enumerate(self._held):
            order, found = _by_part(pairs >> np.uint64(SYMBOL_BITS), self._parts)
            pairs, n = pairs[order], n[order]
            for p, own in found:
                part = kind * self._parts + p
                yield _route(part, COUNTS, 0, _packed(np.diff(pairs[own], prepend=np.uint64(0))), _narrow(n[own]))
            self._held[kind] = _NO_PAIRS


_NO_PAIRS = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _pair_counts(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """What follows each context in all of some texts."""
    sums = _PairCounts(parts)
    for _, texts in _batches(batches):
        yield from sums.add(_Batch(texts).counted())
    yield from sums.handed()
    give_back()


def _questions(batches: Iterator[pa.RecordBatch], parts: int, learn: bool = False) -> Iterator[pa.RecordBatch]:
    """Groups of blocks of texts, and the contexts that each group asks of every part.

    If it is to ``learn``, also what follows each context in the texts that are not held out.
    """
    group = -1 - (TaskContext.get().partitionId() << 32)
    sums, learnt, blocks, held = _PairCounts(parts), [], 0, []

    def handed() -> Iterator[pa.RecordBatch]:
        heads = [[] for _ in ORDERS]
        if learnt:
            counted = _Batch(learnt).counted()
            for kind, (pairs, _) in zip(heads, counted, strict=True):
                contexts = pairs >> np.uint64(SYMBOL_BITS)
                kind.append(contexts[_fresh(contexts)])
            yield from sums.add(counted)
        if held:
            for kind, contexts in zip(heads, _Batch(held).asks(), strict=True):
                kind.append(contexts)
        for kind, found in enumerate(heads):
            asked = _distinct(np.concatenate(found)) if len(found) > 1 else found[0]
            order, found = _by_part(asked, parts)
            asked = asked[order]
            for p, own in found:
                yield _route(kind * parts + p, ASKED, group, _packed(np.diff(asked[own], prepend=np.uint64(0))))

    for keys, texts in _batches(batches, BLOCK_BYTES):
        yield _route(group, TEXTS, group, _squeezed(pickle.dumps((keys, b"\n".join(texts)))))
        blocks += 1
        for key, text in zip(keys, texts, strict=True):
            (learnt if learn and not key[2] else held).append(text)
        if blocks == ASKING_BLOCKS:
            yield from handed()
            group, blocks, learnt, held = group - 1, 0, [], []
    if blocks:
        yield from handed()
    yield from sums.handed()
    give_back()


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers from the counts of a part; rows come by part, counts before questions."""
    at, counts, table = None, [], None
    for part, kind, block, keys, n in _rows_of(batches):
        if part != at:
            at, counts, table = part, [], None
        if kind == COUNTS:
            counts.append((np.cumsum(_unpacked(keys, np.uint64), dtype=np.uint64), _widened(n)))
        elif kind == ASKED:
            if table is None:
                pairs, times = _summed(*map(np.concatenate, zip(_NO_PAIRS, *counts, strict=True)), "stable")
                heads = pairs >> np.uint64(SYMBOL_BITS)
                first = np.flatnonzero(_fresh(heads))
                table = (heads[first], np.append(first, len(pairs)), (pairs & np.uint64((1 << SYMBOL_BITS) - 1)).astype(np.uint16), times)
                counts = []
                del pairs, heads, first
            asked = np.cumsum(_unpacked(keys, np.uint64), dtype=np.uint64)
            place = np.searchsorted(table[0], asked)
            low = sizes = np.zeros(len(asked), np.int64)
            if len(table[0]):
                low = table[1][place]
                there = table[0].take(place, mode="clip") == asked
                sizes = np.where(there, table[1].take(place + 1, mode="clip") - low, 0)
            place = _runs(low, sizes)
            followed = [_packed(sizes.astype(np.uint16)), _packed(table[2][place]), _narrow(table[3][place])]
            yield _route(part, ASKED, block, pickle.dumps(followed))
    give_back()


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that start there and are so long, one run after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def _answered(asked: np.ndarray, answers: dict[int, bytes], kind: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the parts answered to the contexts that a group of blocks asked for, in their order."""
    order, borders = _by_part(asked, parts)
    found = []
    for p, _ in borders:
        sizes, symbols, times = pickle.loads(answers[kind * parts + p])
        found.append((_unpacked(sizes, np.uint16), _unpacked(symbols, np.uint16), _widened(times)))
    by_part, symbols, times = map(np.concatenate, zip(*found, strict=True))
    sizes, starts = np.empty(len(asked), np.int64), np.empty(len(asked), np.int64)
    sizes[order], starts[order] = by_part, np.cumsum(by_part, dtype=np.int64) - by_part
    place = _runs(starts, sizes)
    return sizes, symbols[place].astype(np.int32), times[place]


def _scored(held: list[bytes], answers: dict[int, bytes], parts: int, codes: Codes) -> Iterator[tuple[list, Contexts, np.ndarray]]:
    """Keys, symbols and scores of a group of blocks, from the answers of the parts."""
    keys, texts = [], []
    for block in held:
        some, joined = pickle.loads(_restored(block))
        keys += some
        texts += joined.split(b"\n")  # white space inside a text is single spaces
    # The same contexts in the same order as they were asked for, so answers need not repeat them.
    own = Contexts(texts, codes)
    counts = own.learn(_answered(asked, answers, kind, parts) for kind, asked in enumerate(own.asked))
    yield keys, own, Mixer(codes, counts).log10(texts, own)


def score(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Also ``bits_per_byte``: the bits of the model over the bytes of words, spaces and end.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("id"),
        (held_out_remainder(id_col) == 2).alias("held_out"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    learnt = rows.where(~F.col("held_out")).select("text")
    gathered = learnt.mapInArrow(_corpus_counts, "kind int, key long, n long")
    counts = stage(gathered.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    sums = counts.where(F.col("kind") < 2).agg(
        F.sum("n").alias("tokens"), F.count_if(F.col("kind") == 0).alias("words"),
        F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("ends"),
    ).first()
    tokens, ends = int(sums["tokens"] or 0), int(sums["ends"] or 0)
    distinct = int(sums["words"]) + (1 if ends else 0)
    # Pairs of symbols: at most 257 * 257 rows.
    table = counts.where("kind = 2").select("key", "n").toArrow()
    pairs = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    pairs[table.column(0).to_numpy()] = table.column(1).to_numpy()
    # With the class's own code, as executors need no copy of this package.
    codes = spark.sparkContext.broadcast(cloudpickle.dumps(Codes(pairs.reshape(SYMBOLS, SYMBOLS))))
    words = counts.where("kind = 0").select(F.col("key").alias("word"), F.col("n").alias("c"))
    # At most HEAD_SHARE words can have such a share. Mostly they are far fewer.
    often = max(2, tokens // HEAD_SHARE)
    doubled = words.groupBy(F.log2("c").cast("int").alias("power")).agg(F.count("*").alias("n")).orderBy(F.desc("power"))
    so_far = 0
    for power, n in doubled.collect():  # at most 64 rows
        so_far += n
        if so_far > HEAD_WORDS:
            break
        often = min(often, max(2, 2**power))
    top = words.where(F.col("c") >= often).orderBy("word").toArrow()
    head = spark.sparkContext.broadcast((top.column(0).to_numpy(), top.column(1).to_numpy()))

    parts = max(8, tokens // TABLE_TOKENS)  # of the table of each kind of context
    # Texts, questions and counts are from one reading. The texts are where their group is scored at
    # once: both sides below read the same exchange, and only answers are shuffled again.
    many = 2 * parts * len(ORDERS)
    sent = rows.mapInArrow(lambda b: _questions(b, parts, True), ROUTE).repartition(many, "part")
    found = sent.sortWithinPartitions("part", "kind").mapInArrow(_answers, ROUTE).repartition(many, "block")

    # Every column is kept, as the exchange is only read twice if both sides ask the same of it.
    texts = sent.withColumn("keys", F.when(F.col("part") < 0, F.col("keys"))).withColumn("n", F.when(F.col("part") < 0, F.col("n")))

    def read(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
        if key[0].as_py() >= 0:  # what a part was asked
            return pa.Table.from_batches([], shown)
        held = own.column("keys").to_pylist()
        answered = dict(zip(answers.column("part").to_pylist(), answers.column("keys").to_pylist(), strict=True))
        out = pa.Table.from_batches(rated(_scored(held, answered, parts, cloudpickle.loads(codes.value))), shown)
        give_back()
        return out

    def rated(groups: Iterator[tuple[list, Contexts, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        names, often_n = head.value
        logs = np.log10(often_n + 1.0)
        for keys, own, scores in groups:
            data, borders, word, begins = own.known
            hashes = _hashes(data)
            sizes = np.diff(np.searchsorted(begins, np.append(0, own.ends)))
            # A text of no words is an empty one here.
            word, sizes = word[np.diff(begins) > 1], np.where(own.lengths > 1, sizes, 0)
            there, value = np.zeros(len(hashes), bool), np.zeros(len(hashes))
            if len(names):
                at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
                there = names[at] == hashes
                value = np.where(there, logs[at], 0.0)
            doc = np.repeat(np.arange(len(keys)), sizes)
            others = ~there[word]
            # Each other word once per text, with its count; texts in their order.
            distinct = max(1, len(hashes))
            left, times = np.unique(doc[others] * distinct + word[others], return_counts=True)
            ends = np.searchsorted(left, np.arange(len(keys) + 1) * distinct).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([k[2] for k in keys], pa.bool_()), pa.array(sizes + 1),
                 pa.array(own.lengths, pa.int64()), pa.array(scores, pa.float64()),
                 pa.array(np.bincount(doc, value[word], len(keys))),
                 pa.array(sizes - np.bincount(doc[others], minlength=len(keys))),
                 pa.ListArray.from_arrays(ends, pa.array(hashes[left % distinct], pa.int64())),
                 pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))],
                schema=shown,
            )

    shape = "row long, id long, held_out boolean, n_tokens long, bytes long, score double, head_sum double, head_n long"
    shape += ", rare array<long>, rare_times array<long>"
    shown = to_arrow_schema(StructType.fromDDL(shape))
    read_rows = stage(texts.groupBy("part").cogroup(found.groupBy("block")).applyInArrow(read, shape), "scored")
    # Words of a small share, each once per text, meet the corpus counts.
    own_words = F.explode(F.arrays_zip("rare", "rare_times")).alias("own")
    rare = read_rows.select("row", own_words).select("row", F.col("own.rare").alias("word"), F.col("own.rare_times").alias("n"))
    seen = rare.join(words.where(F.col("c") < often), "word").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_sum"), F.sum("n").alias("rare_n")
    )
    joined = read_rows.drop("rare", "rare_times").join(seen, "row", "left")
    none = F.lit(0)
    return joined.select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("head_n") + F.coalesce("rare_n", none) + (1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (
            F.col("head_sum") + F.coalesce("rare_sum", F.lit(0.0)) + float(np.log10(ends + 1))
            - F.col("n_tokens") * float(np.log10(tokens + distinct + 1))
        ).alias("base_score"),
        "score",
        (-F.col("score") / float(np.log10(2)) / F.col("bytes")).alias("bits_per_byte"),
    )
