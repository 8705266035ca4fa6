"""Many words as one array of symbols, in which a pair of neighbours is merged at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bits of one symbol in the number that stands for a pair.
PAIR_BITS = 21


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all words one after the other, and how many each word has."""
    words = words.cast(pa.large_string())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    text = bytes(memoryview(words.buffers()[2])[offsets[0] : offsets[-1]]) if offsets[-1] else b""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(text.decode().encode("utf-32-le"), "<u4").astype(np.int32), lengths


def summed(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, each with the sum of its numbers."""
    if not len(keys):
        return keys, numbers
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(numbers[order], first)


class Symbols:
    """Symbols above zero, with a zero before and after each word; ``times`` weighs the words."""

    def __init__(self, numbers: np.ndarray, lengths: np.ndarray, times: np.ndarray | None = None) -> None:
        word = np.repeat(np.arange(len(lengths)), lengths)
        self.numbers = np.zeros(len(numbers) + len(lengths) + 1, np.int32)
        self.numbers[np.arange(1, len(numbers) + 1) + word] = numbers
        self.times = None if times is None else np.concatenate([[0], np.repeat(times, lengths + 1)]).astype(np.int64)

    def pairs(self, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours inside words, everywhere or at some places, with the times of their word."""
        at = np.arange(len(self.numbers) - 1) if at is None else at
        left, right = self.numbers[at], self.numbers[at + 1]
        inside = (left > 0) & (right > 0)
        return (left[inside].astype(np.int64) << PAIR_BITS) | right[inside], self.times[at[inside]]

    def merge(self, left: int, right: int, new: int) -> tuple[np.ndarray, np.ndarray]:
        """Replace a pair wherever it occurs, from the left; where that was, before and after."""
        at = np.flatnonzero((self.numbers[:-1] == left) & (self.numbers[1:] == right))
        if left == right and len(at) > 1:
            # Of a run of such pairs, which overlap, every second one.
            place = np.arange(len(at))
            begins = np.concatenate([[True], at[1:] != at[:-1] + 1])
            at = at[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
        after = at - np.arange(len(at))
        if len(at):
            keep = np.ones(len(self.numbers), bool)
            keep[at + 1] = False
            self.numbers = self.numbers[keep]
            self.numbers[after] = new
            self.times = None if self.times is None else self.times[keep]
        return at, after

    def changes(self, left: int, right: int, new: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge, and say by how much the count of each pair changes."""
        before = Symbols.__new__(Symbols)
        before.numbers, before.times = self.numbers, self.times
        at, after = self.merge(left, right, new)
        if not len(at):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # Neighbouring merges share the pair between them, which counts once.
        gone = np.concatenate([at, at + 1, (at - 1)[np.concatenate([[True], np.diff(at) != 2])]])
        made = np.concatenate([after, (after - 1)[np.concatenate([[True], np.diff(after) != 1])]])
        old, lost = before.pairs(gone)
        now, won = self.pairs(made)
        keys, n = summed(np.concatenate([old, now]), np.concatenate([-lost, won]))
        return keys[n != 0], n[n != 0]
