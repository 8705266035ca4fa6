"""Exact token ids with a cache of short pieces.

A single space between two characters that are not white space always starts a new
pretoken of a byte-level vocabulary, so a text may be cut before each such space and the
pieces encoded apart. Pieces seen before are looked up; new ones are joined again and
encoded by the tokenizers library in one call, and cut by the byte lengths of its tokens.

Added tokens of the vocabulary that stand in a text are either recognised, as the library
does by default, or read as plain text. A text that holds one to be recognised goes to the
library whole.
"""

from __future__ import annotations

import json
import re

import numpy as np

from corpusmill.functions.worker import worker_cache

CACHED_PIECES = 1 << 19  # pieces a worker keeps if not told otherwise; the cache starts anew beyond them
JOINED = 4096  # new pieces encoded in one call
CACHED_IDS = 1 << 22  # ids a worker keeps

_ODD = re.compile(r" (?:\s|(?<=\s ))")
_LINE = re.compile(r"(?<=\S)(\n)(?=\S)")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def pieces_of(text: str) -> list[str]:
    """The text cut before every single space between other characters."""
    if not text:
        return []
    if _plain(text):
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]
    return [x for x in _CUT.split(text) if x]


def _plain(text: str) -> bool:
    """Whether each space stands between characters that are not white space."""
    return text[0] != " " and text[-1] != " " and _ODD.search(text) is None


class PieceEncoder:
    """Encodes texts to flat id arrays; a Python worker keeps the last one for its next tasks."""

    def __init__(self, path: str, added_tokens: bool = False, cached_pieces: int | None = None) -> None:
        """``added_tokens``: recognise the vocabulary's added tokens, the library's default."""
        from tokenizers import Tokenizer

        self._most = cached_pieces or CACHED_PIECES
        self._path, self._plain_reading, self._library = path, not added_tokens, None
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        spec = json.loads(self._tokenizer.to_str())
        added = spec.get("added_tokens") or []
        self._added = [x["content"] for x in added if x["special"]] if added_tokens else []
        splitter = spec.get("pre_tokenizer") or {}
        # Only for a byte-level vocabulary without changes to the text are cuts safe.
        self._cuts = (
            splitter.get("type") == "ByteLevel"
            and not splitter.get("add_prefix_space")
            and splitter.get("use_regex", True)
            and spec.get("normalizer") is None
            # The switch that reads added tokens as text holds for special ones only.
            and all(x["special"] for x in added)
        )
        vocabulary = self._tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self._bytes = np.zeros(self.size, np.int64)
        for token, number in vocabulary.items():
            self._bytes[number] = len(token)  # byte-level: one character is one byte
        self._clear()

    @classmethod
    def of(cls, path: str, added_tokens: bool = False, cached_pieces: int | None = None) -> PieceEncoder:
        kept, key = worker_cache("encoder"), (path, added_tokens, cached_pieces)
        if key not in kept:
            kept.clear()
            kept[key] = cls(*key)
        return kept[key]

    @property
    def _whole(self):
        """The library's own reading, which few texts need."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
            self._library.encode_special_tokens = self._plain_reading
        return self._library

    def _clear(self) -> None:
        self._known = _Numbers()
        self._starts = np.zeros(1024, np.int64)
        self._counts = np.zeros(1024, np.int64)
        self._ids = np.zeros(4096, np.uint32)
        self._used = 0

    def _plain_ids(self, text: str) -> np.ndarray:
        # The fast form gives the same ids without tracking character offsets.
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the same as from the library."""
        if not self._cuts:
            found = self._whole.encode_batch(texts, add_special_tokens=False)
            return [np.array(x.ids, np.uint32) for x in found]
        if self._added:
            holding = [k for k, t in enumerate(texts) if any(x in t for x in self._added)]
            if holding:
                # Few texts hold an added token; around it the pieces could not be cut.
                own = self._whole.encode_batch([texts[k] for k in holding], add_special_tokens=False)
                whole = {k: np.array(x.ids, np.uint32) for k, x in zip(holding, own, strict=True)}
                others = iter(self._encode([t for k, t in enumerate(texts) if k not in whole]))
                return [whole[k] if k in whole else next(others) for k in range(len(texts))]
        return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if self._known.size > self._most or self._used > CACHED_IDS:
            self._clear()
        number = self._known.__getitem__
        cut = [pieces_of(t) for t in texts]
        try:
            numbers = [np.fromiter(map(number, pieces), np.int64, len(pieces)) for pieces in cut]
            self._learn()
        except BaseException:
            # Pieces with a number but without ids must not outlive this task.
            self._clear()
            raise
        return [self._gathered(at)[0] for at in numbers]

    def _learn(self) -> None:
        """Encode the pieces that got a number but have no ids yet."""
        known, spaced, bare, others = self._known, [], [], []
        made, parts_of, sizes = [], [], []
        while known.fresh:
            fresh, known.fresh = known.fresh, []
            for p in fresh:
                if p[-1] in ".," or "\n" in p:
                    # Parts are looked up like pieces, so new ones join ``fresh``.
                    parts = _parts(p)
                    if len(parts) > 1:
                        made.append(known[p])
                        parts_of.extend([known[x] for x in parts])
                        sizes.append(len(parts))
                        continue
                # White space at the borders: none, one space in front, or more.
                lost = len(p) - len(p.strip())
                if lost == 0:
                    bare.append(p)
                elif lost == 1 and p[0] == " " and len(p) > 1:
                    spaced.append(p)
                else:
                    others.append(p)
        self._starts = _grown(self._starts, known.size)
        self._counts = _grown(self._counts, known.size)
        for p in others:
            self._keep([p], self._plain_ids(p), "")
        for k in range(0, len(spaced), JOINED):
            self._keep(block := spaced[k : k + JOINED], self._plain_ids("".join(block)), "")
        for k in range(0, len(bare), JOINED):
            # A lone line end between other characters is a pretoken of its own.
            self._keep(block := bare[k : k + JOINED], self._plain_ids("\n".join(block)), "\n")
        if made:
            ids, counts = self._gathered(np.array(parts_of))
            ends = np.cumsum(np.array(sizes))
            upto = np.concatenate([[0], np.cumsum(counts)])
            self._put(np.array(made), ids, np.diff(upto[np.concatenate([[0], ends])]))

    def _gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, counts = self._starts[at], self._counts[at]
        ends = np.cumsum(counts)
        place = np.repeat(starts - ends + counts, counts)
        place += np.arange(len(place))
        return self._ids[place], counts

    def _keep(self, pieces: list[str], ids: np.ndarray, between: str) -> None:
        """Cut the ids of joined pieces by the byte lengths of the tokens."""
        ends = np.cumsum(self._bytes[ids])
        sizes = np.fromiter(map(len, map(str.encode, pieces)), np.int64, len(pieces))
        wanted = np.cumsum(sizes + len(between)) - len(between)
        stops = np.searchsorted(ends, wanted) + 1
        if not np.array_equal(ends[stops - 1], wanted):
            raise RuntimeError("a token crosses a piece; the vocabulary is not byte-level")
        counts = np.diff(stops, prepend=0)
        if between:
            keep = np.ones(len(ids), bool)
            keep[stops[:-1]] = False
            ids = ids[keep]
            counts[1:] -= 1
        self._put(np.fromiter(map(self._known.__getitem__, pieces), np.int64, len(pieces)), ids, counts)

    def _put(self, numbers: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        self._ids = _grown(self._ids, self._used + len(ids))
        self._ids[self._used : self._used + len(ids)] = ids
        self._starts[numbers] = self._used + np.cumsum(counts) - counts
        self._counts[numbers] = counts
        self._used += len(ids)


class _Numbers(dict):
    """Numbers pieces in the order they are first asked for."""

    def __init__(self) -> None:
        self.size = 0
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = self.size
        self.size += 1
        self.fresh.append(piece)
        return number


def _parts(piece: str) -> list[str]:
    """Cut a new piece at lone line ends, and before a last point or comma after a letter."""
    parts = [x for x in _LINE.split(piece) if x] if "\n" in piece else [piece]
    out = []
    for x in parts:
        if x[-1] in ".," and len(x) > 1 and x[-2].isalpha():
            out += (x[:-1], x[-1])
        else:
            out.append(x)
    return out


def _grown(a: np.ndarray, size: int) -> np.ndarray:
    if size <= len(a):
        return a
    out = np.zeros(max(size, 2 * len(a)), a.dtype)
    out[: len(a)] = a
    return out
