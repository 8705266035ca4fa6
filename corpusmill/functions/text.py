"""Text expressions: whitespace, lines, JSON payloads, pre-tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as whitespace, for trimming.
WHITESPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same as the body of a class in Java's patterns: a Unicode property and four separators.
# Written as a property it is several times faster than as a list of ranges.
WHITESPACE = r"\p{IsWhite_Space}\x1c-\x1f"

# Fixed value: words, and runs of characters that are neither word nor space.
PRETOKEN = r"(?U)(\w+|[^\w\s]+)"

# Fixed value: control characters whose JSON escape has a hexadecimal letter.
LETTERED_CONTROLS = (0x0B, 0x0E, 0x0F, 0x1A, 0x1B, 0x1C, 0x1D, 0x1E, 0x1F)


def strip(text: Column) -> Column:
    """Remove whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE_CHARACTERS))


def computed_once(value: Column) -> Column:
    """Select this under an alias to keep later filters from computing ``value`` again.

    A filter on a plain projection is moved below it, together with a second copy of the
    expression; a filter on a generated column is not.
    """
    return F.explode(F.array(value))


def normalize(text: Column) -> Column:
    """Collapse whitespace runs to one space and trim the ends."""
    return F.trim(F.regexp_replace(text, rf"[{WHITESPACE}]+", " "))


def text_lines(text: Column) -> Column:
    """Lines of a text ended by line feed, carriage return or both."""
    return F.split(text, r"\r\n|\n|\r")


def char_count(text: Column) -> Column:
    """Code points, not bytes."""
    return F.char_length(text)


def without_line_end(raw: Column) -> Column:
    """Drop trailing carriage returns of a line of bytes; other bytes stay as they are."""
    trimmed = F.unhex(F.regexp_replace(F.hex(raw), "(0D)+$", ""))
    return F.when(F.substring(raw, -1, 1) == F.lit(b"\r"), trimmed).otherwise(raw)


def json_payload(text: Column) -> Column:
    """One-line JSON ``{"text": ...}`` with non-ASCII characters kept."""
    spaced = F.regexp_replace(F.to_json(F.struct(text.alias("text"))), r'^\{"text":', '{"text": ')
    # Spark writes control escapes with capitals; the stored form has small letters. An
    # escape counts only after an even number of backslashes.
    fixed = spaced
    for code in LETTERED_CONTROLS:
        escape = rf"(?<!\\)((?:\\\\)*)\\u{code:04X}"
        fixed = F.regexp_replace(fixed, escape, rf"$1\\u{code:04x}")
    lettered = "[" + "".join(rf"\x{code:02x}" for code in LETTERED_CONTROLS) + "]"
    return F.when(text.rlike(lettered), fixed).otherwise(spaced)


def stored_size(payload: Column) -> Column:
    """Bytes a record takes in a shard: payload and one line feed."""
    return (F.octet_length(payload) + F.lit(1)).cast("bigint")


def pretokens(text: Column, special_tokens: tuple[str, ...] = ()) -> Column:
    """Words and punctuation runs in order; special tokens stay whole wherever they occur."""
    plain = F.regexp_extract_all(text, F.lit(PRETOKEN), F.lit(1))
    if not special_tokens:
        return plain
    specials = "|".join(_quoted(t) for t in sorted(special_tokens, key=len, reverse=True))
    pattern = rf"(?U)({specials}|(?:(?!{specials})\w)+|(?:(?!{specials})[^\w\s])+)"
    # Few texts hold a special token; the others take the cheaper pattern.
    present = reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in special_tokens])
    return F.when(present, F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).otherwise(plain)


def _quoted(token: str) -> str:
    return "".join(c if c.isalnum() else rf"\x{{{ord(c):x}}}" for c in token)
