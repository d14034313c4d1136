"""Byte alphabet and the one-character-per-token form used inside Spark.

A token id is held as one Unicode character, so a word is a short string, a
merge is ``replace`` and an adjacent pair is a two-character substring. All of
that runs on Spark's own string functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special tokens and their ids.
SPECIALS = {"<s>": 0, "<pad>": 1, "</s>": 2, "<unk>": 3}
PAD_ID = SPECIALS["<pad>"]
EOS_ID = SPECIALS["</s>"]

# Bytes that are their own printable character; the other bytes,
# in order, take the characters from U+0100 up.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
UNPRINTABLE = [b for b in range(256) if b not in set(PRINTABLE)]

# Byte values in token id order, the first one having id FIRST_BYTE_ID.
BYTES_IN_ID_ORDER = PRINTABLE + UNPRINTABLE
FIRST_BYTE_ID = len(SPECIALS)
FIRST_MERGE_ID = FIRST_BYTE_ID + 256
BYTE_TO_ID = {b: FIRST_BYTE_ID + i for i, b in enumerate(BYTES_IN_ID_ORDER)}

_BASE = 0x100
_SURROGATES = 0xD800
_SURROGATE_COUNT = 0x800


def id_to_symbol(token_id: int) -> str:
    point = _BASE + token_id
    return chr(point if point < _SURROGATES else point + _SURROGATE_COUNT)


def symbol_to_id(symbol: str) -> int:
    point = ord(symbol)
    return (point if point < _SURROGATES else point - _SURROGATE_COUNT) - _BASE


def printable(data: bytes) -> str:
    """Display form of token bytes: one printable character per byte."""
    return "".join(chr(b) if b in _PRINTABLE_SET else chr(0x100 + _UNPRINTABLE_RANK[b]) for b in data)


_PRINTABLE_SET = set(PRINTABLE)
_UNPRINTABLE_RANK = {b: i for i, b in enumerate(UNPRINTABLE)}
_LATIN1 = "".join(map(chr, range(256)))
_BYTE_SYMBOLS = "".join(id_to_symbol(BYTE_TO_ID[b]) for b in range(256))


def byte_symbols(text: str | Column) -> Column:
    """UTF-8 bytes of ``text`` as a string of one symbol per byte."""
    col = F.col(text) if isinstance(text, str) else text
    return F.translate(F.decode(F.encode(col, "UTF-8"), "ISO-8859-1"), _LATIN1, _BYTE_SYMBOLS)


def byte_ids(text: str | Column) -> Column:
    """Token ids of ``text`` under the alphabet alone (no merges)."""
    col = F.col(text) if isinstance(text, str) else text
    chars = F.when(col == "", F.array().cast("array<string>")).otherwise(F.split(byte_symbols(col), ""))
    return F.transform(chars, lambda c: F.ascii(c) - _BASE)
