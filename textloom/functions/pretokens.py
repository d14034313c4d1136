"""Splitting text into pretokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.symbols import SPECIALS

# Fixed value: the byte-level split pattern, with Unicode character classes. The
# runs are possessive and the most frequent case comes first; neither changes
# what matches.
PRETOKEN_PATTERN = (
    r"(?U) ?\p{L}++|'(?:[sdmt]|ll|ve|re)| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
)

_SPECIAL = "|".join(SPECIALS)
_PIECE = rf"(?s){_SPECIAL}|(?:(?!{_SPECIAL}).)+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_prefix_space(text: str | Column) -> Column:
    """One leading space unless the text is empty or starts with one."""
    t = _c(text)
    return F.when((t == "") | t.startswith(" "), t).otherwise(F.concat(F.lit(" "), t))


def pretokens(text: str | Column) -> Column:
    """Array of pretokens of ``text``."""
    return F.regexp_extract_all(with_prefix_space(text), F.lit(PRETOKEN_PATTERN), 0)


def has_specials(text: str | Column) -> Column:
    return _c(text).rlike(_SPECIAL)


def special_pieces(text: str | Column) -> Column:
    """The text cut at special strings, which are kept as pieces of their own."""
    return F.regexp_extract_all(_c(text), F.lit(_PIECE), 0)


def pretokens_with_specials(text: str | Column) -> Column:
    """Pretokens where special strings in the text stay whole.

    Each piece between special strings is split on its own, with its own
    prefix space. Texts without any special string take the direct route.
    """
    t = _c(text)
    split = F.flatten(
        F.transform(
            special_pieces(t), lambda p: F.when(p.isin(*SPECIALS), F.array(p)).otherwise(pretokens(p))
        )
    )
    return F.when(has_specials(t), split).otherwise(pretokens(t))
