"""Row filters on text, language and token counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_text(df: DataFrame, col: str = "text") -> DataFrame:
    """Drop rows whose text is null; the empty string stays."""
    return df.filter(F.col(col).isNotNull())


def drop_long_text(df: DataFrame, max_chars: int | None = None, col: str = "text") -> DataFrame:
    """Drop texts of more than ``max_chars`` characters; off by default."""
    return df if max_chars is None else df.filter(F.length(col) <= max_chars)


def drop_empty_text(df: DataFrame, col: str = "text") -> DataFrame:
    return df.filter(F.length(col) > 0)


def keep_language(df: DataFrame, language: str = "English", col: str = "language") -> DataFrame:
    return df.filter(F.col(col) == language)


def keep_nonempty(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose array column is null or empty."""
    return df.filter(F.size(col) > 0)


def keep_token_band(df: DataFrame, low: int = 20, high: int = 1024, col: str = "length") -> DataFrame:
    """Keep rows with ``low < length <= high``."""
    return df.filter((F.col(col) > low) & (F.col(col) <= high))


def long_enough_for_band(low: int, col: str = "text"):
    """Cheap test applied before tokenizing: can the text exceed ``low`` tokens?

    A token covers at least one byte, and the prefix space adds one byte. A
    text holding ``<`` may contain special strings, which add one byte each,
    so such texts always pass.
    """
    return (F.octet_length(col) + 1 > low) | F.contains(F.col(col), F.lit("<"))
