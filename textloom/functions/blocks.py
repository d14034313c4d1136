"""Token-array operations: blocks, padding, masks, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.symbols import EOS_ID, PAD_ID

BLOCK_SIZE = 1024
IGNORED_LABEL = -100


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def append_eos(ids: str | Column, eos_id: int = EOS_ID) -> Column:
    return F.concat(_c(ids), F.array(F.lit(eos_id)))


def truncate(ids: str | Column, max_length: int) -> Column:
    return F.slice(_c(ids), 1, max_length)


def blocks(ids: str | Column, block_size: int = BLOCK_SIZE) -> Column:
    """Consecutive slices of ``block_size`` ids; the last one may be short."""
    t = _c(ids)
    starts = F.when(F.size(t) > 0, F.sequence(F.lit(1), F.size(t), F.lit(block_size)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda s: F.slice(t, s, block_size))


def pad_right(ids: str | Column, length: int | Column, pad_id: int = PAD_ID) -> Column:
    t = _c(ids)
    return F.concat(t, F.array_repeat(F.lit(pad_id), F.greatest(F.lit(length) - F.size(t), F.lit(0))))


def attention_mask(n_tokens: str | Column, length: int | Column) -> Column:
    """``n_tokens`` ones, then zeros up to ``length``."""
    n = _c(n_tokens)
    return F.concat(
        F.array_repeat(F.lit(1), n),
        F.array_repeat(F.lit(0), F.greatest(F.lit(length) - n, F.lit(0))),
    )


def causal_labels(ids: str | Column, pad_id: int = PAD_ID) -> Column:
    """Copy of the ids with padding replaced by the ignored label."""
    return F.transform(_c(ids), lambda x: F.when(x == pad_id, F.lit(IGNORED_LABEL)).otherwise(x))


def shifted_labels(ids: str | Column, eos_id: int = EOS_ID) -> Column:
    """The ids moved one place left with the end id in the last place."""
    t = _c(ids)
    rest = F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0)))
    return F.when(F.size(t) > 0, F.concat(rest, F.array(F.lit(eos_id)))).otherwise(t)


def ids_in_range(ids: str | Column, vocab_size: int) -> Column:
    """True when every id is a valid row of the vocabulary."""
    return ~F.exists(_c(ids), lambda x: (x < 0) | (x >= vocab_size))
