"""Seeded hash that orders rows the same way in any engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
SEED = 42


def seeded_hash(*keys: str | Column, seed: int = SEED) -> Column:
    """60-bit non-negative hash of ``seed:key[:key...]``.

    Uniform for unique keys and independent of partitioning, so it serves as
    shuffle order, sample order, split order and coin flip.
    """
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")
