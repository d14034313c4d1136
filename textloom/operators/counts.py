"""Counting rows and tokens while a table is being written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach a row count and further aggregates; read them after the action that runs ``df``."""
    seen = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]]
    return df.observe(seen, *aggs), seen
