"""Named text sources and their union into one corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import compose, strip
from textloom.operators.ordering import head_fraction


@dataclass(frozen=True)
class Source:
    """A reader, the expression that gives a row's text, and the row's unique key.

    ``head`` keeps only that leading fraction of the rows by key.
    """

    name: str
    read: Callable[[SparkSession], DataFrame]
    text: Callable[[], Column]
    key: str = "id"
    head: float | None = None

    def scan(self, spark: SparkSession) -> DataFrame:
        df = self.read(spark)
        return df if self.head is None else head_fraction(df, self.head, self.key)

    def extract(self, spark: SparkSession) -> DataFrame:
        """``source, id, text`` and nothing else."""
        return self.scan(spark).select(
            F.lit(self.name).alias("source"), F.col(self.key).alias("id"), self.text().alias("text")
        )


def text_source(name: str, read: Callable, key: str = "id", field: str = "text", head: float | None = None) -> Source:
    return Source(name, read, lambda: strip(field), key, head)


def pair_source(name: str, read: Callable, left: str, right: str, key: str = "id", head: float | None = None) -> Source:
    return Source(name, read, lambda: compose(left, right), key, head)


def union_sources(spark: SparkSession, sources: Iterable[Source], harmonize: bool = True) -> DataFrame:
    """All rows of all sources with their ``source`` name; duplicates stay.

    With ``harmonize=False`` the raw columns are united by name, so a source
    that has no ``text`` field contributes null texts.
    """
    if harmonize:
        parts = [s.extract(spark) for s in sources]
    else:
        parts = [s.scan(spark).withColumn("source", F.lit(s.name)) for s in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
