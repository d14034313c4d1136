"""Connected components of a link table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.workspace import cut_lineage

HUBS = 1024
SMALL = 100_000  # as many links of a node are never too many for one task


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of a link between two nodes.

    Large-star and small-star steps in turn: each points nodes at the smallest neighbour
    known, so the longest path shrinks by half about every round. Links are dealt by node
    once for each step, for the minimum and for joining it back. Nodes with more than a
    ``HUBS``-th of all links (at most twice as many as ``HUBS``) do not go through that
    shuffle: their minimum is a partial aggregate that is broadcast, so the links of a
    node never meet in one task. Links with a null end and links to oneself count for nothing.
    """
    x, y = F.col(a), F.col(b)
    links = links.filter(x.isNotNull() & y.isNotNull() & (x != y))
    links = cut_lineage(links.select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct())
    state = _state(links)
    while state[0]:
        ends = F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")), F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))
        both = links.select(F.explode(ends).alias("e")).select("e.u", "e.v")
        hubs: list = []
        if state[0] > SMALL:
            degree = both.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
            hubs = [r.u for r in degree.filter(F.col("n") > max(SMALL, 2 * state[0] // HUBS)).select("u").collect()]
        # Every larger neighbour of a node is pointed at the node's smallest neighbour.
        large = _with_least(both, "u", "v", hubs).filter("v > u").select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
        # A node and its smaller neighbours are pointed at the smallest of them.
        small = _with_least(large.filter("hi != lo"), "hi", "lo", hubs)
        small = small.select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")), F.struct("hi", F.col("m").alias("lo")))).alias("l"))
        links = cut_lineage(small.select("l.hi", "l.lo").filter("hi != lo").distinct())
        last, state = state, _state(links)
        if last == state:
            break
    roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def _with_least(rows: DataFrame, key: str, value: str, hubs: list) -> DataFrame:
    """``rows`` with ``m``, the smallest value of their key."""

    def joined(rows: DataFrame, hint) -> DataFrame:
        return rows.join(hint(rows.groupBy(key).agg(F.min(value).alias("m"))), key)

    if not hubs:
        return joined(rows.repartition(key), lambda least: least)
    is_hub = F.col(key).isin(hubs)
    rest = joined(rows.filter(~is_hub).repartition(key), lambda least: least)
    return rest.unionByName(joined(rows.filter(is_hub), F.broadcast).select(*rest.columns))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return tuple(row)
