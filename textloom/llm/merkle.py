"""A manifest of a dataset: binary Merkle trees of its rows, kept as append logs in completion order.

Each group of rows has a tree over its rows in key order, and the roots of the groups have
one tree over them. A tree is built by aligned builders: each takes ``2 ** BITS`` consecutive
leaves, appends every node to its log when the node is complete (postorder) and hands its
last node to a builder of the next tier. In that order a node's place follows from the sizes
of the subtrees before it, so siblings are addressed in the log without links or search,
and a proof is a walk over computed places.

Rows are small here: texts are hashed where they are read, and only keys and digests are moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.workspace import write_through

BITS = 12
DIGEST = 32
_NONE, _LEFT, _RIGHT = b"\0", b"\1", b"\2"  # where the sibling of a step stands
_STEP = DIGEST + 1


def joined_hash(*nodes: bytes) -> bytes:
    """SHA-256 of digests in lowercase hex, one after another."""
    return hashlib.sha256(b"".join(n.hex().encode() for n in nodes)).digest()


def position(level: int, index: int, total: int) -> int:
    """Place in the log of the node that is ``index``-th of its ``level`` over ``total`` leaves.

    Before the last leaf below it came ``e - 1`` leaves with ``2 (e - 1) - popcount(e - 1)``
    complete nodes; then it and the nodes below it on its right edge follow.
    """
    before = min((index + 1) << level, total) - 1
    return 2 * before - before.bit_count() + level


def grown(leaves: Sequence[bytes], height: int) -> list[bytes]:
    """All nodes over some leaves in the order in which they are complete."""
    log: list[bytes] = []
    left: list[bytes] = [b""] * height
    last = len(leaves) - 1
    for r, node in enumerate(leaves):
        log.append(node)
        for level in range(height):
            if r >> level & 1:
                node = joined_hash(left[level], node)
            elif r == last:
                node = joined_hash(node)
            else:
                left[level] = node
                break
            log.append(node)
    return log


def height_of(leaves: int, total: int, bits: int) -> int:
    """Levels above the leaves of a builder; the only builder of a tier ends at the root."""
    return bits if total > 1 << bits else (leaves - 1).bit_length()


def steps(log: bytes, slot: int, leaves: int, height: int) -> bytes:
    """Siblings from a leaf to the top of a builder's log, each with its side."""
    out = []
    for level in range(height):
        index = slot >> level
        if (index ^ 1) << level >= leaves:
            out.append(_NONE + bytes(DIGEST))
            continue
        at = DIGEST * position(level, index ^ 1, leaves)
        out.append((_LEFT if index & 1 else _RIGHT) + log[at : at + DIGEST])
    return b"".join(out)


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    node = leaf
    for at in range(0, len(path), _STEP):
        side, sibling = path[at : at + 1], path[at + 1 : at + _STEP]
        node = joined_hash(node) if side == _NONE else joined_hash(sibling, node) if side == _LEFT else joined_hash(node, sibling)
    return node


def siblings_digest(path: bytes) -> str:
    """Hash of the siblings alone, from the leaf up; levels without one add nothing."""
    found = [path[at + 1 : at + _STEP] for at in range(0, len(path), _STEP) if path[at : at + 1] != _NONE]
    return joined_hash(*found).hex()


def field_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 of some columns: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``rank`` (from 0) and ``total`` in each ``tree`` by ``order``, nulls first.

    Range partitions are stored sorted; the rows of a tree in earlier partitions and the
    place in its own give a row's rank. No tree is gathered anywhere.
    """
    placed = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    stored = write_through(placed.withColumn("_id", F.monotonically_increasing_id()), "ranked")
    part, row = F.shiftright("_id", 33).alias("_part"), F.expr(f"_id & {(1 << 33) - 1}L")
    sizes = stored.groupBy("tree", part).agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("first"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "tree", "_part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    out = stored.withColumns({"_part": F.shiftright("_id", 33), "_row": row}).join(offsets, ["tree", "_part"])
    return out.withColumn("rank", F.col("_row") + F.col("_shift")).drop("_id", "_part", "_row", "_shift")


_SEGMENT = "tree string, block long, total long, leaves int, log binary, top binary"


def _segments(leaves: DataFrame, bits: int) -> DataFrame:
    """One row for each builder: its log of ``2 ** bits`` aligned leaves at most, and the last node."""
    block, slot = F.shiftright("rank", bits), F.expr(f"rank & {(1 << bits) - 1}L")
    dealt = leaves.select("tree", block.alias("block"), slot.alias("slot"), "total", "leaf")
    dealt = dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total, held = None, 0, []

        def finish() -> pa.RecordBatch:
            log = grown(held, height_of(len(held), total, bits))
            row = [[own[0]], [own[1]], [total], [len(held)], [b"".join(log)], [log[-1]]]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            names = ["tree", "block", "total", "leaves", "log", "top"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            blocks, totals = batch.column("block").to_pylist(), batch.column("total").to_pylist()
            for tree, at, n, leaf in zip(batch.column("tree").to_pylist(), blocks, totals, batch.column("leaf").to_pylist(), strict=True):
                if (tree, at) != own:
                    if held:
                        yield finish()
                    own, total, held = (tree, at), n, []
                held.append(leaf)
        if held:
            yield finish()

    return dealt.mapInArrow(run, _SEGMENT)


@dataclass(frozen=True)
class Log:
    """The builders' logs of some trees, one table for each tier, lowest first."""

    tiers: list[DataFrame]
    bits: int

    def roots(self) -> DataFrame:
        """``tree`` and its ``root``: the last node of the only builder of its last tier."""
        tops = [t.filter(F.col("total") <= 1 << self.bits).select("tree", F.col("top").alias("root")) for t in self.tiers]
        out = tops[0]
        for t in tops[1:]:
            out = out.unionByName(t)
        return out

    def paths(self, tails: DataFrame) -> DataFrame:
        """Rows ``tree, block, leaves, height, log, tail``: the lowest builders with the rest of their way to the root.

        ``tails`` has ``tree`` and ``tail``, what follows above the root of the tree.
        """
        below = None
        for tier in reversed(self.tiers):
            last = tier.filter(F.col("total") <= 1 << self.bits).join(tails, "tree")
            if below is not None:
                inner = tier.filter(F.col("total") > 1 << self.bits).join(below, ["tree", "block"])
                last = last.unionByName(inner)
            if tier is self.tiers[0]:
                return last
            below = tails_of(last, self.bits)
        raise AssertionError


def tails_of(paths: DataFrame, bits: int) -> DataFrame:
    """The way up from each leaf of a builder, which is the top of a builder below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                log, leaves, height = r["log"], r["leaves"], height_of(r["leaves"], r["total"], bits)
                ways = [steps(log, slot, leaves, height) + r["tail"] for slot in range(leaves)]
                first = r["block"] << bits
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["tree"]] * leaves), pa.array(np.arange(first, first + leaves)), pa.array(ways, pa.binary())],
                    names=["tree", "block", "tail"],
                )

    return paths.mapInArrow(run, "tree string, block long, tail binary")


def build(leaves: DataFrame, bits: int = BITS) -> Log:
    """Logs of the trees over ``tree, rank, total, leaf``; each tier has a ``2 ** bits``-th of the rows below."""
    tiers = []
    while True:
        tier = write_through(_segments(leaves, bits), "merkle")
        tiers.append(tier)
        more = tier.filter(F.col("total") > 1 << bits)
        if more.isEmpty():
            return Log(tiers, bits)
        above = F.ceil(F.col("total") / (1 << bits)).cast("bigint")
        leaves = more.select("tree", F.col("block").alias("rank"), above.alias("total"), F.col("top").alias("leaf"))


@dataclass(frozen=True)
class Manifest:
    """Ranked rows ``key, tree, rank, total, leaf, claimed``, the logs of their trees, and the same of the tree of their roots."""

    rows: DataFrame
    groups: Log
    tops: DataFrame
    roots: Log


def manifest(
    df: DataFrame, key: str = "doc_id", group: str = "lang", columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    claimed: Column | None = None, bits: int = BITS,
) -> Manifest:
    """Build the trees of ``df``: one for each value of ``group``, and one over their roots.

    A row's leaf is the ``field_hash`` of ``columns``. Leaves of a group stand in the order
    of ``key``, null first, ties by their hash, so repeated rows are leaves side by side;
    groups stand in bytewise order, null first. Null and empty values differ; texts of any
    length are hashed whole. While several nodes remain, every two neighbours become their
    hash, a last one alone becomes the hash of itself. ``claimed`` is a leaf hash to be
    proven in place of the row's own one, null for none. Other columns are not read. An
    empty table has no roots.
    """
    tree = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = df.select(
        F.col(key).alias("key"), tree.alias("tree"), field_hash([F.col(c) for c in columns]).alias("leaf"),
        (claimed if claimed is not None else F.lit(None)).cast("binary").alias("claimed"),
    )
    rows = ranked(leaves, ["key", "leaf"])
    groups = build(rows, bits)
    tops = groups.roots().select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("root").alias("leaf"))
    tops = ranked(tops, ["group"])
    return Manifest(rows, groups, tops, build(tops, bits))


def proofs(m: Manifest) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    Siblings come from the logs by computed places, in the builder that holds the row's
    leaf and then up the tiers; ``proof_sha256`` is their hash. ``folded_root`` is what the
    claimed leaf, else the row's own, gives with them; ``verified`` says that it is the root.
    """
    above = m.roots.roots().withColumn("tail", F.lit(b""))
    bits = m.groups.bits
    ways = tails_of(m.roots.paths(above.select("tree", "tail")), bits)
    groups = m.tops.join(ways, (m.tops["rank"] == ways["block"]) & (m.tops["tree"] == ways["tree"])).join(
        above.select(F.col("tree").alias("t"), "root"), m.tops["tree"] == F.col("t")
    )
    groups = write_through(groups.select(F.col("group").alias("tree"), F.col("leaf").alias("subroot"), "root", "tail"), "roots")
    logs = m.groups.paths(groups.select("tree", "tail")).join(groups.drop("tail"), "tree")
    logs = logs.select("tree", "block", "total", "leaves", "log", "tail", "subroot", "root")
    rows = m.rows.withColumn("block", F.shiftright("rank", bits)).select("tree", "block", "rank", "key", "leaf", "claimed")
    names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def prove(_, rows: pa.Table, logs: pa.Table) -> pa.Table:
        log = logs.to_pylist()[0]
        leaves, root = log["leaves"], log["root"]
        height = height_of(leaves, log["total"], bits)
        out: dict[str, list] = {n: [] for n in names}
        for rank, key, leaf, claimed in zip(*(rows.column(c).to_pylist() for c in ("rank", "key", "leaf", "claimed")), strict=True):
            path = steps(log["log"], rank & ((1 << bits) - 1), leaves, height) + log["tail"]
            top = folded(claimed or leaf, path)
            made = (key, leaf.hex(), log["subroot"].hex(), root.hex(), siblings_digest(path), top.hex(), top == root)
            for name, value in zip(names, made, strict=True):
                out[name].append(value)
        return pa.table({n: pa.array(out[n], rows.schema.field("key").type if n == "key" else None) for n in names})

    kind = m.rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, " + ", ".join(f"{n} string" for n in names[1:-1]) + ", verified boolean"
    # A builder has at most 2 ** bits leaves, so a group is bounded.
    return rows.groupBy("tree", "block").cogroup(logs.groupBy("tree", "block")).applyInArrow(prove, schema)
