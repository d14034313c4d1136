"""Join of documents whose sets of word shingles have a Jaccard similarity of at least a threshold.

Two sets that are similar enough share a token among the first tokens of each, in
whatever global order all sets are read. Here there are several orders, all of them
rare tokens first: the first order gives the candidates, every further one must agree,
and a bitmap bounds the difference, before sets are moved and compared.

Classes, not pairs: equal sets count once. Within the bucket of a token each document is
compared with one pivot. What these links leave in different components is grouped by the
bitmaps into clusters, and the sets of a cluster are compared in cells of bounded size,
which let out only links that join what was apart. No link that could join two components
is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textloom.llm.components import connected_components
from textloom.llm.forest import joined, whole_groups
from textloom.llm.words import SHINGLE, mixed, shingle_sets
from textloom.operators.skew import attach_group_values
from textloom.workspace import write_through

PERCENT = 80
ORDERS = 2
COUNT_BITS = 22  # buckets of the frequency table; its size is fixed
FREQUENT = 32  # tokens of rarer buckets are all alike
SALTED = 12  # buckets of more than 2 ** SALTED documents are dealt over several tasks
SIGNATURE = 4096  # bits; the longer a set, the less a short bitmap tells
BLOCK = 1024
TOKENS = 1 << 20  # of the sets that meet in one half of a cell
SPACED = 4  # bits of a wide bitmap for each token of the longest set of its class
FILTER_BITS = 27


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some rows, their sets one after another, and the bounds of the sets."""
    for batch in batches:
        for rows, tokens, bounds in shingle_sets(batch.column("text"), size):
            yield batch.slice(rows.start, rows.stop - rows.start), tokens, bounds


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def token_frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """Power of two of the document count of each bucket of tokens, 0 below ``FREQUENT``.

    A task sends only buckets that stand out among its own, so rare tokens cost nothing.
    The table orders tokens; how exact it is has no effect on any result.
    """

    def run(batches):
        counts, total = np.zeros(1 << COUNT_BITS, np.int64), 0
        for _, tokens, _ in _sets(batches, size):
            np.add.at(counts, (tokens & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64), 1)
            total += len(tokens)
        mean = total / len(counts)
        at = np.flatnonzero(counts > mean + 4 * mean**0.5 + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    sums = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = sums.filter(F.col("n") >= FREQUENT).toArrow()  # at most 2 ** COUNT_BITS
    table = np.zeros(1 << COUNT_BITS, np.uint8)
    table[rows["bucket"].to_numpy()] = np.log2(rows["n"].to_numpy()).astype(np.uint8) + 1
    return table


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _features(docs: DataFrame, size: int) -> DataFrame:
    """Size, 128-bit digest and bitmap of each set."""
    schema = "key long, n long, d1 long, d2 long, sig array<long>"

    def run(batches):
        for batch, tokens, bounds in _sets(batches, size):
            count = batch.num_rows
            digests = np.empty((count, 2), np.int64)
            bits = np.zeros((count, SIGNATURE), np.uint8)
            spot = ((tokens >> np.uint64(COUNT_BITS)) % np.uint64(SIGNATURE)).astype(np.int64)
            bits[np.repeat(np.arange(count), np.diff(bounds)), spot] = 1
            sig = np.packbits(bits, axis=1).view(np.int64)
            for i in range(count):
                digests[i] = np.frombuffer(xxhash.xxh3_128_digest(tokens[bounds[i] : bounds[i + 1]]), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.diff(bounds)), pa.array(digests[:, 0]), pa.array(digests[:, 1]), _lists(list(sig), pa.int64())],
                names=["key", "n", "d1", "d2", "sig"],
            )

    return docs.select("key", "text").mapInArrow(run, schema)


def _often(tokens: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[(tokens & np.uint64(len(table) - 1)).astype(np.int64)]


def _prefix(tokens: np.ndarray, often: np.ndarray, order: int, percent: int) -> np.ndarray:
    """Positions of the first tokens of a set: rare ones first, then by the hash of this order."""
    if not len(tokens):
        return np.empty(0, np.int64)
    k = prefix_length(len(tokens), percent)
    plain = not often.any()
    if order == 1:  # sets are sorted by it
        return np.arange(k) if plain else np.lexsort((tokens, often))[:k]
    other = mixed(tokens * np.uint64(2 * order + 1) + np.uint64(0x5851F42D4C957F2D))
    return np.argpartition(other, k - 1)[:k] if plain else np.lexsort((other, often))[:k]


def _first_tokens(docs: DataFrame, table: np.ndarray, size: int, percent: int) -> DataFrame:
    """The first tokens ``t`` of each set under the first order; ``s`` deals frequent ones over several tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        table = shared.value
        for batch, tokens, bounds in _sets(batches, size):
            often = _often(tokens, table)
            firsts, salts = [], []
            for i, key in enumerate(batch.column("key").to_pylist()):
                s, o = tokens[bounds[i] : bounds[i + 1]], often[bounds[i] : bounds[i + 1]]
                at = _prefix(s, o, 1, percent)
                firsts.append(s[at].view(np.int64))
                width = np.left_shift(1, np.maximum(o[at].astype(np.int64) - SALTED, 0))
                own = xxhash.xxh3_64_intdigest(str(key)) & 0x7FFFFFFF
                salts.append(np.where(width > 1, 1 + own % width, 0).astype(np.int32))
            t, z = _lists(firsts, pa.int64()), _lists(salts, pa.int32())
            pairs = pa.StructArray.from_arrays([t.values, z.values], names=["t", "s"])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(t.offsets, pairs)], names=["key", "p"])

    return docs.select("key", "text").mapInArrow(run, "key long, p array<struct<t:long,s:int>>")


def _alike_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _least_shared(na, nb, percent: int):
    """Smallest intersection with which two sets of these sizes are linked."""
    return (percent * (na + nb) + 99 + percent) // (100 + percent)


def bounded(pairs: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` that pass the sizes and the bitmaps."""
    small = features.select("key", "n", "sig")
    x = small.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    y = small.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    both = pairs.join(x, "a").join(y, "b").filter(_alike_size(F.col("na"), F.col("nb"), percent))

    def only(p: str, q: str) -> Column:
        """At least so many elements of the first set are missing in the second."""
        each = F.zip_with(p, q, lambda u, v: F.bit_count(u.bitwiseAND(F.bitwise_not(v))))
        return F.aggregate(each, F.lit(0), lambda acc, v: acc + v)

    shared = F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")
    both = both.filter((only("sa", "sb") <= F.col("na") - shared) & (only("sb", "sa") <= F.col("nb") - shared))
    return both.select("a", "b")


def _of_pairs(pairs: DataFrame, docs: DataFrame, size: int, kind: str, column) -> DataFrame:
    """``key`` and ``value``, made by ``column`` from sets, of the documents of stored ``pairs``.

    A bitmap of hashed keys, whose size is bounded, keeps other documents from leaving
    the scan; the joins that follow remove what it lets through.
    """
    ids = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    bits = min(FILTER_BITS, max(16, (16 * pairs.count()).bit_length()))
    spot = F.pmod(F.xxhash64("key"), F.lit(1 << bits))
    words = (
        ids.select(F.shiftright(spot, 6).alias("w"), F.expr("shiftleft(1L, cast(pmod(xxhash64(key), 64) as int))").alias("m"))
        .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    )
    known = np.zeros(1 << (bits - 6), np.int64)
    known[words["w"].to_numpy()] = words["m"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        known = shared.value
        for whole in batches:
            spots = whole.column("spot").to_numpy()
            inside = (known[spots >> 6] >> (spots & 63)) & 1 == 1
            for batch, tokens, bounds in _sets([whole.filter(pa.array(inside))], size):
                sets = [tokens[bounds[i] : bounds[i + 1]] for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([batch.column("key"), column(sets)], names=["key", "value"])

    return docs.select("key", "text", spot.alias("spot")).mapInArrow(run, f"key long, value {kind}")


def _joined(pairs: DataFrame, values: DataFrame) -> DataFrame:
    x, y = (values.select(F.col("key").alias(f"{c}_key"), F.col("value").alias(f"{c}_value")) for c in ("a", "b"))
    return pairs.join(x, F.col("a") == F.col("a_key")).join(y, F.col("b") == F.col("b_key"))


def verified(
    pairs: DataFrame, docs: DataFrame, size: int, percent: int, table: np.ndarray | None = None, orders: int = 1
) -> DataFrame:
    """Pairs that every further order lets through and whose whole sets are similar enough.

    The first tokens under a further order travel as 32-bit values, a tenth of a set, so
    they go first; equal tokens have equal values, so no pair is lost.
    """
    pairs = write_through(pairs, "pairs")
    if orders > 1:
        shared = docs.sparkSession.sparkContext.broadcast(table)

        def firsts(sets: list[np.ndarray]) -> pa.Array:
            rows = [
                [
                    (mixed(s[_prefix(s, _often(s, shared.value), o, percent)]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    for o in range(2, orders + 1)
                ]
                for s in sets
            ]
            return pa.array(rows, pa.list_(pa.list_(pa.int32())))

        both = _joined(pairs, _of_pairs(pairs, docs, size, "array<array<int>>", firsts))
        for i in range(orders - 1):
            both = both.filter(F.arrays_overlap(F.col("a_value")[i], F.col("b_value")[i]))
        pairs = write_through(both.select("a", "b").distinct(), "pairs")
    both = _joined(pairs, _of_pairs(pairs, docs, size, "array<long>", lambda sets: _lists([s.view(np.int64) for s in sets], pa.int64())))
    common = F.size(F.array_intersect("a_value", "b_value"))
    union = F.size("a_value") + F.size("b_value") - common
    return both.filter(common * 100 >= union * percent).select("a", "b").distinct()


def ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    pairs = pairs.filter(F.col(x) != F.col(y))
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def candidate_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``x, y`` between components that have documents which the bitmaps let through in one bucket.

    ``rows`` has the bucket ``t``, its part ``c`` with bitmaps of one width, and the number of
    its documents ``size``; a part is cut into blocks of about ``BLOCK`` documents, so a task
    never holds more than two. Two blocks let out only links that join what was apart in
    them: fewer than they have rows.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select(
        "t", "c", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "n", "component", "sig"
    )
    dealt = dealt.repartition("t", "c", "i", "j").sortWithinPartitions("t", "c", "i", "j")

    def compare(part, n, own, sig) -> Iterator[tuple[int, np.ndarray]]:
        names, label = np.unique(part, return_inverse=True)
        order = np.argsort(n, kind="stable")
        n, label, sig, own = n[order], label[order], sig[order], own[order]
        parent, across = np.arange(len(names)), (own != own[0]).any()
        stop = np.searchsorted(n, n * 100 // percent, "right")
        for r in range(len(n) - 1):
            if not parent.any():
                return
            root = parent[label[r : stop[r]]]
            apart = root != root[0]
            if across:
                apart &= own[r : stop[r]] != own[r]
            at = np.flatnonzero(apart) + r
            # The first words of the bitmaps settle most pairs.
            for words in (8, sig.shape[1]):
                if len(at):
                    need = _least_shared(n[r], n[at], percent)
                    a, b = sig[r, :words], sig[at, :words]
                    only = np.bitwise_count(a & ~b).sum(1, dtype=np.int64) <= n[r] - need
                    only &= np.bitwise_count(b & ~a).sum(1, dtype=np.int64) <= n[at] - need
                    at = at[only]
            if len(at):
                others = np.unique(parent[label[at]])
                yield names[root[0]], names[others]
                parent = joined(parent, np.full(len(others), root[0]), others)

    def run(batches):
        for table, cuts in whole_groups(batches, ("t", "c", "i", "j")):
            part, n, own = (table.column(c).to_numpy() for c in ("component", "n", "own"))
            lists = table.column("sig").combine_chunks()
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            sig = lists.flatten().to_numpy().view(np.uint64)
            x, y = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for s, e in zip(cuts, cuts[1:]):
                if e - s > 1 and (part[s:e] != part[s]).any():
                    for one, others in compare(part[s:e], n[s:e], own[s:e], sig[at[s] : at[e]].reshape(e - s, -1)):
                        x.append(np.full(len(others), one))
                        y.append(others)
            pairs = np.unique(np.stack([np.concatenate(x), np.concatenate(y)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["x", "y"])

    return dealt.mapInArrow(run, "x long, y long")


def _wide_bitmaps(sets: list[np.ndarray], percent: int) -> pa.ListArray:
    """Class ``c``, size ``n`` and bitmap of each set, in every class that a set it may be linked with is the smaller one of.

    A class has the sets of ``2 ** c`` to below ``2 ** (c + 1)`` tokens and larger ones that
    are alike in size; its bitmaps are as wide as its sets are long.
    """
    found, ends = [], [0]
    for s in sets:
        top = len(s).bit_length() - 1
        for c in range(top, -1, -1):
            if c < top and ((2 << c) - 1) * 100 < len(s) * percent:
                break
            bits = np.zeros(max(SIGNATURE, SPACED * 2 << c), np.uint8)
            bits[((s >> np.uint64(COUNT_BITS)) % np.uint64(len(bits))).astype(np.int64)] = 1
            found.append((c, len(s), np.packbits(bits).view(np.int64)))
        ends.append(len(found))
    rows = [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int64()), _lists([x[2] for x in found], pa.int64())]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(rows, names=["c", "n", "sig"]))


def _split_clusters(part: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``part`` with clusters of more than ``TOKENS`` tokens cut by wide bitmaps.

    The bitmaps of all sets are nearly full for long ones and tell nothing about them, so
    all long sets that share a token form one cluster. Its sets would meet in a number of
    cells that grows with the square of the cluster; wide bitmaps, a sixteenth of the sets,
    leave only those together that may be similar. They are compared in blocks of at most
    8 MB and four times ``BLOCK`` documents.
    """
    sums = part.groupBy("cluster").agg(F.sum("n").alias("tokens"))
    names = F.broadcast(sums.filter(F.col("tokens") > TOKENS).select("cluster"))  # at most one for each TOKENS tokens
    large = write_through(part.join(names, "cluster"), "clusters")
    if large.isEmpty():
        return part
    keys = large.select(F.col("key").alias("a"), F.col("key").alias("b"))
    kind = "array<struct<c:int,n:long,sig:array<long>>>"
    wide = _of_pairs(keys, docs, size, kind, lambda sets: _wide_bitmaps(sets, percent)).join(large.drop("n"), "key")
    wide = wide.select(F.col("cluster").alias("t"), "key", "component", F.explode("value").alias("v"))
    wide = write_through(wide.select("t", "key", "component", "v.c", "v.n", "v.sig"), "bitmaps")
    weight = F.greatest(F.lit(0.25), F.max(F.size("sig")) / BLOCK)
    counts = wide.groupBy("t", "c").agg((F.count(F.lit(1)) * weight).alias("size"))
    rows = wide.join(F.broadcast(counts), ["t", "c"])
    clusters = connected_components(write_through(candidate_links(rows, percent), "links"), "x", "y")
    clusters = clusters.select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    rest = part.join(names, "cluster", "left_anti")
    return write_through(rest.unionByName(large.drop("cluster").join(clusters, "component")), "clusters")


def _cells(part: DataFrame) -> DataFrame:
    """``key, component, block, cells``: the tasks in which the documents of a cluster meet those of its other components.

    ``part`` has ``key, component, cluster`` and the size ``n``. A component with more than
    ``TOKENS`` tokens has blocks of its own, which need not meet each other; smaller ones
    share blocks. Every two other blocks of a cluster, and each shared block, are a cell.
    """
    sums = part.groupBy("cluster", "component").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    sums = write_through(sums.withColumn("owner", F.when(F.col("tokens") > TOKENS, F.col("component"))), "clusters")
    width = F.ceil(F.sum("tokens") / TOKENS).cast("int").alias("width")
    shared = sums.filter("owner is null").groupBy("cluster").agg(width)
    own = sums.filter("owner is not null").groupBy("cluster", "component", "owner", "rows").agg(width)
    widths = own.select("component", "rows", "owner", "width").unionByName(
        sums.filter("owner is null").join(shared, "cluster").select("component", "rows", "owner", "width")
    )
    placed = attach_group_values(part, widths, "component", "rows", "key")
    slot = F.pmod(F.xxhash64(F.when(F.col("owner").isNull(), F.col("component")).otherwise(F.col("key"))), F.col("width"))
    block = F.xxhash64("cluster", F.col("owner").isNull(), F.coalesce("owner", F.lit(0)), slot)
    placed = write_through(placed.withColumn("block", block).select("key", "component", "cluster", "owner", "block"), "blocks")
    blocks = placed.select("cluster", "owner", "block").distinct()
    other = blocks.select("cluster", F.col("owner").alias("owner2"), F.col("block").alias("block2"))
    pairs = blocks.join(other, "cluster").filter("block <= block2 and (owner is null or owner2 is null or owner != owner2)")
    both = F.explode(F.array_distinct(F.array("block", "block2"))).alias("block")
    cells = pairs.select(F.xxhash64("block", "block2").alias("cell"), both).groupBy("block").agg(F.collect_set("cell").alias("cells"))
    return placed.select("key", "component", "block").join(cells, "block")


def _linked_in(tokens, bounds, part, block, percent: int, table, orders: int) -> Iterator[tuple[int, int]]:
    """Places of documents of one cell that are similar enough, no more than join what was apart."""
    sizes, count = np.diff(bounds), len(part)
    _, label = np.unique(part, return_inverse=True)
    parent, across = np.arange(int(label.max()) + 1), (block != block[0]).any()
    doc = np.repeat(np.arange(count), sizes)
    _, ids = np.unique(tokens, return_inverse=True)

    def postings(chosen: np.ndarray):
        """For each document, how many of its chosen tokens every document has chosen too."""
        which = np.flatnonzero(chosen)
        which = which[np.argsort(ids[which], kind="stable")]
        ends = np.cumsum(np.bincount(ids[which], minlength=int(ids.max()) + 1))
        begins = np.concatenate([[0], ends[:-1]])

        def shared(r: int) -> np.ndarray:
            own = ids[bounds[r] : bounds[r + 1]][chosen[bounds[r] : bounds[r + 1]]]
            n = ends[own] - begins[own]
            at = np.repeat(begins[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            return np.bincount(doc[which[at]], minlength=count)

        return shared

    filters = []
    for order in range(2, orders + 1):
        chosen = np.zeros(len(tokens), bool)
        for r in range(count):
            s = tokens[bounds[r] : bounds[r + 1]]
            chosen[bounds[r] + _prefix(s, _often(s, table), order, percent)] = True
        filters.append(postings(chosen))
    whole = postings(np.ones(len(tokens), bool))
    for r in range(count - 1):
        if not parent.any():
            return
        root = parent[label]
        may = (root != root[r]) & (np.minimum(sizes, sizes[r]) * 100 >= np.maximum(sizes, sizes[r]) * percent)
        may[: r + 1] = False
        if across:
            may &= block != block[r]
        for share in filters:
            if may.any():
                may &= share(r) > 0
        if not may.any():
            continue
        common = whole(r)
        at = np.flatnonzero(may & (common * 100 >= (sizes + sizes[r] - common) * percent))
        if len(at):
            others, first = np.unique(root[at], return_index=True)
            yield from ((r, int(j)) for j in at[first])
            parent = joined(parent, np.full(len(others), root[r]), others)


def block_links(
    buckets: DataFrame, features: DataFrame, docs: DataFrame, size: int, percent: int,
    table: np.ndarray | None = None, orders: int = 1,
) -> DataFrame:
    """Links ``a, b`` of similar enough documents that join all components which such links join.

    ``buckets`` has documents ``key`` of known ``component`` by their buckets ``t`` with
    the number ``size`` of documents, ``features`` the size ``n`` and bitmap ``sig`` of a
    document. What ``candidate_links`` connect is a cluster; large ones are cut by wider
    bitmaps. The sets of a cluster meet in cells of bounded size, where every further order
    is asked and whole sets are compared.
    """
    buckets = write_through(buckets.select("t", "size", "key", "component"), "buckets")
    rows = buckets.join(features.select("key", "n", "sig"), "key").withColumn("c", F.lit(0))
    clusters = connected_components(write_through(candidate_links(rows, percent), "links"), "x", "y")
    clusters = clusters.select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    part = buckets.select("key", "component").distinct().join(clusters, "component")
    part = part.join(features.groupBy("key").agg(F.max("n").alias("n")), "key")
    part = _split_clusters(write_through(part, "clusters"), docs, size, percent)
    cells = write_through(_cells(part), "cells")
    keys = cells.select(F.col("key").alias("a"), F.col("key").alias("b"))
    sets = _of_pairs(keys, docs, size, "array<long>", lambda sets: _lists([s.view(np.int64) for s in sets], pa.int64()))
    dealt = cells.join(sets, "key").select(F.explode("cells").alias("cell"), "key", "component", "block", "value")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell")
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for group, cuts in whole_groups(batches, ("cell",)):
            key, part, block = (group.column(c).to_numpy() for c in ("key", "component", "block"))
            value = group.column("value").combine_chunks()
            bounds = np.concatenate([[0], np.cumsum(value.value_lengths().to_numpy())])
            tokens = value.flatten().to_numpy().view(np.uint64)
            pairs = []
            for s, e in zip(cuts, cuts[1:]):
                own = bounds[s : e + 1] - bounds[s]
                if (part[s:e] != part[s]).any():
                    found = _linked_in(tokens[bounds[s] : bounds[e]], own, part[s:e], block[s:e], percent, shared.value, orders)
                    pairs += [(int(key[s + i]), int(key[s + j])) for i, j in found]
            a, b = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return ordered(dealt.mapInArrow(run, "a long, b long"), "a", "b")


def similar_components(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT, orders: int = ORDERS
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row of ``df``.

    Words are runs of other characters than space and U+0009 to U+000D, with A to Z in
    lower case; the set has the distinct runs of ``size`` words, or the whole sequence if
    it is shorter. Two documents are linked when ``100 * intersection >= percent * union``;
    the component is the smallest key reachable. Null and empty texts have no shingle and
    are linked with nothing. ``key`` is an integer; rows with a null key keep their count
    and have no component. Rows that repeat a key are one document whose links are those
    of all its texts; each row is returned. Only the two columns are read, so others
    cannot clash. An empty table gives an empty result.
    """
    docs = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    table = token_frequencies(docs, size)
    features = write_through(_features(docs, size), "features")
    keyed = features.filter("key is not null and n > 0")
    # Equal sets: one representative goes on.
    classes = keyed.groupBy("d1", "d2").agg(F.min("key").alias("rep"))
    copies = keyed.select("key", "d1", "d2").join(classes, ["d1", "d2"])
    links = ordered(copies, "key", "rep")
    reps = keyed.join(
        classes.select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.col("rep").alias("key")), "key"
    ).filter("d1 = e1 and d2 = e2").select(F.col("key").alias("rep")).distinct()
    firsts = _first_tokens(docs, table, size, percent).join(reps, F.col("key") == F.col("rep"), "left_semi")
    postings = firsts.select("key", F.explode("p").alias("p")).select("key", "p.t", "p.s")
    bucket = Window.partitionBy("t", "s")
    marked = postings.select(
        "*",
        F.count(F.lit(1)).over(bucket).alias("size"),
        F.min(F.struct(F.xxhash64("key").alias("h"), F.col("key").alias("k"))).over(bucket)["k"].alias("pivot"),
    )
    shared = write_through(marked.filter("size > 1 or s > 0"), "postings")
    # Where a bucket is dealt over several tasks, its pivots are compared with one of them.
    tops = shared.filter("s > 0").select("t", "pivot").distinct()
    top = tops.groupBy("t").agg(F.min("pivot").alias("top"))
    stars = ordered(shared, "key", "pivot").unionByName(ordered(tops.join(top, "t"), "pivot", "top")).distinct()
    near = write_through(verified(bounded(stars, features, percent), docs, size, percent, table, orders), "links")
    links = write_through(links.unionByName(near), "links")

    # What is still apart although it shares a token: buckets of three and more with several components.
    known = connected_components(links)
    apart = (
        shared.select("t", "s", "key").join(known.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    mixed_up = (
        apart.groupBy("t")
        .agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("x"), F.max("component").alias("y"))
        .filter("x != y and size > 2")
        .select("t", "size")
    )
    far = write_through(block_links(apart.join(mixed_up, "t"), features, docs, size, percent, table, orders), "links")
    found = connected_components(links.unionByName(far))
    out = features.select("key", F.col("n").alias("n_shingles")).join(found, F.col("key") == F.col("node"), "left")
    return out.select(F.col("key").alias(key), "n_shingles", F.coalesce("component", "key").alias("component_id"))
