"""Turning token arrays into fixed-length rows."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textloom.functions.blocks import BLOCK_SIZE, attention_mask, blocks, pad_right
from textloom.functions.hashing import HASH_BITS, SEED, seeded_hash
from textloom.functions.symbols import PAD_ID
from textloom.operators.ordering import with_offset


SHARD_TOKENS = 4 << 20  # ids that are packed together


def explode_blocks(
    df: DataFrame, ids: str = "ids", block_size: int = BLOCK_SIZE, pad_id: int = PAD_ID
) -> DataFrame:
    """One row per block: other columns, ``block_no``, ``input_ids``, ``attention_mask``.

    Documents are never mixed in a block; the last one is padded. Only the ids
    are exploded, the mask follows from their number.
    """
    rest = [F.col(c) for c in df.columns if c != ids]
    # The outer form computes the arrays once; empty ids give no block.
    parts = df.select(*rest, F.posexplode_outer(blocks(ids, block_size)).alias("block_no", "_block"))
    return parts.filter(F.col("_block").isNotNull()).select(
        *rest,
        "block_no",
        pad_right("_block", block_size, pad_id).alias("input_ids"),
        attention_mask(F.size("_block"), block_size).alias("attention_mask"),
    )


def pack_rows(
    df: DataFrame, key: str, length: int = BLOCK_SIZE, ids: str = "ids", seed: int = SEED
) -> DataFrame:
    """Concatenate all ids in seeded-hash order and cut them every ``length`` ids.

    Returns ``block_no, input_ids``; only the very last block may be short.
    ``df`` is read twice, so it should be a stored table. A block collects at
    most ``length`` pieces.
    """
    placed, _ = with_offset(df.filter(F.size(ids) > 0), key, F.size(ids), seed)
    first, last = f"offset div {length}L", f"(offset + size({ids}) - 1) div {length}L"
    piece = f"slice({ids}, int(greatest(b * {length}L - offset, 0L)) + 1, "
    piece += f"int(least((b + 1) * {length}L - offset, size({ids})) - greatest(b * {length}L - offset, 0L)))"
    cut = f"transform(sequence({first}, {last}), b -> struct(b as block_no, greatest(b * {length}L, offset) as at, {piece} as part))"
    return (
        placed.select(F.explode_outer(F.expr(cut)).alias("p"))
        .groupBy("p.block_no")
        .agg(F.array_sort(F.collect_list(F.struct("p.at", "p.part"))).alias("parts"))
        .select("block_no", F.flatten(F.transform("parts", lambda x: x["part"])).alias("input_ids"))
    )


def pad_to_longest(df: DataFrame, batch: str = "batch_id", ids: str = "ids", pad_id: int = PAD_ID) -> DataFrame:
    """Pad each row to the longest row of its batch.

    Batches have a fixed, small number of rows, so a window over one is bounded.
    """
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    return df.withColumn("_longest", longest).select(
        *[F.col(c) for c in df.columns if c != ids],
        pad_right(ids, F.col("_longest"), pad_id).alias("input_ids"),
        attention_mask(F.size(ids), F.col("_longest")).alias("attention_mask"),
    )


def shards_of(df: DataFrame, ids: str = "ids", tokens: int = SHARD_TOKENS) -> int:
    """Shards of about ``tokens`` ids; one pass over the sizes alone."""
    total = df.agg(F.sum(F.greatest(F.size(ids), F.lit(0)).cast("bigint"))).first()[0] or 0
    return max(1, -(-total // tokens))


def _in_shards(
    df: DataFrame, key: str, ids: str, shards: int, seed: int, schema: T.StructType, work: Callable
) -> DataFrame:
    """``work(shard, keys, sizes, ids)`` of each shard, its rows from the longest to the shortest, ties by hash and key.

    A shard is an equal part of the range of the key's hash, so it does not depend on how
    the input is split. The ids move once.
    """
    width = (1 << HASH_BITS) // shards + 1
    rows = df.filter(F.size(ids) > 0).select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"), F.size(ids).alias("size"))
    rows = rows.withColumn("hash", seeded_hash("key", seed=seed)).withColumn("shard", F.expr(f"cast(hash div {width}L as int)"))
    placed = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.desc("size"), "hash", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        held = pa.Table.from_batches(parts)  # a partition is one shard
        lists = held.column("ids").combine_chunks()
        yield from work(held.column("shard")[0].as_py(), held.column("key").combine_chunks(), held.column("size").to_numpy(), lists)

    return placed.select("shard", "key", "size", "ids").mapInArrow(run, schema)


def best_fit(sizes: np.ndarray, length: int) -> np.ndarray:
    """Bin of each row, rows from the longest to the shortest: the fullest bin that has room, else a new one.

    Bins with the same room are alike, so rows of one size are dealt by counts: a bin
    takes all it has room for before the next one, as it is then the fullest; of equal bins
    the first one opened comes first. Rows longer than ``length`` have a bin each.
    """
    out, bins = np.empty(len(sizes), np.int64), 0
    room: dict[int, list[np.ndarray]] = {}  # room -> runs of bins that have it
    rooms: list[int] = []
    values, first = np.unique(-sizes, return_index=True)
    for size, begin, end in zip((-values).tolist(), first.tolist(), [*first[1:].tolist(), len(sizes)][: len(first)], strict=True):
        at = begin
        while at < end:
            i = bisect_left(rooms, size)
            if i < len(rooms):
                left = rooms[i]
                chosen = np.sort(np.concatenate(room.pop(left)))
                del rooms[i]
            else:
                left = max(length, size)
                chosen = np.arange(bins, bins - (-(end - at) // (left // size)))
                bins += len(chosen)
            each = left // size
            full = min(len(chosen), -(-(end - at) // each))
            used = min(end - at, full * each)
            out[at : at + used] = np.repeat(chosen[:full], each)[:used]
            last = used - (full - 1) * each
            parts = [(left, chosen[full:]), (left - each * size, chosen[: full - (last < each)])]
            if last < each:
                parts.append((left - last * size, chosen[full - 1 : full]))
            for r, part in parts:
                if r > 0 and len(part):
                    if r not in room:
                        room[r] = []
                        insort(rooms, r)
                    room[r].append(part)
            at += used
    return out


def _gathered(lists: pa.ListArray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the rows in another order, one after another, and where each row begins."""
    taken = lists.take(pa.array(order))
    return taken.flatten().to_numpy(), np.concatenate([[0], np.cumsum(taken.value_lengths().to_numpy())])


def pack_whole(
    df: DataFrame, key: str, length: int = BLOCK_SIZE, ids: str = "ids", shards: int | None = None, seed: int = SEED
) -> DataFrame:
    """Rows of at most ``length`` ids made of whole documents: best fit, longest first.

    Columns ``shard``, ``block_no``, ``input_ids``, ``keys`` and ``lengths`` (the documents
    in a block and their numbers of ids, in order). Shards hold about ``SHARD_TOKENS``
    ids and are packed each by itself; the result depends on keys, sizes and the number of
    shards alone. A document longer than ``length`` is a block of its own and not cut.
    Rows without ids give nothing; keys should be unique.
    """
    kind = df.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()), T.StructField("block_no", T.LongType()),
            T.StructField("input_ids", T.ArrayType(T.IntegerType())), T.StructField("keys", T.ArrayType(kind)),
            T.StructField("lengths", T.ArrayType(T.IntegerType())),
        ]
    )

    def work(shard: int, keys: pa.Array, sizes: np.ndarray, lists: pa.ListArray) -> Iterator[pa.RecordBatch]:
        bins = best_fit(sizes, length)
        order = np.argsort(bins, kind="stable")
        flat, begins = _gathered(lists, order)
        numbers, first = np.unique(bins[order], return_index=True)
        cuts = pa.array(np.append(first, len(order)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(numbers), shard, np.int32)), pa.array(numbers),
                pa.ListArray.from_arrays(pa.array(begins[np.append(first, len(order))], pa.int32()), pa.array(flat)),
                pa.ListArray.from_arrays(cuts, keys.take(pa.array(order))),
                pa.ListArray.from_arrays(cuts, pa.array(sizes[order].astype(np.int32))),
            ],
            names=schema.names,
        )

    shards = shards or shards_of(df, ids)
    return _in_shards(df, key, ids, shards, seed, schema, work)


def fill_rate(blocks: DataFrame, length: int = BLOCK_SIZE) -> DataFrame:
    """``n_blocks, n_documents, n_tokens, n_long, fill``: the share of block places that hold an id, long blocks left out."""
    size = F.size("input_ids")
    fits = size <= length
    return blocks.agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum(F.size("keys")).alias("n_documents"), F.sum(size.cast("bigint")).alias("n_tokens"),
        F.count(F.when(~fits, 1)).alias("n_long"),
        (F.sum(F.when(fits, size)) / (F.count(F.when(fits, 1)) * length)).alias("fill"),
    )


def budget_batches(sizes: np.ndarray, budget: int) -> np.ndarray:
    """Batch of each row, rows from the longest to the shortest: as many as padding to the first one leaves room for."""
    out, at, batch = np.empty(len(sizes), np.int64), 0, 0
    while at < len(sizes):
        stop = min(len(sizes), at + max(1, budget // int(sizes[at])))
        out[at:stop] = batch
        at, batch = stop, batch + 1
    return out


def batches_by_tokens(
    df: DataFrame, key: str, budget: int, ids: str = "ids", pad_id: int = PAD_ID, shards: int | None = None, seed: int = SEED
) -> DataFrame:
    """Rows padded to the longest of their batch, no batch above ``budget`` ids with its padding.

    Columns ``shard``, ``batch_no``, ``key``, ``n_tokens`` and ``input_ids``. Rows of like
    length share a batch, so little is padded; a row longer than the budget is a batch of
    its own. Shards are cut and sorted as in ``pack_whole``. Rows without ids give nothing.
    """
    kind = df.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()), T.StructField("batch_no", T.LongType()), T.StructField("key", kind),
            T.StructField("n_tokens", T.IntegerType()), T.StructField("input_ids", T.ArrayType(T.IntegerType())),
        ]
    )

    def work(shard: int, keys: pa.Array, sizes: np.ndarray, lists: pa.ListArray) -> Iterator[pa.RecordBatch]:
        batch = budget_batches(sizes, budget)
        first = np.flatnonzero(np.diff(batch, prepend=-1))
        flat, begins = _gathered(lists, np.arange(len(sizes)))
        # One batch at a time: its padding is bounded by the budget.
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(sizes)][: len(first)], strict=True):
            wide = int(sizes[a])
            table = np.full((b - a, wide), pad_id, np.int32)
            table[np.arange(wide) < sizes[a:b, None]] = flat[begins[a] : begins[b]]
            offsets = pa.array(np.arange(b - a + 1) * wide, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(b - a, shard, np.int32)), pa.array(batch[a:b]), keys.slice(a, b - a),
                    pa.array(sizes[a:b].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(table.ravel())),
                ],
                names=schema.names,
            )

    shards = shards or shards_of(df, ids)
    return _in_shards(df, key, ids, shards, seed, schema, work)
