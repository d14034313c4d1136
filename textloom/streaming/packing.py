"""Training rows packed across micro-batches, with the unfinished rest of each shard in the state store."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from textloom.functions.blocks import BLOCK_SIZE
from textloom.functions.hashing import HASH_BITS, seeded_hash

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GIVEN = 1 << 20  # ids that are cut into blocks together
BLOCKS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("block_no", T.LongType()),
        T.StructField("input_ids", T.ArrayType(T.IntegerType())),
    ]
)


class _Packer(StatefulProcessor):
    """One shard: its open block, the number of the next one, and the keys it has taken."""

    def __init__(self, length: int, idle_ms: int, remember_ms: int | None):
        self.length, self.idle_ms, self.remember_ms = length, idle_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(
            "open", T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("next", T.LongType())])
        )
        key, mark = (T.StructType([T.StructField(n, t)]) for n, t in (("key", T.StringType()), ("taken", T.BooleanType())))
        self.taken = handle.getMapState("taken", key, mark, self.remember_ms)

    def _blocks(self, shard: int, number: int, blocks: list) -> pd.DataFrame:
        return pd.DataFrame({"shard": [shard] * len(blocks), "block_no": range(number, number + len(blocks)), "input_ids": blocks})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """The ids of a batch wait in a file, as they come in any order; memory has their places and ``GIVEN`` ids."""
        seqs, names, sizes, latest = [], [], [], []
        with tempfile.TemporaryFile() as kept:
            for pdf in rows:
                pdf = pdf[pdf["key"].notna()]
                if not len(pdf):
                    continue  # a row without a key only moves the time on
                for ids in pdf["ids"]:
                    if ids is not None:
                        kept.write(pa.array(ids, pa.int32()).to_numpy())
                sizes.extend(-1 if ids is None else len(ids) for ids in pdf["ids"])
                seqs.append(pdf["seq"])
                names.append(pa.array(pdf["key"], pa.string()))
                latest.append(pdf["ts"].max())
            if not seqs:
                return
            order = pd.concat(seqs, ignore_index=True).sort_values(kind="stable").index
            yield from self._given(key[0], kept, order, pa.chunked_array(names).combine_chunks(), np.array(sizes))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(self.open.get()[0]):
            self.handle.registerTimer(int(max(t for t in latest if not pd.isna(t)).timestamp() * 1000) + self.idle_ms)

    def _given(self, shard: int, kept, order: pd.Index, names: pa.Array, sizes: np.ndarray) -> Iterator[pd.DataFrame]:
        """Full blocks of the rows in order; the rest becomes the open block."""
        state = self.open.get()
        held, number = ([np.array(state[0], np.int32)], state[1]) if state is not None else ([], 0)
        n, starts = sum(map(len, held)), 4 * (np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0))

        def cut() -> Iterator[pd.DataFrame]:
            nonlocal held, number, n
            flat = np.concatenate([np.empty(0, np.int32), *held])
            full = n // self.length
            held, n = [flat[full * self.length :]], n - full * self.length
            if full:
                yield self._blocks(shard, number, list(flat[: full * self.length].reshape(full, self.length)))
                number += full

        for i in order:
            name = (names[i].as_py(),)
            if sizes[i] < 0 or self.taken.containsKey(name):
                continue
            self.taken.updateValue(name, (True,))
            kept.seek(starts[i])
            held.append(np.frombuffer(kept.read(4 * sizes[i]), np.int32))
            n += len(held[-1])
            if n >= GIVEN:
                yield from cut()
        yield from cut()
        self.open.update((held[0].tolist(), number))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.open.get()
        if state is not None and len(state[0]):
            self.open.update(([], state[1] + 1))
            yield self._blocks(key[0], state[1], [list(state[0])])

    def close(self) -> None:
        pass


def pack_stream(
    docs: DataFrame, shards: int, length: int = BLOCK_SIZE, idle_seconds: int = 600, late: str = "0 seconds",
    remember_seconds: int | None = None,
) -> DataFrame:
    """Blocks ``shard, block_no, input_ids`` of a stream of ``seq, key, ids, ts``.

    The ids of a shard (an equal part of the range of the key's hash) follow each other in
    the order of ``seq``, as it is in a batch and from batch to batch, and are cut every
    ``length`` ids; what is left waits in the state store for the next batch, so batches
    that cut the input elsewhere give the same blocks. A key that comes again is dropped,
    for ever or for ``remember_seconds``. A shard without rows for ``idle_seconds`` of event
    time gives its rest as a short block; a row with a null key and a late time ends the
    input that way. Rows with null ids count for nothing. Needs the RocksDB state store.
    """
    if docs.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError("use_rocksdb(spark) before packing a stream")
    width = (1 << HASH_BITS) // shards + 1
    keyed = docs.withColumn("key", F.col("key").cast("string"))
    # The end of the input goes to every shard.
    own = F.array(F.expr(f"cast({{}} div {width}L as int)".format("_hash")))
    shard = F.when(F.col("key").isNull(), F.sequence(F.lit(0), F.lit(shards - 1))).otherwise(own)
    placed = keyed.withColumn("_hash", seeded_hash("key")).withColumn("shard", F.explode(shard)).drop("_hash")
    packer = _Packer(length, 1000 * idle_seconds, 1000 * remember_seconds if remember_seconds else None)
    return (
        placed.withWatermark("ts", late).groupBy("shard")
        .transformWithStateInPandas(packer, outputStructType=BLOCKS, outputMode="append", timeMode="eventTime")
    )


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the state of streams that start from now on in RocksDB, on disk and in the checkpoint folder."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
