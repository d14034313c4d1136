"""Token ids in training order: fixed-length sequences at keyed random slots of fixed-stride shards."""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.bpe import of_worker
from textloom.workspace import fresh_path

LENGTH = 2048
PER_SHARD = 4096
PRIMING, PRIMING_ROWS = 64 * 1024, 64  # bytes and rows that prime the compression of moved sequences
PART = 1 << 15  # characters that are encoded together
CUT = re.compile(r"(?<=\S) (?=\S)")
HEADER = "<QII"  # slot, tokens in use, CRC of the padded ids
MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Feistel:
    """Keyed permutation of 0..size-1: a balanced Feistel network over the next even power of two,
    walked until the value is in range again."""

    size: int
    key: int
    rounds: int = 6

    def _keys(self) -> list[int]:
        digest = hashlib.sha512(f"{self.key}:{self.size}".encode()).digest()
        return [int.from_bytes(digest[8 * i : 8 * i + 8], "little") | 1 for i in range(self.rounds)]

    def _once(self, x: np.ndarray, keys: list[int], half: int) -> np.ndarray:
        bits, low = np.uint64(half), np.uint64((1 << half) - 1)
        left, right = x >> bits, x & low
        for k in keys:
            f = (right + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(32))) * np.uint64(k)
            left, right = right, left ^ ((f >> np.uint64(32)) & low)
        return (left << bits) | right

    def slots(self, index: np.ndarray) -> np.ndarray:
        """Slot of each index; every index below ``size`` has its own slot below ``size``."""
        x, keys = np.asarray(index, np.uint64), self._keys()
        half = max(1, (max(self.size - 1, 1).bit_length() + 1) // 2)
        x = self._once(x, keys, half)
        while (out := x >= self.size).any():
            x[out] = self._once(x[out], keys, half)
        return x.astype(np.int64)


def token_encoder(vocabulary):
    """Whole text to ids of a vocabulary with fewer than 65,536 tokens, as bytes.

    A pretoken begins at a single space between two other characters, so a long text is
    cut there and the ids of a bounded run are held as numbers at a time.
    """
    encode = of_worker("training order", hash(vocabulary), lambda: vocabulary.model().encode_ordinary)

    def run(text: str) -> bytes:
        out, at = [], 0
        while len(text) - at > PART and (cut := CUT.search(text, at + PART)):
            out.append(array("H", encode(text[at : cut.start()])).tobytes())
            at = cut.start()
        out.append(array("H", encode(text[at:])).tobytes())
        return b"".join(out)

    return run


def codec(df: DataFrame, vocabulary, text: str) -> bytes:
    """Content that primes the compression of stored sequences: ids of a few rows, of fixed size.

    It makes them smaller while they are moved and has no other effect.
    """
    encode, made = token_encoder(vocabulary), b""
    for row in df.select(text).filter(F.col(text).isNotNull()).limit(PRIMING_ROWS).collect():
        made += encode(row[0])[: PRIMING // 32]
    return made[:PRIMING]


def _primed(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 64 else None


def sequences(
    df: DataFrame, vocabulary, eos: int, key: str, text: str, length: int = LENGTH, priming: bytes = b""
) -> DataFrame:
    """Sequences of ``length`` ids: the texts of a partition one after another, each with ``eos`` behind it.

    Columns ``payload`` (zstd of little-endian 16-bit ids, the last sequence of a partition
    padded with ``eos``), ``n_tokens`` and ``keys`` (of the rows with tokens in it). Null
    and empty texts give their ``eos`` alone; repeated rows are repeated.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    kind = df.schema[key].dataType
    schema = T.StructType(
        [T.StructField("payload", T.BinaryType()), T.StructField("n_tokens", T.IntegerType()),
         T.StructField("keys", T.ArrayType(kind))]
    )
    end, size = struct.pack("<H", eos), 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        encode = token_encoder(shared.value)
        pack = zstandard.ZstdCompressor(6, dict_data=_primed(priming)).compress
        buffer, keys = bytearray(), []

        def cut(final: bool = False) -> pa.RecordBatch:
            nonlocal buffer, keys
            rows = []
            at = 0
            while at + size <= len(buffer) or final and at < len(buffer):
                piece = bytes(buffer[at : at + size])
                inside = [k for k, stop, start in keys if start < at + size and stop > at]
                rows.append((pack(piece + end * ((size - len(piece)) // 2)), len(piece) // 2, inside))
                at += size
                keys = [k for k in keys if k[1] > at]
            buffer = buffer[at:]
            keys = [(k, stop - at, start - at) for k, stop, start in keys]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = len(buffer)
                buffer += encode(t or "") + end
                keys.append((k, len(buffer), start))
                if len(buffer) >= 64 * size:
                    yield cut()
        yield cut(final=True)

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def write_in_training_order(
    df: DataFrame, path: str, vocabulary, eos: int, key: str = "doc_id", text: str = "text",
    seed: int = 42, length: int = LENGTH, per_shard: int = PER_SHARD,
) -> DataFrame:
    """Write shards of fixed stride below ``path`` and return one row for each sequence.

    A record is slot, token count and CRC, then ``length`` unsigned 16-bit ids and a
    line end; slot s is record ``s % per_shard`` of folder ``shard=s // per_shard``, so a
    reader that stopped goes on at any slot with one seek. Sequences are stored once,
    which makes their numbering final; a lost executor repeats its own part only. An
    empty table gives no shard and no row.

    Columns: ``slot``, ``shard``, ``byte_offset``, ``n_tokens``, ``keys``.
    """
    spark = df.sparkSession
    stored = fresh_path(spark, "sequences")
    priming = codec(df, vocabulary, text)
    sequences(df, vocabulary, eos, key, text, length, priming).write.option("compression", "none").parquet(stored)
    rows = spark.read.parquet(stored).select("*", "_metadata.file_name", "_metadata.row_index")
    # One count for each written file, so as many as there were tasks.
    sizes = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).orderBy("file_name").collect()
    before, total = {}, 0
    for r in sizes:
        before[r.file_name], total = total, total + r.n
    shared = spark.sparkContext.broadcast(before)
    placed = T.StructType(
        [T.StructField("slot", T.LongType()), T.StructField("n_tokens", T.IntegerType()),
         T.StructField("payload", T.BinaryType()), T.StructField("keys", rows.schema["keys"].dataType)]
    )
    order = Feistel(max(total, 1), seed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column("file_name").to_pylist()
            index = np.array([shared.value[n] for n in names], np.int64) + b.column("row_index").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(order.slots(index)), b.column("n_tokens"), b.column("payload"), b.column("keys")],
                names=placed.names,
            )

    shard = F.floor(F.col("slot") / per_shard).cast("bigint")
    slotted = rows.mapInArrow(place, placed)
    shards = -(-total // per_shard)
    # Neighbouring shards share a task where there are more shards than tasks.
    tasks = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = (
        slotted.select("slot", "n_tokens", "payload")
        .withColumn("shard", shard)
        .repartitionByRange(tasks, "shard")
        .sortWithinPartitions("shard", "slot")
    )
    lines = T.StructType([T.StructField("value", T.BinaryType()), T.StructField("shard", T.LongType())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        unpack = zstandard.ZstdDecompressor(dict_data=_primed(priming)).decompress
        for b in batches:
            made = []
            for s, n, p in zip(*(b.column(c).to_pylist() for c in ("slot", "n_tokens", "payload")), strict=True):
                ids = unpack(p)
                made.append(struct.pack(HEADER, s, n, zlib.crc32(ids)) + ids)
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()), b.column("shard")], names=lines.names)

    raw = dealt.mapInArrow(records, lines)
    raw.select(F.col("value").cast("string").alias("value"), "shard").write.mode("overwrite").partitionBy("shard").option("lineSep", "\n").text(path)
    stride = struct.calcsize(HEADER) + 2 * length + 1
    return slotted.select(
        "slot", shard.alias("shard"), (F.col("slot") % per_shard * stride).alias("byte_offset"), "n_tokens", "keys"
    )


def read_records(spark: SparkSession, path: str, first: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """Records of slots ``first`` to ``first + count - 1``: ``slot``, ``n_tokens``, ``crc``, ``ids``, by slot.

    Only the shard folders of the range are read; each shard is one file of at most
    ``per_shard`` records.
    """
    stride = struct.calcsize(HEADER) + 2 * length + 1
    last = first + max(count, 1) - 1
    files = spark.read.format("binaryFile").load(path).filter(F.col("shard").between(first // per_shard, last // per_shard))
    schema = "slot long, n_tokens int, crc long, ids array<int>"

    def run(batches):
        for b in batches:
            for content in b.column("content").to_pylist():
                rows = []
                for at in range(0, len(content), stride):
                    slot, n, crc = struct.unpack_from(HEADER, content, at)
                    if first <= slot < first + count:
                        ids = np.frombuffer(content, "<u2", length, at + struct.calcsize(HEADER))[:n].tolist()
                        rows.append((slot, n, crc, ids))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["slot", "n_tokens", "crc", "ids"])

    return files.select("content").mapInArrow(run, schema).orderBy("slot")
