"""Slices, samples, splits, shuffles and row numbers without a global sort.

Spark rows have no order, so "order" always means the order of a unique key or
of its seeded hash. Taking the first k rows of an order is done by finding the
key of the k-th row with a few counting passes over the key column alone; the
data itself is then only filtered, not moved.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textloom.functions.hashing import HASH_BITS, SEED, seeded_hash

PIVOTS = 31
SORT_ROWS = 100_000
BUCKET_BITS = 16
ROWS_PER_BUCKET = 250_000
SHARD_BYTES = 64 << 20  # of stored files; what a task holds of them is a few times as large
_HASH = "_order_hash"


def kth_key(df: DataFrame, order: list[str], rank: Callable[[int], int]) -> tuple[tuple | None, int]:
    """Values of ``order`` at the ``rank(n)``-th row (1-based), and the row count ``n``.

    Works for columns of any ordered type; nulls come first. A few sampled values cut
    the rest into ranges between them; rows before each and up to it are counted exactly.
    Where the rank falls on a sampled value, however often it stands there, that is the
    key; else the rest is what lies between two of them, until it has at most
    ``SORT_ROWS`` rows. Which values are sampled has no effect on the result. The key is
    None when the rank is 0 or beyond the last row.
    """
    value = F.struct(*[F.col(c) for c in order])
    rest = df.select(value.alias("v"))
    total = rest.count()
    k = rank(total)
    if k <= 0 or k > total:
        return None, total
    left, rounds = total, 0
    while left > SORT_ROWS:
        rounds += 1  # another sample each time, also where the last one had no row
        share = min(1.0, 16.0 * PIVOTS / left)
        drawn = [r.v for r in rest.sample(share, seed=left + rounds).orderBy("v").limit(64 * PIVOTS).collect()]
        pivots = list(dict.fromkeys(drawn[i * len(drawn) // (PIVOTS + 1)] for i in range(1, PIVOTS + 1))) if drawn else []
        if not pivots:
            continue
        bounds = [_literal(p, df, order) for p in pivots]
        counts = rest.agg(
            *[F.count(F.when(F.col("v") < p, 1)).alias(f"b{i}") for i, p in enumerate(bounds)],
            *[F.count(F.when(F.col("v") <= p, 1)).alias(f"n{i}") for i, p in enumerate(bounds)],
        ).first()
        at = next((i for i in range(len(bounds)) if counts[f"n{i}"] >= k), len(bounds))
        if at < len(bounds) and counts[f"b{at}"] < k:
            return tuple(pivots[at]), total
        before = counts[f"n{at - 1}"] if at else 0
        if at < len(bounds):
            rest = rest.filter(F.col("v") < bounds[at])
        if at:
            rest = rest.filter(F.col("v") > bounds[at - 1])
        left, k = (counts[f"b{at}"] if at < len(bounds) else left) - before, k - before
    row = rest.orderBy("v").limit(k).agg(F.max("v").alias("v")).first().v  # k is at most SORT_ROWS
    return tuple(row), total


def _literal(values: tuple, df: DataFrame, order: list[str]) -> Column:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(order, values, strict=True)])


def _at_or_before(df: DataFrame, order: list[str], key: tuple) -> Column:
    """Rows whose ``order`` columns come at or before ``key``; written so that a scan can use it."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cond = F.lit(True)
    for name, value in reversed(list(zip(order, key, strict=True))):
        col, here = F.col(name), F.lit(value).cast(kinds[name])
        if value is None:
            cond = col.isNull() & cond
        elif name == order[-1]:
            cond = col.isNull() | (col <= here)
        else:
            cond = col.isNull() | (col < here) | ((col == here) & cond)
    return cond


def _first_rows(df: DataFrame, order: list[str], rank: Callable[[int], int]) -> Column:
    key, total = kth_key(df, order, rank)
    if key is not None:
        return _at_or_before(df, order, key)
    return F.lit(total > 0 and rank(total) > total)


def head_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows with the smallest ``key`` (unique, of any ordered type; a null comes first)."""
    return df.filter(_first_rows(df, [key], lambda total: n))


def head_fraction(df: DataFrame, fraction: float, key: str) -> DataFrame:
    """The first ``round(fraction * n)`` rows by ``key``."""
    return df.filter(_first_rows(df, [key], lambda total: round(fraction * total)))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    """Uniform sample of ``min(n, N)`` rows without replacement."""
    hashed = df.withColumn(_HASH, seeded_hash(key, seed=seed))
    return hashed.filter(_first_rows(hashed, [_HASH, key], lambda total: n)).drop(_HASH)


def train_test_split(df: DataFrame, test_size: float, key: str, seed: int = SEED) -> DataFrame:
    """Add ``split``: exactly ``ceil(test_size * n)`` rows are ``test``, the rest ``train``.

    ``df`` is read twice (keys first); store it before if it is costly to compute.
    """
    hashed = df.withColumn(_HASH, seeded_hash(key, seed=seed))
    is_test = _first_rows(hashed, [_HASH, key], lambda total: math.ceil(test_size * total))
    return hashed.withColumn("split", F.when(is_test, "test").otherwise("train")).drop(_HASH)


def by_split(df: DataFrame) -> dict[str, DataFrame]:
    """The two parts of a split table by name, without the ``split`` column."""
    return {name: df.filter(F.col("split") == name).drop("split") for name in ("train", "test")}


def shard_count(df: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    """Shards of about ``shard_bytes`` of the files that ``df`` is read from, at least ``shuffle.partitions``.

    Lists the files and reads none; rows that come from no file count for nothing.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = df.inputFiles()
    if not files:
        return least
    stored = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0
    return max(least, -(-stored // shard_bytes))


def shuffle_rows(df: DataFrame, key: str, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """Rows in global seeded-hash order: one exchange, no sampling pass.

    The hash is uniform, so equal slices of its range are equal shards.
    Partition i holds the i-th slice, sorted. Without ``shards`` their number follows
    from the bytes of the input files.
    """
    shards = shards or shard_count(df)
    width = (1 << HASH_BITS) // shards + 1
    hashed = df.withColumn(_HASH, seeded_hash(key, seed=seed))
    placed = hashed.repartitionById(shards, F.expr(f"cast({_HASH} div {width}L as int)"))
    return placed.sortWithinPartitions(_HASH, key).drop(_HASH)


def _with_running_sum(
    df: DataFrame, key: str, weight: Column, name: str, seed: int
) -> tuple[DataFrame, int]:
    """Add the sum of ``weight`` over all rows before this one in hash order.

    The hash range is cut into fixed buckets; one pass sums each bucket, and
    only sums within a bucket are computed with a window.
    """
    hashed = df.withColumn(_HASH, seeded_hash(key, seed=seed)).withColumn("_weight", weight.cast("bigint"))
    fine = F.shiftright(_HASH, HASH_BITS - BUCKET_BITS).alias("b")
    sums = (
        hashed.groupBy(fine).agg(F.sum("_weight").alias("w"), F.count(F.lit(1)).alias("n")).collect()
    )  # at most 2**BUCKET_BITS rows
    rows = sum(r.n for r in sums)
    bits = min(BUCKET_BITS, max(4, math.ceil(math.log2(max(rows, 1) / ROWS_PER_BUCKET))))
    coarse: dict[int, int] = {}
    for r in sums:
        b = r.b >> (BUCKET_BITS - bits)
        coarse[b] = coarse.get(b, 0) + (r.w or 0)
    ids = sorted(coarse)
    before = [0, *accumulate(coarse[b] for b in ids)]
    schema = T.StructType([T.StructField("_bucket", T.LongType()), T.StructField("_before", T.LongType())])
    offsets = df.sparkSession.createDataFrame(list(zip(ids, before[:-1], strict=True)), schema)
    window = (
        Window.partitionBy("_bucket")
        .orderBy(_HASH, key)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = (
        hashed.withColumn("_bucket", F.shiftright(_HASH, HASH_BITS - bits))
        .withColumn("_running", F.sum("_weight").over(window))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_before") + F.col("_running") - F.col("_weight"))
        .drop("_bucket", "_before", "_running", "_weight", _HASH)
    )
    return out, before[-1]


def with_row_index(df: DataFrame, key: str, seed: int = SEED) -> tuple[DataFrame, int]:
    """Add ``row_index`` 0..n-1 in seeded-hash order; also returns n."""
    return _with_running_sum(df, key, F.lit(1), "row_index", seed)


def with_offset(df: DataFrame, key: str, length: Column, seed: int = SEED) -> tuple[DataFrame, int]:
    """Add ``offset``: total ``length`` of the rows before this one; also the grand total."""
    return _with_running_sum(df, key, length, "offset", seed)


def assign_batches(
    df: DataFrame, key: str, batch_size: int = 512, drop_last: bool = False, seed: int = SEED
) -> DataFrame:
    """Add ``batch_id``; with ``drop_last`` the final short batch is left out."""
    indexed, total = with_row_index(df, key, seed)
    out = indexed.withColumn("batch_id", F.expr(f"row_index div {batch_size}"))
    return out.filter(F.col("batch_id") < total // batch_size) if drop_last else out
