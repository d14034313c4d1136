"""Token totals kept up to date by signed deltas, with batches that can be committed again.

A store is a folder with three tables: ``versions`` has the count and labels of every
document that a batch touched, ``deltas`` the signed sums that follow from them, and
``commits`` one record for each batch. The record names the parts that count, the hash of
the batch's content and the batch before it; it is written last, so a batch whose driver was
lost is not there, and its parts are never read. Nothing is written over. A snapshot
holds the newest version of each document. Versions are stored in the order of a hash of
their keys, and a batch of few keys reads the files and row groups that can hold them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.bpe import with_python_rows

LABELS = ["source", "lang", "tokenizer"]
VERSIONS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in LABELS],
        T.StructField("n_tokens", T.LongType()),
        T.StructField("alive", T.BooleanType()),
    ]
)
SUMS = ["n_docs", "n_tokens"]
BUCKET_BITS = 16  # of the hash in whose order versions are stored
FEW = 1000  # buckets that a filter names; a batch that touches more reads all
SNAPSHOT_EVERY = 16  # batches, so that a batch reads a bounded number of parts
COMMITS = T.StructType(
    [
        T.StructField("batch", T.IntegerType()),
        T.StructField("kind", T.StringType()),  # batch or snapshot
        T.StructField("part", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("before", T.IntegerType()),
    ]
)
DELTAS = T.StructType(
    [*[T.StructField(c, T.StringType()) for c in LABELS], *[T.StructField(c, T.LongType()) for c in SUMS]]
)


def count_tokens(df: DataFrame, vocabulary, tokenizer: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens`` of the whole text in a public vocabulary and its name; null texts have 0.

    ``vocabulary`` is a loader with ``model()``; an existing column of one of the two
    names is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        encode = shared.value.model().encode_ordinary

        def work(batch):
            return {"n_tokens": [len(encode(t)) if t else 0 for t in batch.column(text).to_pylist()]}

        return work

    counted = with_python_rows(df.drop("n_tokens"), make, [T.StructField("n_tokens", T.LongType())])
    return counted.withColumn("tokenizer", F.lit(tokenizer))


def commits(spark: SparkSession, store: str) -> list:
    """Records of the committed batches and snapshots in order; one for each batch."""
    try:
        rows = spark.read.schema(COMMITS).parquet(f"{store}/commits").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(rows, key=lambda r: (r.batch, r.kind))


def _commit(spark: SparkSession, store: str, batch: int, kind: str, part: str, content: str) -> None:
    record = spark.createDataFrame([(batch, kind, part, content, batch - 1)], COMMITS)
    record.coalesce(1).write.mode("append").parquet(f"{store}/commits")


def _read(spark: SparkSession, store: str, table: str, schema: T.StructType, parts: list[str]) -> DataFrame:
    """Named parts only: parts of lost batches are never looked at."""
    if not parts:
        return spark.createDataFrame([], schema)
    base = f"{store}/{table}"
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/part={p}" for p in parts])


_STORED = T.StructType([*VERSIONS.fields, T.StructField("batch", T.IntegerType()), T.StructField("bucket", T.IntegerType())])


def _store_versions(rows: DataFrame, store: str, batch: int) -> str:
    """Write a part; equal ranges of the hash are equal shares, so nothing is sampled."""
    part, shards = uuid.uuid4().hex, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("key"), F.lit(1 << BUCKET_BITS)).cast("int")
    placed = rows.withColumns({"batch": F.lit(batch), "bucket": bucket})
    shard = F.expr(f"cast(bucket * {shards}L div {1 << BUCKET_BITS}L as int)")
    placed.repartitionById(shards, shard).sortWithinPartitions("bucket").write.parquet(f"{store}/versions/part={part}")
    return part


def _live(done: list) -> list[str]:
    """Parts with the state after the last batch: the newest snapshot and the batches behind it."""
    last = max((r.batch for r in done if r.kind == "snapshot"), default=0)
    return [r.part for r in done if (r.kind == "snapshot" and r.batch == last) or (r.kind == "batch" and r.batch > last)]


_COLUMNS = ["key", *LABELS, "n_tokens", "alive"]


def _content(rows: DataFrame) -> str:
    """Hash of the rows of a batch, whatever their order."""
    number = F.xxhash64(*_COLUMNS).cast("decimal(38,0)")
    other = F.xxhash64(F.lit(7), *_COLUMNS).cast("decimal(38,0)")
    return ":".join(map(str, rows.agg(F.count(F.lit(1)), F.sum(number), F.sum(other)).first()))


def apply_batch(store: str, batch: int, changes: DataFrame) -> bool:
    """Commit ``changes`` as ``batch``, the one after the last; False if it was committed before.

    ``changes`` has ``key`` (any type), ``source``, ``lang``, ``tokenizer``, ``n_tokens``
    and ``deleted``; it may have ``seq``, the order of changes within the batch. A change
    of a known key under the same tokenizer takes back what was counted and counts the
    new state; a delete of an unknown key counts nothing. Several changes of one key:
    the last ``seq`` holds, ties are settled by the largest count and labels, repeated
    rows are one. Rows without a key cannot be revised and are left out; a null count is
    0, null labels form a group of their own. Other columns are ignored; a batch without
    rows is a batch like any other.

    A committed number with the same content changes nothing. With other content, or
    behind a gap, it is an error, and the store stays as it was. One batch at a time may
    be applied to a store.
    """
    spark = changes.sparkSession
    seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
    state = F.struct(
        seq.alias("seq"), F.coalesce("deleted", F.lit(False)).alias("deleted"),
        F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
    )
    new = (
        changes.filter(F.col("key").isNotNull())
        .select(F.col("key").cast("string").alias("key"), F.col("tokenizer").cast("string").alias("tokenizer"), state.alias("s"))
        .groupBy("key", "tokenizer")
        .agg(F.max("s").alias("s"))
        .select("key", "s.source", "s.lang", "tokenizer", "s.n_tokens", (~F.col("s.deleted")).alias("alive"))
    )
    done = commits(spark, store)
    last = max((r.batch for r in done), default=0)
    if batch > last + 1 or batch < 1:
        raise ValueError(f"batch {batch} does not follow batch {last}")
    # The batch's own versions are written first and read back: they are the input of its deltas.
    part = _store_versions(new, store, batch)
    written = _read(spark, store, "versions", _STORED, [part])
    content = _content(written)
    if batch <= last:
        if content != next(r.content for r in done if r.batch == batch and r.kind == "batch"):
            raise ValueError(f"batch {batch} was committed with other content")
        return False
    known = _read(spark, store, "versions", _STORED, _live(done))
    touched = [r.bucket for r in written.select("bucket").distinct().limit(FEW + 1).collect()]
    if len(touched) <= FEW:
        known = known.filter(F.col("bucket").isin(touched))
    both = known.select(*_COLUMNS, "batch").unionByName(written.select(*_COLUMNS, "batch"))
    # One shuffle: the newest earlier state and the new one of each key come from a partial aggregate.
    row = F.struct("batch", "source", "lang", "n_tokens", "alive")
    is_new = F.col("batch") == batch
    pairs = both.groupBy("key", "tokenizer").agg(
        F.max(F.when(~is_new, row)).alias("old"), F.max(F.when(is_new, row)).alias("new")
    )
    pairs = pairs.filter("new is not null")

    def signed(side: str, sign: int):
        s = F.col(side)
        return F.when(
            s["alive"],
            F.struct(
                s["source"].alias("source"), s["lang"].alias("lang"),
                F.lit(sign).cast("bigint").alias("n_docs"), (s["n_tokens"] * sign).alias("n_tokens"),
            ),
        )

    moves = pairs.select("tokenizer", F.explode(F.array(signed("old", -1), signed("new", 1))).alias("m"))
    moves = moves.filter("m is not null").select("m.source", "m.lang", "tokenizer", "m.n_docs", "m.n_tokens")
    deltas = moves.groupBy(*LABELS).agg(*[F.sum(c).alias(c) for c in SUMS])
    deltas.write.parquet(f"{store}/deltas/part={part}")
    _commit(spark, store, batch, "batch", part, content)
    if batch % SNAPSHOT_EVERY == 0:
        snapshot(spark, store)
    return True


def snapshot(spark: SparkSession, store: str) -> None:
    """Store the newest version of each key that is alive; later batches read it in place of the batches up to now."""
    done = commits(spark, store)
    last = max((r.batch for r in done), default=0)
    if any(r.kind == "snapshot" and r.batch == last for r in done) or not last:
        return
    rows = _read(spark, store, "versions", _STORED, _live(done))
    newest = rows.groupBy("key", "tokenizer").agg(F.max(F.struct("batch", "source", "lang", "n_tokens", "alive")).alias("v"))
    newest = newest.filter("v.alive").select("key", "v.source", "v.lang", "tokenizer", "v.n_tokens", "v.alive")
    _commit(spark, store, last, "snapshot", _store_versions(newest, store, last), "")


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Sums of the deltas of all committed batches; groups that have become empty are left out."""
    parts = [r.part for r in commits(spark, store) if r.kind == "batch"]
    sums = _read(spark, store, "deltas", DELTAS, parts).groupBy(*LABELS).agg(*[F.sum(c).alias(c) for c in SUMS])
    return sums.filter(" or ".join(f"{c} != 0" for c in SUMS))
