"""Blocks of newly arriving documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textloom.functions.blocks import BLOCK_SIZE
from textloom.operators.tokenizer import Tokenizer
from textloom.plans.pretraining import tokenize_and_block


def read_new_files(
    spark: SparkSession, path: str, schema: StructType, max_files: int = 64, glob: str | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def stream_blocks(
    docs: DataFrame,
    tokenizer: Tokenizer,
    out: str,
    checkpoint: str,
    block_size: int = BLOCK_SIZE,
    partitions: int | None = None,
) -> StreamingQuery:
    """Tokenize and block all documents that arrived since the last run, exactly once.

    Stateless, so batches need no order between them; the checkpoint and the
    file sink's own log make a restart continue without gaps or repeats. Set
    ``partitions`` when files arrive in fewer splits than there are task slots.
    """
    docs = docs.repartition(partitions) if partitions else docs
    return (
        tokenize_and_block(docs, tokenizer, block_size)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
