"""Reading and writing corpus text, training blocks and reusable tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str) -> None:
    """One text directory per source; every row ends with a newline.

    A newline inside a text starts a further line. No rows are moved: each task
    writes its own file in each source directory.
    """
    df.select("text", "source").write.partitionBy("source").option("lineSep", "\n").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all text files under ``path``, each with its newline put back."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.withColumn("text", F.concat("value", F.lit("\n"))).drop("value")


def write_blocks(df: DataFrame, path: str, max_records: int = 200_000) -> None:
    """Training blocks as parquet shards in the order the rows already have."""
    df.write.option("maxRecordsPerFile", max_records).parquet(path)


def sort_by_key(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """Rows in key order over ``shards`` range partitions.

    Meant for documents before they are blocked: blocks come out in
    ``(key, block_no)`` order by themselves, and only text is moved.
    """
    return docs.repartitionByRange(shards, key).sortWithinPartitions(key)


def read_blocks(spark: SparkSession, pattern: str) -> DataFrame:
    """All shards matching a path pattern; order comes from the keys, not file names."""
    return spark.read.parquet(pattern)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def materialize(
    spark: SparkSession, build: Callable[[], DataFrame], path: str, params: dict | None = None
) -> DataFrame:
    """Read the stored result of ``build`` if it is complete, else build and store it.

    The folder is named after a fingerprint of ``params``, so other parameters
    or inputs listed there never reuse an old result. A partial write has no
    success marker and is replaced.
    """
    text = json.dumps(params or {}, sort_keys=True, default=str)
    target = f"{path}/{hashlib.md5(text.encode()).hexdigest()}"
    if not _exists(spark, f"{target}/_SUCCESS"):
        build().write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
