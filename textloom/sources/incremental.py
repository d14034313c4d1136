"""Tables made from files, kept up to date by a manifest of the files they were made from."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("made_by", T.StringType()),
    ]
)
_HERE = ["file", "length", "modified", "checksum"]


def list_files(spark: SparkSession, source: str, glob: str = "*.parquet", checksum: bool = False) -> DataFrame:
    """``file, length, modified, checksum`` of the input files; only a checksum reads their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(source)
    content = F.sha2("content", 256) if checksum else F.lit(None).cast("string")
    return files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"), content.alias("checksum"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the manifest; empty before the first one."""
    try:
        every = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    return every.filter(F.col("version") == (every.agg(F.max("version")).first()[0] or 0))


def _made_by(schema: T.StructType, params: dict | None) -> str:
    return hashlib.md5(json.dumps([schema.jsonValue(), params or {}], sort_keys=True, default=str).encode()).hexdigest()


def materialize_files(
    spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], path: str,
    params: dict | None = None, glob: str = "*.parquet", checksum: bool = False,
) -> DataFrame:
    """The rows that ``transform`` makes from the parquet files under ``source``, of which only new ones are computed.

    ``transform`` works row by row (it may drop rows or make several of one) and keeps the
    column ``file``. A file is new if its path, length, time or, with ``checksum``, its
    content is not in the manifest, or if it was read with another schema or other
    ``params``. Its rows are written as a part, then one file with the new manifest is put
    in place; a run that is lost before leaves parts that nothing reads, and the old table.
    Rows of files that have gone are no longer read. One run at a time may write a table.
    """
    made_by = _made_by(schema, params)
    known = read_manifest(spark, path).filter(F.col("made_by") == made_by)
    found = list_files(spark, source, glob, checksum)
    same = [found[c].eqNullSafe(known[c]) for c in _HERE]
    state = found.join(known.select(*_HERE, "part"), same[0] & same[1] & same[2] & same[3], "left")
    state = state.select(*[found[c] for c in _HERE], "part")
    new = [r.file for r in state.filter("part is null").select("file").collect()]  # paths of this run's input
    last = read_manifest(spark, path).agg(F.max("version"), F.count(F.lit(1))).first()
    gone = last[1] != found.count() or bool(new)
    part = uuid.uuid4().hex
    if new:
        rows = spark.read.schema(schema).parquet(*new).withColumn("file", F.col("_metadata.file_path"))
        transform(rows).write.parquet(f"{path}/data/part={part}")
    if gone or last[0] is None:
        version = F.lit((last[0] or 0) + 1).cast("bigint").alias("version")
        rows = state.select(version, *_HERE, F.coalesce("part", F.lit(part)).alias("part"), F.lit(made_by).alias("made_by"))
        rows.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return read_files(spark, path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The table as the newest manifest has it, without the column ``file``."""
    manifest = read_manifest(spark, path).select("file", "part")
    parts = [r.part for r in manifest.select("part").distinct().collect()]  # one for each run that still counts
    if not parts:
        raise ValueError(f"no rows were ever made at {path}")
    base = f"{path}/data"
    rows = spark.read.option("basePath", base).option("mergeSchema", "false").parquet(*[f"{base}/part={p}" for p in parts])
    columns = [c for c in rows.columns if c not in ("file", "part")]
    return rows.withColumn("part", F.col("part").cast("string")).join(manifest, ["file", "part"], "left_semi").select(*columns)
