"""From raw documents to token ids: five stages, each stored and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, decontaminate, fertility, ngram_join, secrets
from textloom.llm.queries import bands, byte_bpe, vocabularies
from textloom.workspace import fresh_path, write_through


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; null and blank texts are among them."""
    return fertility.quality_rules(docs, vocabularies(), bands()).filter("kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest number stays.

    Rows are told apart by their place in a stored table, so different texts under one
    number are different documents, and a row without a number is one like any other
    (of equals, one with a number stays). Texts without a word are linked with nothing.
    """
    placed = write_through(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = ngram_join.similar_components(placed.select("_row", "text"), key="_row")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")
    first = placed.select("_row", "doc_id").join(groups, "_row").groupBy("component_id").agg(F.min(order).alias("kept"))
    return placed.join(first.select(F.col("kept._row").alias("_row")), "_row", "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay; every secret is masked and the length counted again."""
    ledger = secrets.scan_batch(docs, fresh_path(spark, "ledger"), None, key="doc_id")
    masked = secrets.redact(docs, ledger)
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the hash of the ids and of the text they decode to."""
    return bpe.round_trip(docs, byte_bpe(), ids="ids").drop("text", "n_chars")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("BPE encoding and decoding", encoded),
]

# Tokenizers and near-duplicate components of the stages are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
