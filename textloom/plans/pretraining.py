"""From text sources to a vocabulary and to fixed-length training blocks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.blocks import BLOCK_SIZE
from textloom.functions.hashing import SEED
from textloom.operators.filters import drop_long_text, keep_text
from textloom.operators.ordering import shuffle_rows
from textloom.operators.packing import explode_blocks
from textloom.operators.tokenizer import Tokenizer
from textloom.operators.vocabulary import VOCAB_SIZE, count_pretokens, learn_merges
from textloom.sources.registry import Source, union_sources
from textloom.sources.storage import read_lines, write_text


def tokenize_and_block(
    docs: DataFrame,
    tokenizer: Tokenizer,
    block_size: int = BLOCK_SIZE,
    text: str = "text",
    max_chars: int | None = None,
) -> DataFrame:
    """Replace the text column by padded blocks, one row each.

    Row-local: no shuffle, so it also runs on a stream. All other columns of
    ``docs`` are carried along.
    """
    kept = drop_long_text(keep_text(docs, text), max_chars, text)
    rest = [F.col(c) for c in docs.columns if c != text]
    ids = kept.select(*rest, tokenizer.encode(text, eos=True).alias("ids"))
    return explode_blocks(ids, "ids", block_size, tokenizer.pad_id)


def training_blocks(
    corpus: DataFrame,
    tokenizer: Tokenizer,
    key: str = "doc_id",
    block_size: int = BLOCK_SIZE,
    shards: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Blocks of a corpus with a unique ``key`` and a ``text``, in shuffled order.

    The one exchange moves raw text, which is smaller than padded blocks;
    tokenizing and blocking follow it within each shard.
    """
    kept = keep_text(corpus)
    return tokenize_and_block(shuffle_rows(kept, key, shards, seed), tokenizer, block_size)


def training_blocks_of_sources(
    spark: SparkSession,
    sources: Iterable[Source],
    tokenizer: Tokenizer,
    block_size: int = BLOCK_SIZE,
    shards: int | None = None,
    harmonize: bool = True,
) -> DataFrame:
    """Blocks of several sources; ``doc_id`` is ``source:id``."""
    united = union_sources(spark, sources, harmonize)
    corpus = united.select("source", F.concat_ws(":", "source", "id").alias("doc_id"), "text")
    return training_blocks(corpus, tokenizer, "doc_id", block_size, shards)


def vocabulary_of_sources(
    spark: SparkSession, sources: Iterable[Source], path: str, vocab_size: int = VOCAB_SIZE
) -> Tokenizer:
    """Extract all sources to text files under ``path`` and learn merges from their lines."""
    write_text(union_sources(spark, sources), path)
    return learn_merges(count_pretokens(read_lines(spark, path)), vocab_size)
