"""One registered query per operator, each over the whole of its input tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.catalog import fixtures as fx
from textloom.functions import blocks as B
from textloom.functions import text as X
from textloom.functions.hashing import seeded_hash
from textloom.functions.pretokens import pretokens
from textloom.functions.symbols import FIRST_MERGE_ID, byte_ids
from textloom.operators import evaluation as ev
from textloom.operators import filters, ordering, packing, runs
from textloom.operators.chat import pick_winner, render_turns
from textloom.operators.counts import observed
from textloom.operators.dictionary import count_with_dictionary, encode_with_dictionary, extend_dictionary
from textloom.operators.preferences import best_and_worst, keep_comparable
from textloom.operators.tokenizer import BYTE_TOKENIZER, Tokenizer
from textloom.operators.vocabulary import count_pretokens, learn_merges, vocabulary
from textloom.plans import finetuning, pretraining
from textloom.sources import incremental, registry, storage
from textloom.streaming.blocks import read_new_files, stream_blocks
from textloom.streaming.metrics import bucket_means, loss_by_bucket, streamed_bucket_loss, windowed_loss
from textloom.streaming.packing import pack_stream, use_rocksdb
from textloom.streaming.progress import latest_progress, progress_stream
from textloom.workspace import fresh_path, write_through

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LEARNED = 16
SEPARATOR = "\x01"


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _digest(ids: str | Column) -> Column:
    """Fingerprint of an array of ids, in order."""
    col = F.col(ids) if isinstance(ids, str) else ids
    return F.md5(F.array_join(col.cast("array<string>"), ","))


def _n_tokens(mask: str = "attention_mask") -> Column:
    """Ones of a mask: everything before its first zero."""
    at = F.array_position(mask, 0)
    return F.when(at == 0, F.size(mask)).otherwise(at - 1).cast("bigint")


def _id_summary(df: DataFrame, keys: list[str], ids: str = "ids") -> DataFrame:
    return df.select(*keys, F.size(ids).alias("n_ids"), _digest(ids).alias("digest"))


def _block_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprints of both arrays of a block."""
    return df.select(
        *keys,
        F.size("input_ids").alias("width"),
        _n_tokens().alias("n_tokens"),
        _digest("input_ids").alias("ids_digest"),
        _digest("attention_mask").alias("mask_digest"),
    )


# Sources and sinks


@register
def source_scan(spark, sf):
    return registry.text_source("documents", lambda s: fx.documents(s, sf), key="doc_id").extract(spark)


@register
def source_builders(spark, sf):
    path = fresh_path(spark, "sources")
    parts = []
    for s in fx.corpus_sources(sf):
        stored = storage.materialize(spark, lambda s=s: s.extract(spark), f"{path}/{s.name}", {"source": s.name})
        parts.append(stored.groupBy("source").agg(F.count("id").alias("rows"), F.sum(F.length("text")).alias("chars")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register
def head_fraction(spark, sf):
    return ordering.head_fraction(fx.read(spark, sf, "documents"), 0.1, "doc_id").select("doc_id", "n_chars")


@register
def head_rows(spark, sf):
    return ordering.head_rows(fx.read(spark, sf, "documents"), 100, "doc_id").select("doc_id", "n_chars")


@register
def head_rows_by_text(spark, sf):
    named = fx.read(spark, sf, "documents").select(F.concat_ws(":", "source", F.col("doc_id").cast("string")).alias("name"), "lang")
    return ordering.head_rows(named, 60, "name")


@register
def block_glob_scan(spark, sf):
    path = fresh_path(spark, "blocks")
    docs = fx.documents(spark, sf).select("doc_id", "text")
    storage.write_blocks(pretraining.tokenize_and_block(docs, BYTE_TOKENIZER), path)
    return _block_summary(storage.read_blocks(spark, f"{path}/*.parquet"), ["doc_id", "block_no"])


@register
def sorted_block_shards(spark, sf):
    path = fresh_path(spark, "shards")
    docs = fx.documents(spark, sf).select("doc_id", "text")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    storage.write_blocks(pretraining.tokenize_and_block(storage.sort_by_key(docs, shards), BYTE_TOKENIZER), path)
    stored = storage.read_blocks(spark, path)
    in_files, apart = _order_of_files(stored, ["doc_id", "block_no"])
    return stored.groupBy("doc_id").agg(
        F.count("block_no").alias("n_blocks"), F.sum(_n_tokens()).alias("n_tokens")
    ).withColumns({"sorted_in_files": F.lit(in_files), "files_apart": F.lit(apart)})


def _order_of_files(stored: DataFrame, keys: list[str]) -> tuple[bool, bool]:
    """Whether rows are in key order in every file, and whether the files' key ranges do not meet."""
    rows = stored.select(F.struct(*keys).alias("k"), F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    before = F.lag("k").over(Window.partitionBy("f").orderBy("i"))
    checked = rows.withColumn("ok", F.coalesce(before < F.col("k"), F.lit(True)))
    files = checked.groupBy("f").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.min("ok").alias("ok")).orderBy("low").collect()
    return all(f.ok for f in files), all(tuple(x.high) < tuple(y.low) for x, y in zip(files, files[1:]))


def _written_lines(spark, sf):
    path = fresh_path(spark, "text")
    storage.write_text(registry.union_sources(spark, fx.corpus_sources(sf)), path)
    return storage.read_lines(spark, path)


@register
def text_sink(spark, sf):
    return _written_lines(spark, sf).groupBy("source").agg(
        F.count("text").alias("lines"), F.sum(F.length("text")).alias("chars")
    )


@register
def line_pretoken_counts(spark, sf):
    return count_pretokens(_written_lines(spark, sf))


@register
def materialize_once(spark, sf):
    path = fresh_path(spark, "once")

    def build():
        return registry.union_sources(spark, fx.corpus_sources(sf)).select("source", "id", F.length("text").alias("chars"))

    storage.materialize(spark, build, path, {"sources": 5})
    return storage.materialize(spark, build, path, {"sources": 5})


@register
def incremental_table(spark, sf):
    """Rows made from the files of one table; the second call finds all files in the manifest."""
    path, schema = fresh_path(spark, "files"), fx.read(spark, sf, "documents").schema

    def chars(docs: DataFrame) -> DataFrame:
        return docs.select("doc_id", F.length("text").alias("chars"), "file")

    incremental.materialize_files(spark, f"{sf}/documents.parquet", schema, chars, path)
    return incremental.materialize_files(spark, f"{sf}/documents.parquet", schema, chars, path)


def _learned(spark, sf) -> Tokenizer:
    return learn_merges(count_pretokens(fx.documents(spark, sf)), FIRST_MERGE_ID + LEARNED)


@register
def saved_vocabulary(spark, sf):
    path = fresh_path(spark, "tokenizer")
    _learned(spark, sf).save(spark, path)
    loaded = Tokenizer.load(spark, path)
    loaded.check_pad()
    return vocabulary(loaded, spark).withColumn("is_pad", F.col("token_id") == loaded.pad_id)


# Projections and filters


@register
def strip_text(spark, sf):
    ragged = F.concat(F.lit("　\t"), F.col("text"), F.lit(" \x1c\n\x85"))
    return fx.documents(spark, sf).select("doc_id", X.strip(ragged).alias("text"))


@register
def compose_text(spark, sf):
    pairs = [fx.reply_pairs(spark, sf, i, "a", "b") for i in (0, 1)]
    return pairs[0].unionByName(pairs[1]).select("id", X.compose("a", "b").alias("text"))


@register
def keep_text(spark, sf):
    raw = registry.union_sources(spark, fx.corpus_sources(sf), harmonize=False)
    kept = filters.keep_text(raw).groupBy("source").agg(F.count("id").alias("kept"))
    return raw.groupBy("source").agg(F.count("id").alias("rows")).join(kept, "source", "left").fillna(0, ["kept"])


@register
def drop_long_text(spark, sf):
    return filters.drop_long_text(fx.read(spark, sf, "documents"), 4096).select("doc_id", "n_chars")


@register
def drop_empty_text(spark, sf):
    inputs = fx.instructions(spark, sf).select("id", F.col("input").alias("text"))
    return filters.drop_empty_text(inputs).select("id", F.length("text").alias("chars"))


@register
def english_conversations(spark, sf):
    kept = filters.keep_nonempty(filters.keep_language(fx.nested_arena(spark, sf)), "conversation_a")
    return kept.select("id", F.size("conversation_a").alias("turns"))


@register
def token_band(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    return finetuning.with_length(docs, fx.TOKENIZER, 20, 1024).select("doc_id", "length")


@register
def comparable_records(spark, sf):
    return keep_comparable(fx.nested_completions(spark, sf)).select("id", F.size("completions").alias("n"))


@register
def winner_choice(spark, sf):
    side = pick_winner("winner", F.lit("a"), F.lit("b"), "id")
    return fx.nested_arena(spark, sf).select("id", "winner", side.alias("side"))


@register
def id_range_check(spark, sf):
    ids = fx.documents(spark, sf).select("doc_id", fx.TOKENIZER.encode("text", eos=True).alias("ids"))
    return ids.select(
        "doc_id",
        B.ids_in_range("ids", fx.TOKENIZER.vocab_size).alias("in_vocabulary"),
        B.ids_in_range("ids", FIRST_MERGE_ID).alias("bytes_only"),
    )


# Joins


@register
def model_comparison(spark, sf):
    return ev.compare_models(fx.numbered_answers(spark, sf), sample="sample_id")


@register
def zipped_responses(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", fx.lines().alias("prompts"), F.reverse(fx.lines()).alias("responses"))
    return ev.zip_responses(docs).select("doc_id", "position", X.instruction_response("prompt", "response").alias("text"))


@register
def keyed_responses(spark, sf):
    t = fx.turns(spark, sf)
    asked = t.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    given = t.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return ev.join_responses(asked, given, ["conv_id", "turn"]).select(
        "conv_id", "turn", X.instruction_response("prompt", "response").alias("text")
    )


@register
def dictionary_lookup(spark, sf):
    docs = fx.documents(spark, sf)
    return count_with_dictionary(docs, extend_dictionary(docs, fx.TOKENIZER, fresh_path(spark, "dictionary")), "doc_id")


@register
def dictionary_ids(spark, sf):
    """The corpus comes in two parts; the second one brings the pretokens that the first has not."""
    docs, path = fx.documents(spark, sf).select("doc_id", "text", "lang"), fresh_path(spark, "dictionary")
    extend_dictionary(docs.filter("lang in ('en', 'de')"), fx.TOKENIZER, path)
    dictionary = extend_dictionary(docs, fx.TOKENIZER, path)
    return _id_summary(encode_with_dictionary(docs, dictionary, "doc_id"), ["doc_id"])


# Sets, order, samples, splits


@register
def corpus_union(spark, sf):
    return registry.union_sources(spark, fx.corpus_sources(sf))


@register
def seeded_hashes(spark, sf):
    return fx.read(spark, sf, "documents").select("doc_id", seeded_hash("doc_id").alias("h"))


@register
def shuffled_order(spark, sf):
    indexed, _ = ordering.with_row_index(fx.read(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return indexed


@register
def shuffled_shards(spark, sf):
    shuffled = ordering.shuffle_rows(fx.read(spark, sf, "documents").select("doc_id"), "doc_id", 16)
    return shuffled.select("doc_id", F.spark_partition_id().alias("shard"))


@register
def uniform_sample(spark, sf):
    return ordering.sample_rows(fx.read(spark, sf, "documents"), 50, "doc_id").select("doc_id", "lang")


@register
def exact_split(spark, sf):
    return ordering.train_test_split(fx.read(spark, sf, "documents").select("doc_id", "lang"), 0.1, "doc_id")


@register
def best_and_worst_completion(spark, sf):
    return best_and_worst(fx.nested_completions(spark, sf)).select("id", "chosen", "rejected")


@register
def batch_assignment(spark, sf):
    indexed, total = ordering.with_row_index(fx.read(spark, sf, "documents").select("doc_id"), "doc_id")
    batch = F.expr("row_index div 16")
    return indexed.select("doc_id", batch.alias("batch_id"), (batch < total // 16).alias("in_full_batch"))


# Vocabulary and tokens


@register
def pretoken_lists(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", pretokens("text").alias("p"))
    return docs.select("doc_id", F.size("p").alias("n"), F.md5(F.array_join("p", SEPARATOR)).alias("digest"))


@register
def byte_alphabet(spark, sf):
    docs = fx.documents(spark, sf).select(F.explode_outer(byte_ids("text")).alias("token_id"))
    return docs.groupBy("token_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("token_id").isNotNull())


@register
def pretoken_counts(spark, sf):
    return count_pretokens(fx.documents(spark, sf))


@register
def learned_merges(spark, sf):
    return _learned(spark, sf).merges_table(spark)


@register
def full_vocabulary(spark, sf):
    """All merges of a vocabulary of production size, from the lines of the corpus."""
    return learn_merges(count_pretokens(_written_lines(spark, sf))).merges_table(spark)


@register
def vocabulary_table(spark, sf):
    return vocabulary(_learned(spark, sf), spark)


@register
def encode_text(spark, sf):
    ids = fx.documents(spark, sf).select("doc_id", fx.TOKENIZER.encode("text").alias("ids"))
    return _id_summary(ids, ["doc_id"])


@register
def encode_with_specials(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", F.replace("text", F.lit("\n"), F.lit("</s>")).alias("text"))
    return _id_summary(docs.select("doc_id", fx.TOKENIZER.encode("text", eos=True).alias("ids")), ["doc_id"])


@register
def token_blocks(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    return _block_summary(pretraining.tokenize_and_block(docs, fx.TOKENIZER), ["doc_id", "block_no"])


@register
def truncated_ids(spark, sf):
    ids = fx.documents(spark, sf).select("doc_id", B.truncate(fx.TOKENIZER.encode("text"), 1024).alias("ids"))
    return _id_summary(ids, ["doc_id"])


@register
def decode_ids(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", fx.TOKENIZER.encode("text", eos=True).alias("ids"))
    return docs.select("doc_id", fx.TOKENIZER.decode("ids").alias("text"))


@register
def causal_labels(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    out = pretraining.tokenize_and_block(docs, BYTE_TOKENIZER).withColumn("labels", B.causal_labels("input_ids"))
    return out.select("doc_id", "block_no", _digest("labels").alias("digest"))


@register
def shifted_labels(spark, sf):
    ids = fx.documents(spark, sf).select("doc_id", B.truncate(fx.TOKENIZER.encode("text", eos=True), 1024).alias("t"))
    return _id_summary(ids.select("doc_id", B.shifted_labels("t").alias("ids")), ["doc_id"])


@register
def packed_rows(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", fx.TOKENIZER.encode("text", eos=True).alias("ids"))
    packed = packing.pack_rows(write_through(docs, "ids"), "doc_id")
    return _id_summary(packed, ["block_no"], "input_ids")


def _stored_ids(spark, sf) -> DataFrame:
    docs = fx.documents(spark, sf).select("doc_id", fx.TOKENIZER.encode("text", eos=True).alias("ids"))
    return write_through(docs, "ids")


@register
def whole_packed_rows(spark, sf):
    """Blocks of whole documents, with the share of their places that is filled in each shard."""
    packed = write_through(packing.pack_whole(_stored_ids(spark, sf), "doc_id"), "blocks")
    fill = packed.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_blocks"), F.round(F.sum(F.size("input_ids")) / F.sum(F.greatest(F.size("input_ids"), F.lit(B.BLOCK_SIZE))), 4).alias("fill"),
    )
    out = packed.select("shard", "block_no", F.size("keys").alias("n_documents"), F.size("input_ids").alias("n_ids"), _digest("input_ids").alias("digest"))
    return out.join(fill, "shard")


@register
def whole_packed_documents(spark, sf):
    """What of each document is in its block: all of it, in order."""
    packed = packing.pack_whole(_stored_ids(spark, sf), "doc_id")
    place = F.transform(F.arrays_zip("keys", "lengths"), lambda x, i: F.struct(x["keys"].alias("doc_id"), x["lengths"].alias("n"), i.alias("i")))
    each = packed.select("input_ids", "lengths", F.explode(place).alias("p"))
    start = F.aggregate(F.slice("lengths", 1, F.col("p.i")), F.lit(0), lambda a, x: a + x)
    ids = F.slice("input_ids", start + 1, F.col("p.n"))
    return _id_summary(each.select("p.doc_id", ids.alias("ids")), ["doc_id"])


@register
def budget_batches(spark, sf):
    """Documents in batches of at most 16,384 ids with their padding, or alone in one."""
    rows = packing.batches_by_tokens(_stored_ids(spark, sf), "doc_id", 16_384)
    batch = rows.groupBy("shard", "batch_no").agg(F.sum(F.size("input_ids")).alias("places"), F.count(F.lit(1)).alias("rows"))
    rows = rows.join(batch, ["shard", "batch_no"])
    within = (F.col("places") <= 16_384) | (F.col("rows") == 1)
    ids = F.slice("input_ids", 1, F.col("n_tokens"))
    return rows.select(F.col("key").alias("doc_id"), F.col("n_tokens").alias("n_ids"), _digest(ids).alias("digest"), within.alias("within"))


@register
def padded_batches(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", B.truncate(BYTE_TOKENIZER.encode("text"), 1024).alias("ids"))
    batches = ordering.assign_batches(docs, "doc_id", 16).select("doc_id", "batch_id", "ids")
    return _block_summary(packing.pad_to_longest(batches), ["doc_id", "batch_id"])


# Dataset builders


@register
def conversation_texts(spark, sf):
    return render_turns(fx.turns(spark, sf))


@register
def nested_conversation_texts(spark, sf):
    return fx.nested_arena(spark, sf).select("id", X.conversation_text("conversation_a").alias("text"))


@register
def chat_texts(spark, sf):
    return finetuning.chat_texts(fx.nested_arena(spark, sf), fx.TOKENIZER)


@register
def chat_texts_of_turns(spark, sf):
    return finetuning.chat_texts_of_turns(fx.turns(spark, sf), fx.battles(spark, sf), fx.TOKENIZER)


@register
def chat_texts_split(spark, sf):
    texts = write_through(finetuning.chat_texts(fx.nested_arena(spark, sf), fx.TOKENIZER), "chat")
    return ordering.train_test_split(texts, 0.1, "id").select("id", "length", "split")


@register
def instruction_texts(spark, sf):
    return fx.instructions(spark, sf).select("id", X.instruction_response("instruction", "input").alias("text"))


def _pair_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    sides = [
        c
        for side in ("chosen", "rejected")
        for c in (
            F.size(f"input_ids_{side}").alias(f"n_{side}"),
            _digest(f"input_ids_{side}").alias(f"ids_{side}"),
            _digest(f"attention_mask_{side}").alias(f"mask_{side}"),
        )
    ]
    return df.select(*keys, *sides)


@register
def preference_tokens(spark, sf):
    return _pair_summary(finetuning.preference_tokens(fx.nested_completions(spark, sf), fx.TOKENIZER), ["id"])


@register
def preference_tokens_of_turns(spark, sf):
    pairs = fx.preference_pairs(spark, sf)
    return _pair_summary(finetuning.preference_tokens_of_pairs(pairs, fx.TOKENIZER), ["id"])


@register
def preference_split(spark, sf):
    """Sample, split, then drop records that have no pair, in that order."""
    records = fx.nested_completions(spark, sf)
    split = ordering.train_test_split(ordering.sample_rows(records, 150, "id"), 0.1, "id")
    return _pair_summary(finetuning.preference_tokens(split, fx.TOKENIZER, carry=("id", "split")), ["id", "split"])


@register
def prompt_texts(spark, sf):
    return fx.instructions(spark, sf).select("id", X.strip(finetuning.clipped_prompt()).alias("prompt"))


@register
def prompts(spark, sf):
    return finetuning.prompts(fx.instructions(spark, sf), BYTE_TOKENIZER)


@register
def sampled_prompts(spark, sf):
    return finetuning.sampled_prompts(fx.instructions(spark, sf), fx.TOKENIZER, 120)


@register
def generation_prompts(spark, sf):
    return fx.turns(spark, sf).select(
        "conv_id",
        "turn",
        X.chat_generation_prompt("text").alias("chat_prompt"),
        X.instruction_generation_prompt("text").alias("instruction_prompt"),
    )


@register
def trainer_text(spark, sf):
    return finetuning.chat_texts(fx.nested_arena(spark, sf), BYTE_TOKENIZER).select("text")


@register
def training_blocks(spark, sf):
    sources = fx.corpus_sources(sf, head=0.1)
    out = pretraining.training_blocks_of_sources(spark, sources, fx.TOKENIZER)
    return _block_summary(out, ["source", "doc_id", "block_no"])


@register
def stored_training_blocks(spark, sf):
    """The build through its sink: what is read back, and whether the files are in shuffle order."""
    path = fresh_path(spark, "training")
    storage.write_blocks(pretraining.training_blocks_of_sources(spark, fx.corpus_sources(sf, head=0.1), fx.TOKENIZER), path)
    stored = storage.read_blocks(spark, path).withColumn("h", seeded_hash("doc_id"))
    in_files, apart = _order_of_files(stored, ["h", "doc_id", "block_no"])
    slots = F.sum(F.size("input_ids"))
    return stored.groupBy("source").agg(
        F.countDistinct("doc_id").alias("documents"),
        F.count(F.lit(1)).alias("n_blocks"),
        F.sum(_n_tokens()).alias("n_tokens"),
        F.round(1 - F.sum(_n_tokens()) / slots, 8).alias("pad_share"),
    ).withColumns({"sorted_in_files": F.lit(in_files), "files_apart": F.lit(apart)})


# Evaluation and runs


@register
def stage_counts(spark, sf):
    docs, read_docs = observed(fx.documents(spark, sf).select("doc_id", "text"), "documents", tokens=F.sum(F.lit(0)))
    out = pretraining.tokenize_and_block(docs, BYTE_TOKENIZER)
    out, made = observed(out, "blocks", tokens=F.sum(_n_tokens()))
    storage.write_blocks(out, fresh_path(spark, "counted"))
    rows = [(name, int(o.get["rows"]), int(o.get["tokens"])) for name, o in (("documents", read_docs), ("blocks", made))]
    return spark.createDataFrame(rows, "stage string, rows bigint, tokens bigint")


def _scored_pairs(spark, sf):
    pairs = fx.preference_pairs(spark, sf)
    return pairs.select(
        "id",
        F.length("chosen").cast("double").alias("good_score"),
        F.length("rejected").cast("double").alias("bad_score"),
    )


@register
def pair_accuracy(spark, sf):
    return ev.pair_accuracy(_scored_pairs(spark, sf))


@register
def generation_time(spark, sf):
    out = ev.generation_time(fx.generations(spark, sf), by="model")
    return out.select("model", "n", F.round("total_seconds", 4).alias("total_seconds"), F.round("avg_seconds", 8).alias("avg_seconds"))


@register
def group_advantage(spark, sf):
    return ev.group_advantage(fx.rollouts(spark, sf)).withColumn("advantage", F.round("advantage", 5))


def _checksum_scorer():
    """Scorer used in place of a model: the sum of the ids, brought into 0..100."""
    return lambda ids: pd.Series([int(x.sum()) % 1000 / 10.0 for x in ids])


@register
def scored_rows(spark, sf):
    rows = fx.turns(spark, sf).select("conv_id", "turn", F.col("role").alias("prompt"), F.col("text").alias("response"))
    return ev.score_rows(rows, fx.TOKENIZER, _checksum_scorer).select("conv_id", "turn", "score")


@register
def extracted_responses(spark, sf):
    return fx.generations(spark, sf).select("prompt_id", "model", X.extract_response("output").alias("response"))


@register
def dropped_prompts(spark, sf):
    return fx.generations(spark, sf).select("prompt_id", "model", X.drop_prompt("output", "prompt").alias("response"))


@register
def generated_ids(spark, sf):
    rows = fx.generations(spark, sf).select(
        "prompt_id", "model", BYTE_TOKENIZER.encode("output").alias("out"), BYTE_TOKENIZER.length("prompt").alias("n_prompt")
    )
    return _id_summary(rows.select("prompt_id", "model", ev.new_ids("out", "n_prompt").alias("ids")), ["prompt_id", "model"])


@register
def prompt_suite_report(spark, sf):
    suite = fx.read(spark, sf, "benchmark").select(F.col("item_id").alias("prompt_id"), (F.col("item_id") % 7).alias("group"))
    out = ev.suite_report(fx.generations(spark, sf), suite)
    return out.select("group", "prompts", "answers", F.round("total_seconds", 4).alias("total_seconds"), F.round("avg_seconds", 8).alias("avg_seconds"))


def _named_nan(df: DataFrame, column: str) -> DataFrame:
    """NaN as null with a flag, so that results can be compared as values."""
    return df.withColumns(
        {"is_nan": F.coalesce(F.isnan(column), F.lit(False)), column: F.when(~F.isnan(column), F.round(column, 8))}
    )


@register
def parsed_log(spark, sf):
    return _named_nan(runs.parse_log(fx.train_log(spark, sf)), "train_loss")


@register
def log_report(spark, sf):
    return runs.log_report(fx.train_log(spark, sf))


@register
def run_progress(spark, sf):
    parsed = runs.parse_log(fx.train_log(spark, sf)).select("run", "step", "ts")
    return runs.with_progress(parsed)


@register
def main_process_log(spark, sf):
    return runs.parse_log(runs.main_process_only(fx.train_log(spark, sf))).select("run", "step", F.nanvl("train_loss", F.lit(-1.0)).alias("train_loss"))


@register
def loss_per_bucket(spark, sf):
    out = loss_by_bucket(runs.parse_log(fx.train_log(spark, sf)))
    return _named_nan(out, "mean_loss")


@register
def latest_checkpoint(spark, sf):
    return runs.latest_checkpoint(fx.checkpoints(spark, sf))


@register
def best_checkpoint(spark, sf):
    return runs.best_checkpoint(fx.checkpoints(spark, sf))


@register
def newest_checkpoints(spark, sf):
    return runs.newest_checkpoints(fx.checkpoints(spark, sf)).select("run", "path")


# Streams


@register
def streamed_blocks(spark, sf):
    schema = fx.read(spark, sf, "documents").schema
    docs = read_new_files(spark, f"{sf}/documents.parquet*", schema).select("doc_id", "text")
    out, state = fresh_path(spark, "stream-out"), fresh_path(spark, "stream-state")
    slots = spark.sparkContext.defaultParallelism
    stream_blocks(docs, fx.TOKENIZER, out, state, partitions=slots).awaitTermination()
    return _block_summary(storage.read_blocks(spark, out), ["doc_id", "block_no"])


STREAM_SHARDS = 4


@register
def streamed_packing(spark, sf):
    """Documents arrive in two parts and an end; each part is a run of its own that goes on from the state of the last."""
    docs = fx.documents(spark, sf).select(
        F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("key"), fx.TOKENIZER.encode("text", eos=True).alias("ids"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id")).alias("ts"),
    )
    docs = write_through(docs, "ids")
    half = docs.agg(F.max("seq")).first()[0] // 2
    end = spark.range(1).select(
        F.lit(None).cast("bigint").alias("seq"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("array<int>").alias("ids"),
        F.timestamp_seconds(F.lit(4_000_000_000)).alias("ts"),
    )
    inbox, out, state = (fresh_path(spark, f"packing-{n}") for n in ("in", "out", "state"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    try:
        for part in (docs.filter(F.col("seq") <= half), docs.filter(F.col("seq") > half), end):
            part.write.mode("append").parquet(inbox)
            blocks = pack_stream(read_new_files(spark, inbox, docs.schema, max_files=100_000), STREAM_SHARDS)
            q = blocks.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
            q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return _id_summary(spark.read.schema(blocks.schema).parquet(out), ["shard", "block_no"], "input_ids")


def _streamed(spark, sf, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a query over the stream of log lines has appended when all lines have been read."""
    schema = fx.read(spark, sf, "events").schema
    lines = fx.log_lines(read_new_files(spark, f"{sf}/events.parquet*", schema))
    metrics = runs.parse_log(lines).withColumn("ts", F.col("ts").cast("timestamp"))
    out = fresh_path(spark, "loss-out")
    (
        build(metrics)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", fresh_path(spark, "loss-state"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(out)


@register
def streamed_progress(spark, sf):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    try:
        return latest_progress(_streamed(spark, sf, progress_stream)).drop("alarms")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


@register
def streamed_loss(spark, sf):
    return _named_nan(_streamed(spark, sf, windowed_loss), "mean_loss").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "run",
        "mean_loss",
        "is_nan",
        "latest_step",
        "first_bucket",
        "last_bucket",
        "lines",
    )


@register
def streamed_bucket_means(spark, sf):
    return _named_nan(bucket_means(_streamed(spark, sf, streamed_bucket_loss)), "mean_loss")


def blocks_per_language(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks, tokens and padding share per language."""
    docs = fx.documents(spark, sf).select("doc_id", "lang", X.strip("text").alias("text"))
    out = pretraining.tokenize_and_block(docs, BYTE_TOKENIZER)
    return out.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.sum(_n_tokens()).alias("n_tokens"),
        (1 - F.sum(_n_tokens()) / F.sum(F.size("input_ids"))).alias("pad_share"),
    )


register(blocks_per_language)
