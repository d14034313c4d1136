"""Chat, preference and prompt datasets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.blocks import BLOCK_SIZE, attention_mask, truncate
from textloom.functions.hashing import SEED
from textloom.functions.text import ROLE_LABELS, conversation_text, instruction_response, strip, with_input
from textloom.operators.chat import pick_winner, render_turns
from textloom.operators.filters import (
    drop_empty_text,
    keep_language,
    keep_nonempty,
    keep_token_band,
    long_enough_for_band,
)
from textloom.operators.ordering import sample_rows
from textloom.operators.preferences import best_and_worst, keep_comparable
from textloom.operators.skew import attach_group_values
from textloom.operators.tokenizer import Tokenizer

MIN_TOKENS = 20
# A label's words and signs are pretokens of their own, so each is at least one token.
TURN_TOKENS = min(len(re.findall(r"[^\W_]+|[^\w\s]+", label)) for label in ROLE_LABELS.values())
PROMPT_CHARS = 1500
PROMPT_TOKENS = 350
FALLBACK_CHARS = 500


def with_length(df: DataFrame, tokenizer: Tokenizer, low: int, high: int) -> DataFrame:
    """Add the token count of ``text`` as ``length`` and keep ``low < length <= high``."""
    likely = df.filter(long_enough_for_band(low))
    return drop_empty_text(keep_token_band(likely.withColumn("length", tokenizer.length("text")), low, high))


def chat_texts(
    arena: DataFrame,
    tokenizer: Tokenizer,
    max_length: int = BLOCK_SIZE,
    language: str = "English",
    key: str = "id",
    seed: int = SEED,
) -> DataFrame:
    """``id, text, length`` of the winning conversation of each battle.

    The language test comes first so that it reaches the scan.
    """
    battles = keep_language(arena, language).select(
        key,
        pick_winner("winner", F.col("conversation_a"), F.col("conversation_b"), key, seed).alias("conversation"),
    )
    texts = keep_nonempty(battles, "conversation").select(key, conversation_text("conversation").alias("text"))
    return with_length(texts, tokenizer, MIN_TOKENS, max_length)


def chat_texts_of_turns(
    turns: DataFrame,
    battles: DataFrame,
    tokenizer: Tokenizer,
    max_length: int = BLOCK_SIZE,
    language: str = "English",
    seed: int = SEED,
) -> DataFrame:
    """The same when conversations are stored as rows ``conv_id, turn, role, text``.

    ``battles`` holds ``id, winner, conv_a, conv_b, language``. Every wanted
    conversation is rendered once, however many battles share it. A rendered turn
    has at least ``TURN_TOKENS`` tokens, so a conversation with more turns than
    fit is certain to fail the length test; it is left out before its turns are
    brought together.
    """
    chosen = keep_language(battles, language).select(
        "id", pick_winner("winner", F.col("conv_a"), F.col("conv_b"), "id", seed).alias("conv_id")
    )
    spoken = turns.filter(F.col("role").isin(*ROLE_LABELS))
    # A conversation without spoken turns renders to the empty text, which is dropped anyway.
    sizes = spoken.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    shares = chosen.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.count(F.lit(1)).alias("_battles"))
    fits = F.col("_battles").isNotNull() & (F.col("_n") <= max_length // TURN_TOKENS)
    wanted = sizes.join(shares, "conv_id", "left").withColumn("_wanted", fits)
    kept = attach_group_values(spoken, wanted, "conv_id", "_n", "turn").filter("_wanted")
    texts = with_length(render_turns(kept, "conv_id"), tokenizer, MIN_TOKENS, max_length)
    # Only conversations that some battle chose are left, with their number of battles.
    texts = texts.join(shares, "conv_id")
    found = attach_group_values(chosen, texts, "conv_id", "_battles", "id")
    return found.filter(F.col("text").isNotNull()).select("id", "text", "length")


def _pair_tokens(df: DataFrame, tokenizer: Tokenizer, max_length: int, keep: list[Column]) -> DataFrame:
    """Tokenized chosen and rejected texts from ``instruction, chosen, rejected``."""
    sides = ("chosen", "rejected")
    ids = tokenizer.encode_each([instruction_response("instruction", s) for s in sides])
    tokens = df.select(*keep, ids.alias("_ids")).select(
        *keep, *[truncate(F.col("_ids")[i], max_length).alias(f"input_ids_{s}") for i, s in enumerate(sides)]
    )
    masks = {
        f"attention_mask_{side}": attention_mask(F.size(f"input_ids_{side}"), F.size(f"input_ids_{side}"))
        for side in ("chosen", "rejected")
    }
    return tokens.withColumns(masks)


def preference_tokens(
    records: DataFrame, tokenizer: Tokenizer, max_length: int = BLOCK_SIZE, carry: tuple[str, ...] = ("id",)
) -> DataFrame:
    """Token ids and masks of the best and worst completion of each record.

    ``records`` holds ``instruction`` and ``completions``. Pairs with equal scores stay.
    """
    pairs = best_and_worst(keep_comparable(records))
    return _pair_tokens(pairs, tokenizer, max_length, [F.col(c) for c in carry])


def preference_tokens_of_pairs(
    pairs: DataFrame, tokenizer: Tokenizer, max_length: int = BLOCK_SIZE, carry: tuple[str, ...] = ("id",)
) -> DataFrame:
    """The same from rows that already hold ``instruction, chosen, rejected``."""
    return _pair_tokens(pairs, tokenizer, max_length, [F.col(c) for c in carry])


def clipped_prompt(instruction: str = "instruction", extra: str = "input") -> Column:
    """Instruction and input, cut to the character limit."""
    return F.substring(with_input(instruction, extra), 1, PROMPT_CHARS)


def prompts(
    records: DataFrame,
    tokenizer: Tokenizer,
    max_tokens: int = PROMPT_TOKENS,
    key: str = "id",
) -> DataFrame:
    """``id, prompt``: cut by characters, then by tokens, decoded and stripped.

    Where decoding yields nothing the first characters of the prompt are used.
    """
    clipped = records.select(key, clipped_prompt().alias("_text"))
    ids = clipped.select(key, "_text", truncate(tokenizer.encode("_text"), max_tokens).alias("_ids"))
    decoded = ids.select(key, "_text", tokenizer.decode("_ids").alias("_decoded"))
    return decoded.select(
        key, strip(F.coalesce("_decoded", F.substring("_text", 1, FALLBACK_CHARS))).alias("prompt")
    )


def sampled_prompts(records: DataFrame, tokenizer: Tokenizer, n: int = 2000, key: str = "id") -> DataFrame:
    """``prompts`` of a uniform sample of ``n`` records."""
    return prompts(sample_rows(records, n, key), tokenizer, key=key)
