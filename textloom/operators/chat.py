"""Chat records: winner choice and rendering from turn rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.hashing import SEED, seeded_hash
from textloom.functions.text import strip, turn_line

TURNS_PER_CHUNK = 256


def pick_winner(winner: str, a: Column, b: Column, key: str, seed: int = SEED) -> Column:
    """``a`` or ``b`` by the winner label; any other label is a seeded coin flip."""
    coin = F.when(seeded_hash(key, seed=seed) % 2 == 0, a).otherwise(b)
    return F.when(F.col(winner) == "model_a", a).when(F.col(winner) == "model_b", b).otherwise(coin)


def render_turns(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``key, text`` with the chat lines of each conversation in turn order.

    Built in two steps, runs of turns first, so that sorting a very long
    conversation is spread over tasks; only its finished runs meet in one row.
    Conversations without any user or assistant turn give the empty text.
    """
    lines = turns.select(
        key, turn, turn_line(role, F.col(text)).alias("line"), F.expr(f"{turn} div {TURNS_PER_CHUNK}").alias("run")
    )

    def joined(order: str, value: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(order, value))))
        return F.array_join(F.transform(ordered, lambda x: x[value]), "\n")

    runs = lines.groupBy(key, "run").agg(joined(turn, "line").alias("part"), F.count("line").alias("n"))
    runs = runs.withColumn("part", F.when(F.col("n") > 0, F.col("part")))
    return runs.groupBy(key).agg(strip(joined("run", "part")).alias("text"))
