"""The operators' input tables, derived from the given tables without leaving out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.preferences import best_and_worst_of_rows
from textloom.operators.tokenizer import Tokenizer
from textloom.sources.registry import Source, pair_source, text_source
from textloom.workspace import spread

# A short merge list for the checked queries. No two merges give
# the same string.
MERGES = [
    (" ", "t"), ("h", "e"), ("i", "n"), ("e", "r"), ("a", "n"), (" ", "a"), ("o", "u"), ("r", "e"),
    (" t", "he"), ("o", "n"), ("e", "n"), ("s", "t"), (" ", "d"), ("i", "t"), ("a", "u"), ("in", "g"),
    (" d", "er"), ("c", "h"), ("i", "e"), (" a", "n"), ("en", "t"), ("l", "e"), (" ", "s"), ("t", "i"),
]
TOKENIZER = Tokenizer.from_strings(MERGES)

PLAIN_SOURCES = ("web", "encyclopedia", "books")
WINNERS = ("model_a", "model_b", "tie", "tie (bothbad)")
ROLES = ("user", "assistant", "system")


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, rebalanced only when the file has fewer splits than there are slots."""
    return spread(read(spark, sf, "documents"))


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "conversations")


def reply_pairs(spark: SparkSession, sf: str, parity: int, left: str, right: str) -> DataFrame:
    """Each user turn with the assistant turn right after it; both sides unique on the key."""
    t = turns(spark, sf).filter(F.col("conv_id") % 2 == parity)
    asked = t.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias(left))
    given = t.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias(right)
    )
    pairs = asked.join(given, ["conv_id", "turn"])
    return pairs.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), left, right)


def corpus_sources(sf: str, head: float | None = None) -> list[Source]:
    """Five sources: the documents in three plain ones, the reply pairs in two."""

    def plain(i: int):
        return lambda spark: documents(spark, sf).filter(F.col("doc_id") % 3 == i).select(
            F.col("doc_id").alias("id"), "text"
        )

    out = [text_source(n, plain(i), head=head if i == 0 else None) for i, n in enumerate(PLAIN_SOURCES)]
    code = pair_source("code", lambda s: reply_pairs(s, sf, 0, "prompt", "response"), "prompt", "response")
    qa = pair_source("qa", lambda s: reply_pairs(s, sf, 1, "INSTRUCTION", "RESPONSE"), "INSTRUCTION", "RESPONSE")
    return [*out, code, qa]


def text_score(text: str | Column) -> Column:
    return (F.length(text) % 10) / 2.0


def _labels(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n")


def nested_arena(spark: SparkSession, sf: str) -> DataFrame:
    """One battle per document: its lines in turn order are one side, reversed the other."""

    def conversation(parts: Column) -> Column:
        return F.transform(
            parts, lambda x, i: F.struct(_labels(ROLES, i % 3).alias("role"), x.alias("content"))
        )

    return documents(spark, sf).select(
        F.col("doc_id").alias("id"),
        _labels(WINNERS, F.col("doc_id") % 4).alias("winner"),
        conversation(lines()).alias("conversation_a"),
        conversation(F.reverse(lines())).alias("conversation_b"),
        F.when(F.col("lang") == "en", "English").otherwise(F.col("lang")).alias("language"),
    )


def battles(spark: SparkSession, sf: str) -> DataFrame:
    """A battle per document between two conversations, in the document's language.

    There are more documents than conversations, so conversations are shared.
    """
    count = turns(spark, sf).agg(F.max("conv_id")).first()[0] + 1
    return read(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        _labels(WINNERS, F.col("doc_id") % 4).alias("winner"),
        (F.col("doc_id") % count).alias("conv_a"),
        ((F.col("doc_id") * 7 + 1) % count).alias("conv_b"),
        F.when(F.col("lang") == "en", "English").otherwise(F.col("lang")).alias("language"),
    )


def nested_completions(spark: SparkSession, sf: str) -> DataFrame:
    """One record per document: its lines are the completions."""
    completions = F.transform(
        lines(), lambda x: F.struct(x.alias("response"), text_score(x).alias("overall_score"))
    )
    return documents(spark, sf).select(
        F.col("doc_id").alias("id"), F.col("source").alias("instruction"), completions.alias("completions")
    )


def first_questions(spark: SparkSession, sf: str) -> DataFrame:
    return (
        turns(spark, sf)
        .filter("role = 'user'")
        .groupBy(F.col("conv_id").alias("id"))
        .agg(F.min_by("text", "turn").alias("instruction"))
    )


def preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """``id, instruction, chosen, rejected`` per conversation with two or more answers."""
    answers = turns(spark, sf).filter("role = 'assistant'")
    rows = answers.select(
        F.col("conv_id").alias("id"), F.col("turn").alias("place"), text_score("text").alias("score"), F.col("text").alias("response")
    )
    return first_questions(spark, sf).join(best_and_worst_of_rows(rows, "id"), "id")


def instructions(spark: SparkSession, sf: str) -> DataFrame:
    """First line of a document as the instruction, the rest as the input."""
    first = F.substring_index("text", "\n", 1)
    return documents(spark, sf).select(
        F.col("doc_id").alias("id"),
        first.alias("instruction"),
        F.substring(F.col("text"), F.length(first) + 2, F.length("text")).alias("input"),
    )


def generations(spark: SparkSession, sf: str) -> DataFrame:
    """Two outputs per preference pair: the chosen one by ``tuned``, the other by ``base``."""
    sides = F.explode(
        F.array(
            F.struct(F.lit("tuned").alias("model"), F.col("chosen").alias("answer")),
            F.struct(F.lit("base").alias("model"), F.col("rejected").alias("answer")),
        )
    )
    rows = preference_pairs(spark, sf).select(F.col("id").alias("prompt_id"), "instruction", sides.alias("s"))
    return rows.select(
        "prompt_id",
        F.col("s.model").alias("model"),
        F.concat(F.lit("Instruction: "), F.col("instruction"), F.lit("\nResponse:")).alias("prompt"),
        F.concat(F.lit("Instruction: "), F.col("instruction"), F.lit("\nResponse: "), F.col("s.answer")).alias("output"),
    ).withColumn("gen_seconds", F.length("output") / 100.0)


def rollouts(spark: SparkSession, sf: str) -> DataFrame:
    return turns(spark, sf).filter("role = 'assistant'").select(
        F.col("conv_id").alias("prompt_id"), F.col("turn").alias("sample_id"), text_score("text").alias("reward")
    )


def numbered_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of two models to each conversation: several numbered ones, some without a counterpart."""
    model = F.when(F.expr("turn div 2 % 2") == 0, "tuned").otherwise("base")
    return turns(spark, sf).filter("role = 'assistant'").select(
        F.col("conv_id").alias("prompt_id"),
        F.expr("turn div 4").alias("sample_id"),
        model.alias("model"),
        F.concat(F.lit("prompt "), F.col("conv_id").cast("string")).alias("prompt"),
        F.concat(F.lit("Response: "), F.col("text")).alias("output"),
    )


def log_lines(events: DataFrame) -> DataFrame:
    """A training-log line per event; works on a stream as well.

    By event number some lines have no step, no loss, a loss that is no number, or damage.
    """
    e = F.col("event_id")
    lr = F.when(F.col("event_type") != "error", F.format_string(" lr=%.8f", (e % 997) / F.lit(1e7))).otherwise("")
    loss = (
        F.when(e % 997 == 5, " train_loss=nan")
        .when(e % 11 == 7, "")
        .when(e % 19 == 4, " train_loss=1.2-3")
        .otherwise(F.format_string(" train_loss=%.4f", F.col("value")))
    )
    stamp = F.when(e % 23 == 6, "2024-13-41 00:00:00,000").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"))
    metrics = F.concat(
        F.format_string("[Step %d]", e + 1),
        loss,
        lr,
        F.format_string(" runtime=%.2fs samples/s=%.2f", (e % 5000) / F.lit(100.0), (F.col("user_id") % 300) / F.lit(4.0)),
        F.when(e % 3 == 0, F.format_string(" steps/s=%.4f ", (e % 400) / F.lit(16.0))).otherwise(" "),
    )
    value = F.concat(stamp, F.lit(" - INFO - "), F.when(e % 17 == 3, "saving a checkpoint").otherwise(metrics))
    return events.select((F.col("user_id") % 10).alias("run"), (e % 4).alias("rank"), value.alias("value"))


def train_log(spark: SparkSession, sf: str) -> DataFrame:
    return log_lines(spread(read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")))


def checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    run = F.col("user_id") % 10
    path = F.concat(F.lit("out/run-"), run.cast("string"), F.lit("/checkpoint-"), (F.col("event_id") + 1).cast("string"))
    return read(spark, sf, "events").select(run.alias("run"), path.alias("path"), F.col("value").alias("eval_loss"))
