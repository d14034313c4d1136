"""Scores, accuracy, timing, advantages and model comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.blocks import BLOCK_SIZE, truncate
from textloom.functions.text import extract_response, instruction_response
from textloom.operators.skew import attach_group_values
from textloom.operators.tokenizer import Tokenizer

EXCELLENT, GOOD = 0.8, 0.6
EPSILON = 1e-4


def score_rows(
    df: DataFrame,
    tokenizer: Tokenizer,
    make_scorer: Callable[[], Callable[[pd.Series], pd.Series]],
    prompt: str = "prompt",
    response: str = "response",
    max_length: int = BLOCK_SIZE,
) -> DataFrame:
    """Add ``score``: the caller's scorer on the truncated ids of prompt and response.

    ``make_scorer`` runs once per task (it may load a model); the scorer gets a
    series of id arrays and returns as many floats.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for ids in batches:
            yield scorer(ids)

    ids = truncate(tokenizer.encode(instruction_response(prompt, response)), max_length)
    return df.withColumn("score", score(ids))


def pair_accuracy(df: DataFrame, good: str = "good_score", bad: str = "bad_score") -> DataFrame:
    """One row: ``correct, total, accuracy, mean_margin, verdict``.

    A pair is correct when the good score is strictly higher. No pairs give a
    null accuracy and verdict.
    """
    out = df.agg(
        F.coalesce(F.sum(F.when(F.col(good) > F.col(bad), 1).otherwise(0)), F.lit(0)).alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.avg(F.col(good) - F.col(bad)).alias("mean_margin"),
    ).withColumn("accuracy", F.when(F.col("total") > 0, F.col("correct") / F.col("total")))
    verdict = F.when(F.col("accuracy") >= EXCELLENT, "excellent").when(F.col("accuracy") >= GOOD, "good")
    return out.withColumn("verdict", F.when(F.col("accuracy").isNotNull(), verdict.otherwise("needs work")))


def generation_time(df: DataFrame, seconds: str = "gen_seconds", by: str | None = None) -> DataFrame:
    """Total and average generation time, overall or per group."""
    groups = [by] if by else []
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.sum(seconds).alias("total_seconds"), F.avg(seconds).alias("avg_seconds")
    )


def group_advantage(
    df: DataFrame,
    group: str = "prompt_id",
    row_key: str = "sample_id",
    reward: str = "reward",
    scale: bool = True,
    epsilon: float = EPSILON,
) -> DataFrame:
    """Add ``advantage``: reward minus its group's mean, over its deviation if ``scale``.

    A group of one has no deviation and gets advantage 0; rows without a group are
    one group. Group statistics are
    pre-aggregated and joined back, so one huge group does not end up in one task.
    """
    stats = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(reward).alias("_mean"),
        F.coalesce(F.stddev_samp(reward), F.lit(0.0)).alias("_std"),
    )
    centred = F.col(reward) - F.col("_mean")
    value = centred / (F.col("_std") + epsilon) if scale else centred
    out = attach_group_values(df, stats, group, "_n", row_key)
    return out.withColumn("advantage", value).drop("_n", "_mean", "_std")


def compare_models(
    generations: DataFrame,
    base: str = "base",
    tuned: str = "tuned",
    key: str = "prompt_id",
    model: str = "model",
    sample: str | None = None,
) -> DataFrame:
    """Full outer join of the two models' outputs: ``prompt, base_response, tuned_response``.

    With ``sample`` the answers of a prompt are matched by their number, and it is
    returned too. What only one model has answered has a null on the other side.
    Repeated answers under one key give a row for each combination.
    """
    keys = [key, sample] if sample else [key]

    def side(name: str) -> DataFrame:
        rows = generations.filter(F.col(model) == name)
        return rows.select(
            *keys, F.col("prompt").alias(f"_{name}"), extract_response("output").alias(f"{name}_response")
        )

    joined = side(base).join(side(tuned), keys, "full")
    return joined.select(
        *keys,
        F.coalesce(f"_{base}", f"_{tuned}").alias("prompt"),
        F.col(f"{base}_response").alias("base_response"),
        F.col(f"{tuned}_response").alias("tuned_response"),
    )


def zip_responses(df: DataFrame, prompts: str = "prompts", responses: str = "responses") -> DataFrame:
    """Pair two arrays by position, one row per pair, up to the shorter array."""
    n = F.least(F.size(prompts), F.size(responses))
    pairs = F.arrays_zip(
        F.slice(prompts, F.lit(1), n).alias("prompt"), F.slice(responses, F.lit(1), n).alias("response")
    )
    rest = [F.col(c) for c in df.columns if c not in (prompts, responses)]
    return df.select(*rest, F.posexplode(pairs).alias("position", "_pair")).select(
        *rest, "position", F.col("_pair.prompt").alias("prompt"), F.col("_pair.response").alias("response")
    )


def join_responses(prompts: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """Pair prompt rows with response rows on a key that is unique on both sides."""
    return prompts.join(responses, keys)


def new_ids(ids: str, n_prompt: str) -> Column:
    """The ids after the prompt's own."""
    return F.slice(F.col(ids), F.col(n_prompt) + 1, F.size(ids))


def suite_report(
    generations: DataFrame, suite: DataFrame, key: str = "prompt_id", group: str = "group", seconds: str = "gen_seconds"
) -> DataFrame:
    """Per prompt group: prompts in the suite, answered rows, total and average time.

    Generations are summed per prompt first, so the join is one row per prompt.
    """
    per_prompt = generations.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(seconds).alias("_seconds")
    )
    return (
        suite.join(per_prompt, key, "left")
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("prompts"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("answers"),
            F.sum("_seconds").alias("total_seconds"),
            (F.sum("_seconds") / F.sum("_n")).alias("avg_seconds"),
        )
    )
