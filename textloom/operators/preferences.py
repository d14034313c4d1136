"""Best and worst completion per instruction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_and_worst(df: DataFrame, completions: str = "completions") -> DataFrame:
    """Add ``chosen`` and ``rejected`` from an array of ``{response, overall_score}``.

    Same as a stable sort by score, highest first, taking both ends: ties go to
    the earliest best and the latest worst. A missing score counts as 0.
    """
    scored = F.transform(
        completions,
        lambda c, i: F.struct(
            F.coalesce(c["overall_score"], F.lit(0.0)).alias("score"), (-i).alias("place"), c["response"].alias("response")
        ),
    )
    return df.withColumn("_scored", scored).select(
        *[F.col(c) for c in df.columns],
        F.array_max("_scored")["response"].alias("chosen"),
        F.array_min("_scored")["response"].alias("rejected"),
    )


def keep_comparable(df: DataFrame, completions: str = "completions") -> DataFrame:
    """Drop records with fewer than two completions."""
    return df.filter(F.size(completions) >= 2)


def best_and_worst_of_rows(
    rows: DataFrame, key: str, place: str = "place", score: str = "score", response: str = "response"
) -> DataFrame:
    """``key, chosen, rejected, n`` when each completion is a row of its own.

    Two running extremes per key: nothing is collected, and a very frequent key
    is mostly reduced before the shuffle.
    """
    rank = F.struct(F.coalesce(F.col(score), F.lit(0.0)).alias("s"), (-F.col(place)).alias("p"))
    value = F.struct(rank.alias("rank"), F.col(response).alias("response"))
    return (
        rows.groupBy(key)
        .agg(F.max(value).alias("best"), F.min(value).alias("worst"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= 2)
        .select(key, F.col("best.response").alias("chosen"), F.col("worst.response").alias("rejected"), "n")
    )
