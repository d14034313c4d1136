"""Training-run logs and checkpoint catalogues."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions.text import clock
from textloom.operators.skew import attach_group_values

MAX_STEPS = 200_000
KEPT_CHECKPOINTS = 3

# The fields of a log line and the column each becomes.
LOG_FIELDS = {
    "train_loss": "train_loss",
    "lr": "lr",
    "runtime": "runtime",
    "samples/s": "samples_per_second",
    "steps/s": "steps_per_second",
}


# A number as the logs write it; what else follows the sign counts as damage.
_FIELD = "(?:^| )(" + "|".join(re.escape(f) for f in LOG_FIELDS) + r")=((?i)[-+]?(?:nan|inf(?:inity)?)|[-+.0-9e]+)?"
_STAMP = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d,\d{3} - "


def _fields(lines: DataFrame, value: str) -> DataFrame:
    """All columns of a line, the step included, with ``_damaged``: something is there that cannot be read.

    The fields are found in one pass over the line; of a repeated one the first counts.
    """
    names, numbers = (F.regexp_extract_all(value, F.lit(_FIELD), i) for i in (1, 2))
    rest = [c for c in lines.columns if c != value]
    split = lines.select(
        *rest,
        names.alias("_names"),
        numbers.alias("_numbers"),
        F.regexp_extract(value, r"\[Step ([^\]]*)\]?", 1).alias("_step"),
        F.when(F.col(value).rlike(_STAMP), F.replace(F.substring(value, 1, 23), F.lit(","), F.lit("."))).alias("_stamp"),
        F.contains(F.col(value), F.lit("[Step ")).alias("_stepped"),
    )

    def number(name: str) -> Column:
        return F.get("_numbers", F.array_position("_names", name).cast("int") - 1).try_cast("double")

    made = {"ts": F.col("_stamp").try_cast("timestamp_ntz"), "step": F.col("_step").try_cast("bigint")}
    made |= {col: number(name) for name, col in LOG_FIELDS.items()}
    typed = split.withColumns(made)
    unread = [F.array_contains("_names", name) & F.col(col).isNull() for name, col in LOG_FIELDS.items()]
    damaged = (F.col("_stamp").isNotNull() & F.col("ts").isNull()) | (F.col("_stepped") & F.col("step").isNull())
    for u in unread:
        damaged = damaged | u
    return typed.withColumn("_damaged", damaged).select(*rest, *made, "_damaged")


def parse_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Typed metrics of log lines; absent and unreadable fields are null, lines without a step are dropped.

    ``nan`` and ``inf`` stay, since a loss that is no number is what one looks for.
    """
    return _fields(lines, value).filter(F.col("step").isNotNull()).drop("_damaged")


def log_report(lines: DataFrame, run: str = "run", value: str = "value") -> DataFrame:
    """Per run: ``lines``, ``with_step``, ``damaged`` and ``not_finite`` losses."""
    loss = F.col("train_loss")
    return _fields(lines, value).groupBy(run).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("step").alias("with_step"),
        F.count(F.when(F.col("_damaged"), 1)).alias("damaged"),
        F.count(F.when(F.isnan(loss) | (F.abs(loss) == float("inf")), 1)).alias("not_finite"),
    )


def main_process_only(df: DataFrame, rank: str = "rank") -> DataFrame:
    return df.filter(F.col(rank) == 0)


def with_progress(
    df: DataFrame, max_steps: int = MAX_STEPS, run: str = "run", step: str = "step", ts: str = "ts"
) -> DataFrame:
    """Add ``progress``, ``elapsed`` and ``remaining``; null while there is no progress.

    A run starts at its first line; the starts are aggregated and joined back.
    """
    starts = df.groupBy(run).agg(F.min(ts).alias("_start"), F.count(F.lit(1)).alias("_n"))
    out = attach_group_values(df, starts, run, "_n", step)
    micros = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_start").cast("timestamp"))
    out = out.withColumn("_elapsed", micros / 1e6).withColumn(
        "progress", F.when(F.col(step) > 0, F.col(step) / max_steps)
    )
    left = F.col("_elapsed") / F.col("progress") - F.col("_elapsed")
    return (
        out.withColumn("elapsed", F.when(F.col("progress").isNotNull(), clock("_elapsed")))
        .withColumn("remaining", F.when(F.col("progress").isNotNull(), clock(left)))
        .drop("_start", "_n", "_elapsed")
    )


def checkpoint_step(path: str = "path") -> Column:
    """Numeric suffix after the last dash."""
    return F.substring_index(F.col(path), "-", -1).cast("bigint")


def latest_checkpoint(df: DataFrame, run: str = "run", path: str = "path") -> DataFrame:
    """``run, latest_path`` by the largest numeric suffix."""
    return df.groupBy(run).agg(F.max_by(path, checkpoint_step(path)).alias("latest_path"))


def best_checkpoint(df: DataFrame, run: str = "run", path: str = "path", loss: str = "eval_loss") -> DataFrame:
    """``run, best_path`` by the lowest loss; the earliest step wins a tie."""
    scored = df.filter(F.col(loss).isNotNull())
    return scored.groupBy(run).agg(
        F.min_by(path, F.struct(F.col(loss), checkpoint_step(path))).alias("best_path")
    )


def newest_checkpoints(
    df: DataFrame, keep: int = KEPT_CHECKPOINTS, run: str = "run", path: str = "path"
) -> DataFrame:
    """The ``keep`` newest rows of each run.

    The rank limit is applied on the map side as well, so a run with very many
    checkpoints sends only ``keep`` rows per task.
    """
    newest = Window.partitionBy(run).orderBy(F.desc(checkpoint_step(path)))
    return df.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= keep).drop("_place")
