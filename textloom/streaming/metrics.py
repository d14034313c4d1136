"""Training metrics from growing logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.runs import main_process_only, parse_log

LOGGING_STEPS = 50


def read_log_stream(spark: SparkSession, path: str) -> DataFrame:
    """Metrics of all log files that appear under ``path``, the run being a file's folder.

    A file is read once, so logs should be rotated into new files.
    """
    run = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    lines = spark.readStream.text(path).select(run.alias("run"), "value")
    return parse_log(lines).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_loss(
    metrics: DataFrame, window: str = "1 hour", late: str = "10 minutes", logging_steps: int = LOGGING_STEPS
) -> DataFrame:
    """Mean loss, latest step and mean loss of each logged step bucket, per run and time window.

    Works on a batch table and, in append mode, on a stream, where lines later
    than the watermark are dropped. Losses are partly summed before the exchange.
    """
    lines = metrics.filter(F.col("train_loss").isNotNull())
    lines = main_process_only(lines) if "rank" in metrics.columns else lines
    return (
        lines.withWatermark("ts", late)
        .groupBy(F.window("ts", window), "run")
        .agg(
            F.avg("train_loss").alias("mean_loss"),
            F.max("step").alias("latest_step"),
            F.min(F.expr(f"step div {logging_steps}")).alias("first_bucket"),
            F.max(F.expr(f"step div {logging_steps}")).alias("last_bucket"),
            F.count(F.lit(1)).alias("lines"),
        )
        .select(F.col("window.start").alias("window_start"), "run", "mean_loss", "latest_step", "first_bucket", "last_bucket", "lines")
    )


def streamed_bucket_loss(
    metrics: DataFrame, window: str = "1 hour", late: str = "10 minutes", logging_steps: int = LOGGING_STEPS
) -> DataFrame:
    """Loss sum and lines per run, step bucket and time window of a batch table or stream.

    Both are additive: ``bucket_means`` adds up the windows that a bucket falls into.
    """
    lines = metrics.filter(F.col("train_loss").isNotNull())
    lines = main_process_only(lines) if "rank" in metrics.columns else lines
    return (
        lines.withWatermark("ts", late)
        .groupBy(F.window("ts", window), "run", F.expr(f"step div {logging_steps}").alias("bucket"))
        .agg(F.sum("train_loss").alias("loss"), F.count("train_loss").alias("lines"))
        .select(F.col("window.start").alias("window_start"), "run", "bucket", "loss", "lines")
    )


def bucket_means(parts: DataFrame) -> DataFrame:
    """Mean loss per run and step bucket from the parts that the stream has closed."""
    sums = parts.groupBy("run", "bucket").agg(F.sum("loss").alias("loss"), F.sum("lines").alias("lines"))
    return sums.select("run", "bucket", (F.col("loss") / F.col("lines")).alias("mean_loss"), "lines")


def loss_by_bucket(metrics: DataFrame, logging_steps: int = LOGGING_STEPS) -> DataFrame:
    """Mean loss per run and bucket of steps."""
    return (
        metrics.groupBy("run", F.expr(f"step div {logging_steps}").alias("bucket"))
        .agg(F.avg("train_loss").alias("mean_loss"), F.count("train_loss").alias("lines"))
    )
