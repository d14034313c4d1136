"""Latest progress of every run of a growing log, with an alarm for runs that have gone silent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from textloom.operators.runs import MAX_STEPS, clock
from textloom.streaming.packing import ROCKSDB

_STATE = T.StructType([T.StructField(n, T.LongType()) for n in ("first", "latest", "step", "lines")])
SEEN = T.StructType(
    [
        T.StructField("run", T.StringType()), T.StructField("first", T.LongType()), T.StructField("latest", T.LongType()),
        T.StructField("step", T.LongType()), T.StructField("lines", T.LongType()), T.StructField("silent", T.BooleanType()),
    ]
)


class _Progress(StatefulProcessor):
    """One run: its first and its latest line in microseconds, the step of the latest, and the number of lines."""

    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _STATE)

    def _row(self, key, silent: bool) -> pd.DataFrame:
        names = ("first", "latest", "step", "lines")
        return pd.DataFrame([{"run": key[0], **dict(zip(names, self.state.get())), "silent": silent}])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        first, last, lines = (held[0], (held[1], held[2]), held[3]) if held is not None else (None, None, 0)
        for pdf in rows:
            best = pdf.sort_values(["us", "step"]).iloc[-1]
            here = (int(best["us"]), int(best["step"]))
            last = here if last is None else max(last, here)
            first = min(int(pdf["us"].min()), here[0] if first is None else first)
            lines += len(pdf)
        self.state.update((first, *last, lines))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last[0] // 1000 + self.silence_ms)
        yield self._row(key, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._row(key, True)

    def close(self) -> None:
        pass


def progress_stream(metrics: DataFrame, silence_seconds: int = 3600, late: str = "0 seconds") -> DataFrame:
    """Rows ``run, first, latest, step, lines, silent`` of a stream of ``run, step, ts``: one for each run and batch.

    ``silent`` rows are alarms: a run had no line for ``silence_seconds`` of event time, which
    lines of other runs move on. Lines without a time count for nothing; lines that come out
    of order within ``late`` are taken in. Needs the RocksDB state store.
    """
    if metrics.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError("use_rocksdb(spark) before following runs")
    lines = metrics.filter(F.col("ts").isNotNull() & F.col("step").isNotNull())
    lines = lines.select(F.col("run").cast("string").alias("run"), F.col("step").cast("bigint").alias("step"), "ts", F.unix_micros("ts").alias("us"))
    return (
        lines.withWatermark("ts", late).groupBy("run")
        .transformWithStateInPandas(_Progress(1000 * silence_seconds), outputStructType=SEEN, outputMode="append", timeMode="eventTime")
    )


def latest_progress(seen: DataFrame, max_steps: int = MAX_STEPS) -> DataFrame:
    """``run, step, lines, progress, elapsed, remaining`` and ``alarms`` from what the stream has appended."""
    row = F.max_by(F.struct("first", "latest", "step", "lines"), F.struct("lines", "silent")).alias("r")
    out = seen.groupBy("run").agg(row, F.count(F.when(F.col("silent"), 1)).alias("alarms"))
    elapsed = (F.col("r.latest") - F.col("r.first")) / 1e6
    progress = F.when(F.col("r.step") > 0, F.col("r.step") / max_steps)
    out = out.select("run", F.col("r.step").alias("step"), F.col("r.lines").alias("lines"), progress.alias("progress"), elapsed.alias("_elapsed"), "alarms")
    left = F.col("_elapsed") / F.col("progress") - F.col("_elapsed")
    return out.select(
        "run", "step", "lines", "progress", F.when(F.col("progress").isNotNull(), clock("_elapsed")).alias("elapsed"),
        F.when(F.col("progress").isNotNull(), clock(left)).alias("remaining"), "alarms",
    )
