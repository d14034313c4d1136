"""Progress that a stream follows equals what the whole log says, and silent runs raise an alarm."""

import pytest
from pyspark.sql import functions as F

from textloom.operators.runs import with_progress
from textloom.streaming.blocks import read_new_files
from textloom.streaming.packing import use_rocksdb
from textloom.streaming.progress import latest_progress, progress_stream


def log(spark, rows):
    return spark.createDataFrame(rows, "run string, step long, t long").select("run", "step", F.timestamp_seconds("t").alias("ts"))


def test_latest_lines_and_alarms(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    try:
        inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
        parts = [
            [("a", 10, 1000), ("a", 30, 1200), ("a", 20, 1100), ("b", 5, 1050), ("b", 7, None)],
            [("a", 40, 1500), ("c", 0, 1400)],
            [("a", 900, 9000), ("c", 1, 8990)],
        ]
        for part in parts:
            log(spark, part).coalesce(1).write.mode("append").parquet(inbox)
            stream = progress_stream(read_new_files(spark, inbox, log(spark, []).schema), silence_seconds=3600)
            q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
            q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        got = {r.run: r for r in latest_progress(spark.read.parquet(out)).collect()}
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    every = log(spark, [r for p in parts for r in p if r[2] is not None])
    want = with_progress(every).groupBy("run").agg(F.max_by(F.struct("step", "progress", "elapsed", "remaining"), "ts").alias("r"), F.count("*").alias("n"))
    for r in want.collect():
        mine = got[r.run]
        assert (mine.step, mine.progress, mine.elapsed, mine.remaining, mine.lines) == (*r.r, r.n)
    assert {k: r.alarms for k, r in got.items()} == {"a": 0, "b": 1, "c": 0}


def test_other_state_stores_are_refused(spark):
    with pytest.raises(ValueError):
        progress_stream(log(spark, []))
