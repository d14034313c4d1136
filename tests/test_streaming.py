from pyspark.sql import functions as F

from textloom.catalog import fixtures as fx
from textloom.plans.pretraining import tokenize_and_block
from textloom.streaming.blocks import read_new_files, stream_blocks
from textloom.streaming.metrics import bucket_means, loss_by_bucket, streamed_bucket_loss, windowed_loss


def block_rows(df):
    return sorted((r.doc_id, r.block_no, tuple(r.input_ids)) for r in df.select("doc_id", "block_no", "input_ids").collect())


def test_stream_restarts_without_gaps_or_repeats(spark, sf, tmp_path):
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first, second = docs.filter("doc_id < 90"), docs.filter("doc_id >= 90")
    for part in (first, second, None):
        if part is not None:
            part.repartition(3).write.mode("append").parquet(inbox)
        new = read_new_files(spark, inbox, docs.schema, max_files=2)
        stream_blocks(new, fx.TOKENIZER, out, state, block_size=64).awaitTermination()
    assert block_rows(spark.read.parquet(out)) == block_rows(tokenize_and_block(docs, fx.TOKENIZER, 64))


def test_late_lines_are_dropped(spark, tmp_path):
    schema = "ts timestamp, run long, step long, train_loss double, rank long"
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(*rows):
        df = spark.createDataFrame([(t, 1, s, x, rank) for t, s, x, rank in rows], "t string, run long, step long, train_loss double, rank long")
        df.select(F.to_timestamp("t").alias("ts"), "run", "step", "train_loss", "rank").coalesce(1).write.mode("append").parquet(inbox)
        stream = read_new_files(spark, inbox, spark.createDataFrame([], schema).schema)
        q = windowed_loss(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        q.outputMode("append").trigger(availableNow=True).start().awaitTermination()

    arrive(("2025-01-01 10:05:00", 10, 4.0, 0), ("2025-01-01 10:20:00", 60, 2.0, 0), ("2025-01-01 10:21:00", 61, 99.0, 1), ("2025-01-01 11:30:00", 90, 1.0, 0))
    arrive(("2025-01-01 10:30:00", 70, 50.0, 0), ("2025-01-01 13:00:00", 120, 1.0, 0))
    rows = {r.window_start.hour: r for r in spark.read.parquet(out).collect()}
    assert sorted(rows) == [10, 11]
    assert (rows[10].mean_loss, rows[10].latest_step, rows[10].first_bucket, rows[10].last_bucket, rows[10].lines) == (3.0, 60, 0, 1, 2)


def test_log_files_become_metrics(spark, tmp_path):
    from textloom.streaming.metrics import read_log_stream

    for run in ("r1", "r2"):
        (tmp_path / "logs" / run).mkdir(parents=True)
        lines = [f"2025-01-01 10:0{i}:00,000 - INFO - [Step {50 * i}] train_loss={i}.0000 " for i in range(1, 4)]
        (tmp_path / "logs" / run / "train.log").write_text("\n".join([*lines, "2025-01-01 12:00:00,000 - INFO - [Step 400] train_loss=1.0"]))
    q = windowed_loss(read_log_stream(spark, str(tmp_path / "logs" / "*"))).writeStream.format("parquet")
    q = q.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
    q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.run, r.mean_loss, r.latest_step) for r in rows) == [("r1", 2.0, 150), ("r2", 2.0, 150)]


def test_bucket_means(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 49, 3.0), (1, 50, None)], "run long, step long, train_loss double")
    assert {r.bucket: (r.mean_loss, r.lines) for r in loss_by_bucket(df).collect()} == {0: (2.0, 2), 1: (None, 0)}


def test_bucket_parts_add_up_to_the_batch_means(spark):
    rows = [(f"2025-01-01 {10 + i // 20}:{i % 20:02d}:00", i % 2, i, float(i), 0) for i in range(90)]
    df = spark.createDataFrame(rows, "ts string, run int, step long, train_loss double, rank long").withColumn("ts", F.to_timestamp("ts"))
    key = lambda r: (r.run, r.bucket)
    assert sorted(bucket_means(streamed_bucket_loss(df)).collect(), key=key) == sorted(loss_by_bucket(df).collect(), key=key)
