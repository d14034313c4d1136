import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.operators import evaluation as ev
from textloom.operators import runs
from textloom.operators.counts import observed
from textloom.operators.tokenizer import BYTE_TOKENIZER

PAIRS = "good_score double, bad_score double"


@pytest.mark.parametrize(
    ("scores", "correct", "verdict"),
    [
        ([(2.0, 1.0)] * 4 + [(1.0, 1.0)], 4, "excellent"),
        ([(2.0, 1.0)] * 3 + [(1.0, 1.0)] * 2, 3, "good"),
        ([(2.0, 1.0), (1.0, 2.0)], 1, "needs work"),
        ([], 0, None),
    ],
)
def test_pair_accuracy(spark, scores, correct, verdict):
    r = ev.pair_accuracy(spark.createDataFrame(scores, PAIRS)).first()
    assert (r.correct, r.total, r.verdict) == (correct, len(scores), verdict)
    assert r.accuracy == (correct / len(scores) if scores else None)


def test_group_advantage(spark):
    groups = {0: [1.0, 2.0, 4.5], 1: [3.0], 2: [2.0, 2.0]}
    rows = [(g, i, r) for g, rs in groups.items() for i, r in enumerate(rs)]
    df = spark.createDataFrame(rows, "prompt_id long, sample_id long, reward double")
    for scale in (True, False):
        for r in ev.group_advantage(df, scale=scale).collect():
            rs = groups[r.prompt_id]
            std = statistics.stdev(rs) if len(rs) > 1 else 0.0
            want = (r.reward - statistics.mean(rs)) / (std + 1e-4 if scale else 1)
            assert r.advantage == pytest.approx(want)


def test_comparison_keeps_prompts_of_one_model(spark):
    rows = [(1, "base", "p", "p Response: b"), (1, "tuned", "p", "p Response: t"), (2, "base", "q", "plain "), (3, "other", "z", "z")]
    df = spark.createDataFrame(rows, "prompt_id long, model string, prompt string, output string")
    got = {r.prompt_id: (r.prompt, r.base_response, r.tuned_response) for r in ev.compare_models(df).collect()}
    assert got == {1: ("p", "b", "t"), 2: ("q", "plain", None)}


def test_comparison_by_sample_is_a_full_outer_join(spark):
    rows = [(1, 0, "base", "x"), (1, 1, "base", "y"), (1, 0, "tuned", "z"), (2, 0, "tuned", "w"), (2, 0, "tuned", "v")]
    df = spark.createDataFrame([(p, s, m, "q", o) for p, s, m, o in rows], "prompt_id long, sample_id long, model string, prompt string, output string")
    got = sorted((r.prompt_id, r.sample_id, r.base_response, r.tuned_response) for r in ev.compare_models(df, sample="sample_id").collect())
    assert got == [(1, 0, "x", "z"), (1, 1, "y", None), (2, 0, None, "v"), (2, 0, None, "w")]


def test_rows_without_a_group_are_one_group(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 3.0), (7, 3, 5.0)], "prompt_id long, sample_id long, reward double")
    got = {r.sample_id: r.advantage for r in ev.group_advantage(df, scale=False).collect()}
    assert got == {1: -1.0, 2: 1.0, 3: 0.0}


def test_zip_stops_at_the_shorter_array(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], ["x", "y"]), (2, [], ["z"])], "k long, prompts array<string>, responses array<string>")
    got = [(r.k, r.position, r.prompt, r.response) for r in ev.zip_responses(df).collect()]
    assert got == [(1, 0, "a", "x"), (1, 1, "b", "y")]


def test_scorer_is_made_once_per_task(spark):
    def make():
        calls = []

        def scorer(ids):
            calls.append(1)
            return pd.Series([len(x) + (0 if len(calls) == 1 else 1000) * 1.0 for x in ids])

        return scorer

    df = spark.createDataFrame([("p", "r" * n) for n in (1, 5000)], "prompt string, response string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        got = [r.score for r in ev.score_rows(df, BYTE_TOKENIZER, make).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [len(" Instruction: p\nResponse: r"), 1024 + 1000]


def test_new_ids(spark):
    df = spark.createDataFrame([([1, 2, 3], 2), ([1], 1), ([1], 5)], "ids array<int>, n int")
    assert [r.x for r in df.select(ev.new_ids("ids", "n").alias("x")).collect()] == [[3], [], []]


def test_suite_report_counts_unanswered_prompts(spark):
    suite = spark.createDataFrame([(1, "math"), (2, "math"), (3, "chat")], "prompt_id long, group string")
    gens = spark.createDataFrame([(1, 2.0), (1, 4.0), (9, 1.0)], "prompt_id long, gen_seconds double")
    got = {r.group: (r.prompts, r.answers, r.total_seconds, r.avg_seconds) for r in ev.suite_report(gens, suite).collect()}
    assert got == {"math": (2, 2, 6.0, 3.0), "chat": (1, 0, None, None)}


def test_observed_counts(spark):
    df, seen = observed(spark.range(10), "stage", total=F.sum("id"))
    df.write.format("noop").mode("overwrite").save()
    assert (seen.get["rows"], seen.get["total"]) == (10, 45)


LINES = [
    "2025-07-23 10:00:00,125 - INFO - [Step 50] train_loss=3.1250 lr=0.00010000 runtime=12.50s samples/s=10.25 steps/s=0.0200 ",
    "2025-07-23 10:10:00,000 - INFO - [Step 100] train_loss=2.5000 ",
    "[Step 7] lr=0.00000100 runtime=1.00s",
    "2025-07-23 10:11:00,000 - INFO - no step here",
    "2025-07-23 10:00:00,000 - INFO - [Step 0] ",
]


def test_parse_log(spark):
    rows = runs.parse_log(spark.createDataFrame([(x,) for x in LINES], "value string")).orderBy("step").collect()
    assert [r.step for r in rows] == [0, 7, 50, 100]
    full = rows[2]
    assert (full.train_loss, full.lr, full.runtime, full.samples_per_second, full.steps_per_second) == (3.125, 1e-4, 12.5, 10.25, 0.02)
    assert full.ts.microsecond == 125000 and rows[1].ts is None
    assert rows[3].lr is None and rows[0].train_loss is None and rows[1].train_loss is None


def test_damaged_lines_do_not_stop_the_parse(spark):
    lines = [
        "2024-13-41 10:00:00,125 - INFO - [Step 1] train_loss=nan lr=1.2-3 ",
        "2025-07-23 10:00:00,125 - INFO - [Step 99999999999999999999] train_loss=1.0",
        "2025-07-23 10:00:00,125 - INFO - [Step 2] train_loss=-inf train_loss=7 runtime=x",
        "2025-07-23 10:00:00,125 - INFO - [Step 3", "", None,
    ]
    df = spark.createDataFrame([("r", x) for x in lines], "run string, value string")
    rows = {r.step: r for r in runs.parse_log(df).collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[1].train_loss != rows[1].train_loss and rows[1].lr is None and rows[1].ts is None
    assert rows[2].train_loss == float("-inf") and rows[2].runtime is None
    report = runs.log_report(df).first()
    assert (report["lines"], report.with_step, report.damaged, report.not_finite) == (6, 3, 3, 2)


def test_no_clock_without_time_or_run(spark):
    df = spark.createDataFrame([(None, 5, None), (None, 6, "2025-01-01 00:00:00"), ("a", 7, None)], "run string, step long, ts string")
    for r in runs.with_progress(df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))).collect():
        assert r.elapsed == ("00:00:00" if r.step == 6 else None)


def test_progress(spark):
    df = runs.parse_log(spark.createDataFrame([(x,) for x in LINES if "10:1" in x or "10:0" in x], "value string"))
    rows = runs.with_progress(df.withColumn("run", F.lit("r")), max_steps=1000).orderBy("step").collect()
    assert (rows[0].progress, rows[0].elapsed, rows[0].remaining) == (None, None, None)
    assert (rows[2].progress, rows[2].elapsed, rows[2].remaining) == (0.1, "00:10:00", "01:30:00")


def test_checkpoints(spark):
    rows = [("a", "o/checkpoint-9000", 2.0), ("a", "o/checkpoint-10000", 2.0), ("a", "o/checkpoint-500", 3.0), ("a", "o/checkpoint-20", 9.0), ("b", "o/b-x/checkpoint-1", None)]
    df = spark.createDataFrame(rows, "run string, path string, eval_loss double")
    assert {r.run: r.latest_path for r in runs.latest_checkpoint(df).collect()} == {"a": "o/checkpoint-10000", "b": "o/b-x/checkpoint-1"}
    assert {r.run: r.best_path for r in runs.best_checkpoint(df).collect()} == {"a": "o/checkpoint-9000"}
    assert sorted(r.path for r in runs.newest_checkpoints(df).filter("run = 'a'").collect()) == ["o/checkpoint-10000", "o/checkpoint-500", "o/checkpoint-9000"]
    plan = runs.newest_checkpoints(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
