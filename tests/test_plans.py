"""Shape of the physical plans that matter at scale."""

import re

from textloom.catalog import fixtures as fx
from textloom.operators import ordering
from textloom.operators.evaluation import group_advantage
from textloom.plans import finetuning, pretraining
from textloom.workspace import fresh_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_head_slice_is_a_pushed_down_filter(spark, sf):
    docs = fx.read(spark, sf, "documents")
    text = plan(ordering.head_fraction(docs, 0.1, "doc_id").select("doc_id"))
    assert "Exchange" not in text and "LessThanOrEqual(doc_id" in text


def test_sample_and_split_move_no_rows(spark, sf):
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    assert "Exchange" not in plan(ordering.train_test_split(docs, 0.1, "doc_id"))
    assert "Exchange" not in plan(ordering.sample_rows(docs, 20, "doc_id"))


def test_training_blocks_move_text_once(spark, sf):
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    text = plan(pretraining.training_blocks(docs, fx.TOKENIZER))
    assert text.count("Exchange ") == 1 and text.count("ArrowEvalPython") == 1
    assert text.index("ArrowEvalPython") < text.index("Exchange ")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_blocking_needs_no_exchange(spark, sf):
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    assert "Exchange" not in plan(pretraining.tokenize_and_block(docs, fx.TOKENIZER))


def test_language_filter_is_below_everything_else(spark, sf):
    arena = spark.read.schema(
        "id long, winner string, conversation_a array<struct<role:string,content:string>>, "
        "conversation_b array<struct<role:string,content:string>>, language string"
    ).parquet(f"{sf}/documents.parquet")
    assert "EqualTo(language,English)" in plan(finetuning.chat_texts(arena, fx.TOKENIZER))


def test_group_values_join_without_moving_hot_rows(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(group_advantage(fx.rollouts(spark, sf)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The shuffled join is on the key (null being one) and the salt, the broadcast one on the key alone.
    assert re.search(r"SortMergeJoin \[coalesce\(prompt_id#\d+L, 0\), isnull\(prompt_id#\d+L\), _salt#\d+\]", text), text
    assert "TakeOrderedAndProject(limit=1024" in text


def test_group_statistics_are_computed_once(spark, sf):
    out = group_advantage(fx.rollouts(spark, sf))
    out.collect()
    text = plan(out)
    assert "ReusedExchange" in text, text


def test_counts_are_combined_before_the_exchange(spark, sf):
    from textloom.operators.vocabulary import count_pretokens

    text = plan(count_pretokens(fx.read(spark, sf, "documents")))
    assert text.index("partial_count") > text.index("Exchange") and text.count("regexp_extract_all") == 1


def test_dictionary_counts_split_texts_once(spark, sf):
    from textloom.operators.dictionary import count_with_dictionary, extend_dictionary

    docs = fx.documents(spark, sf)
    out = count_with_dictionary(docs, extend_dictionary(docs, fx.TOKENIZER, fresh_path(spark, "plan")), "doc_id")
    out.collect()
    assert plan(out).split("== Initial Plan ==")[0].count("documents.parquet") == 1


def test_both_sides_of_a_pair_are_encoded_in_one_evaluation(spark, sf):
    assert plan(finetuning.preference_tokens(fx.nested_completions(spark, sf), fx.TOKENIZER)).count("ArrowEvalPython") == 1
