import pytest
from pyspark.sql import functions as F

from textloom.catalog import fixtures as fx
from textloom.functions.text import conversation_text
from textloom.operators import chat, preferences
from textloom.operators.tokenizer import BYTE_TOKENIZER
from textloom.plans import finetuning, pretraining
from textloom.sources import registry, storage

TURNS = "array<struct<role:string,content:string>>"
ARENA = f"id long, winner string, conversation_a {TURNS}, conversation_b {TURNS}, language string"


def talk(word, n=30):
    return [("user", word * n), ("assistant", word * n)]


def test_winner_edges(spark):
    rows = [
        (0, "model_a", talk("a"), talk("b"), "English"),
        (1, "model_b", talk("a"), talk("b"), "English"),
        (2, None, talk("a"), talk("b"), "English"),
        (3, "", talk("a"), talk("b"), "English"),
        (4, "tie", talk("a"), talk("b"), "English"),
        (5, "model_a", [], talk("b"), "English"),
        (6, "model_a", None, talk("b"), "English"),
        (7, "model_a", talk("a"), talk("b"), "German"),
        (8, "model_a", talk("a"), talk("b"), None),
        (9, "model_b", talk("a"), [("system", "x" * 50)], "English"),
    ]
    got = {r.id: r for r in finetuning.chat_texts(spark.createDataFrame(rows, ARENA), BYTE_TOKENIZER).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    assert "a" * 30 in got[0].text and "b" * 30 in got[1].text
    again = {r.id: r for r in finetuning.chat_texts(spark.createDataFrame(rows[::-1], ARENA), BYTE_TOKENIZER).collect()}
    assert got == again
    assert all(r.length == len(r.text) + 1 for r in got.values())


def test_ties_take_both_sides(spark):
    side = chat.pick_winner("w", F.lit("a"), F.lit("b"), "id")
    df = spark.range(200).withColumn("w", F.lit("tie")).select(side.alias("s"))
    assert 60 < df.filter("s = 'a'").count() < 140


def test_turn_rows_match_nested_conversations(spark):
    turns = [(c, t, ("user", "assistant")[t % 2], f"word{c}-{t} " * 4) for c in range(12) for t in range(2 + c * 3)]
    turns += [(3, 90, "system", "s")]
    meta = [(k, ("model_a", "model_b", "tie")[k % 3], 2 * k, 2 * k + 1, "English" if k else "fr") for k in range(6)]
    tdf = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    mdf = spark.createDataFrame(meta, "id long, winner string, conv_a long, conv_b long, language string")
    by_conv = {}
    for c, t, role, text in sorted(turns):
        by_conv.setdefault(c, []).append((role, text))
    nested = spark.createDataFrame([(k, w, by_conv[a], by_conv[b], lang) for k, w, a, b, lang in meta], ARENA)
    for limit in (20_000, 400, 30):
        want = sorted(finetuning.chat_texts(nested, BYTE_TOKENIZER, limit).collect())
        got = sorted(finetuning.chat_texts_of_turns(tdf, mdf, BYTE_TOKENIZER, limit).collect())
        assert got == want
    assert len(want) < 5


COMPLETIONS = [
    ([("p", 3.0), ("q", 5.0), ("r", 5.0), ("s", 3.0)], ("q", "s")),
    ([("p", None), ("q", -1.0)], ("p", "q")),
    ([("p", None), ("q", 1.0)], ("q", "p")),
    ([("p", 2.0), ("q", 2.0), ("r", 2.0)], ("p", "r")),
    ([("p", 2.0)], None),
    ([], None),
]


def test_best_and_worst(spark):
    schema = "id long, instruction string, completions array<struct<response:string,overall_score:double>>"
    df = spark.createDataFrame([(i, "do", c) for i, (c, _) in enumerate(COMPLETIONS)], schema)
    want = {i: w for i, (_, w) in enumerate(COMPLETIONS) if w}
    pairs = preferences.best_and_worst(preferences.keep_comparable(df))
    assert {r.id: (r.chosen, r.rejected) for r in pairs.collect()} == want
    rows = df.select("id", F.posexplode("completions").alias("place", "c")).select(
        "id", "place", F.col("c.overall_score").alias("score"), F.col("c.response").alias("response")
    )
    got = preferences.best_and_worst_of_rows(rows, "id").collect()
    assert {r.id: (r.chosen, r.rejected) for r in got} == want
    tokens = finetuning.preference_tokens(df, BYTE_TOKENIZER, max_length=5).collect()
    assert len(tokens) == len(want) and all(len(r.input_ids_chosen) == 5 == len(r.attention_mask_rejected) for r in tokens)


def test_prompt_edges(spark):
    rows = [
        (0, "a" * 1500, None),
        (1, "a" * 1501, ""),
        (2, "do", "  "),
        (3, "do", "this\n"),
        (4, "é" * 400, None),
        (5, "x </s> y", None),
        (6, None, "only input"),
    ]
    df = spark.createDataFrame(rows, "id long, instruction string, input string")
    got = {r.id: r.prompt for r in finetuning.prompts(df, BYTE_TOKENIZER).collect()}
    assert got[0] == got[1] == "a" * 349
    assert got[2] == "do" and got[3] == "do\nthis"
    # 1 prefix byte and 174 two-byte letters leave one byte of the next letter.
    assert got[4] == "é" * 174 + "�"
    assert got[5] == "x  y"
    assert got[6] == "only input"
    clipped = df.select("id", F.length(finetuning.clipped_prompt()).alias("n")).collect()
    assert {r.id: r.n for r in clipped}[1] == 1500


@pytest.mark.parametrize("n", [3, 4, 5, 8])
def test_document_blocks(spark, n):
    docs = spark.createDataFrame([(1, "x" * (n - 2)), (2, None), (3, "")], "doc_id long, text string")
    rows = pretraining.tokenize_and_block(docs, BYTE_TOKENIZER, block_size=4).collect()
    counts = {}
    for r in rows:
        counts.setdefault(r.doc_id, []).append(sum(r.attention_mask))
    want = [4] * (n // 4) + ([n % 4] if n % 4 else [])
    assert sorted(counts[1], reverse=True) == want and counts[3] == [1] and 2 not in counts
    assert [r.input_ids for r in rows if r.doc_id == 3] == [[2, 1, 1, 1]]


def test_training_blocks_do_not_depend_on_partitions(spark, sf):
    docs = fx.read(spark, sf, "documents").select("doc_id", "text")
    runs = [
        sorted(map(str, pretraining.training_blocks(docs.repartition(p), fx.TOKENIZER, shards=s).collect()))
        for p, s in ((1, 3), (17, 8))
    ]
    assert runs[0] == runs[1]


def test_long_texts_are_dropped_only_on_request(spark):
    docs = spark.createDataFrame([(1, "x" * 10), (2, "x" * 11)], "doc_id long, text string")
    assert pretraining.tokenize_and_block(docs, BYTE_TOKENIZER).count() == 2
    assert pretraining.tokenize_and_block(docs, BYTE_TOKENIZER, max_chars=10).count() == 1


def test_raw_union_loses_pair_sources(spark):
    plain = registry.text_source("p", lambda s: s.createDataFrame([(1, " a "), (2, None)], "id long, text string"))
    pair = registry.pair_source("q", lambda s: s.createDataFrame([(1, "x", None)], "id long, prompt string, response string"), "prompt", "response")
    good = registry.union_sources(spark, [plain, pair]).collect()
    assert sorted((r.source, r.id, r.text) for r in good if r.text is not None) == [("p", 1, "a"), ("q", 1, "x")]
    raw = registry.union_sources(spark, [plain, pair], harmonize=False)
    assert raw.filter("text is not null").count() == 1 and raw.count() == 3


def test_text_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("s", "a\nb"), ("s", ""), ("t", "c\rd")], "source string, text string")
    storage.write_text(df, str(tmp_path / "x"))
    lines = storage.read_lines(spark, str(tmp_path / "x")).collect()
    assert sorted((r.source, r.text) for r in lines) == [("s", "\n"), ("s", "a\n"), ("s", "b\n"), ("t", "c\rd\n")]


def test_vocabulary_from_written_sources(spark, tmp_path):
    src = registry.text_source("p", lambda s: s.createDataFrame([(1, "abab ab"), (2, "ab")], "id long, text string"))
    tok = pretraining.vocabulary_of_sources(spark, [src], str(tmp_path / "v"), 261)
    assert tok.tokens[-1] == b"ab"


def test_materialize_builds_once_per_parameters(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    path = str(tmp_path / "m")
    assert storage.materialize(spark, build, path, {"a": 1}).count() == 1
    assert storage.materialize(spark, build, path, {"a": 1}).count() == 1
    assert storage.materialize(spark, build, path, {"a": 2}).count() == 2
    import os

    for d in os.listdir(path):
        os.remove(os.path.join(path, d, "_SUCCESS"))
    assert storage.materialize(spark, build, path, {"a": 1}).count() == 3


def test_rendered_column_is_reusable(spark):
    df = spark.createDataFrame([([("user", "q")],)], f"c {TURNS}")
    assert df.select(conversation_text("c").alias("t")).first().t == "User: q"


def test_one_conversation_with_a_third_of_all_turns(spark):
    """The hot conversation is left out by its turn count; the others are unaffected."""
    small = [(c, t, ("user", "assistant")[t % 2], f"word{c} " * 3) for c in range(1, 60) for t in range(10)]
    hot = [(0, t, ("user", "assistant")[t % 2], "x") for t in range(300)]
    turns = spark.createDataFrame(small + hot, "conv_id long, turn long, role string, text string")
    meta = [(k, "model_a", 2 * k, 2 * k + 1, "English") for k in range(30)]
    battles = spark.createDataFrame(meta, "id long, winner string, conv_a long, conv_b long, language string")
    got = finetuning.chat_texts_of_turns(turns, battles, BYTE_TOKENIZER, max_length=512)
    assert sorted(r.id for r in got.collect()) == list(range(1, 30))
    wide = finetuning.chat_texts_of_turns(turns, battles, BYTE_TOKENIZER, max_length=20_000)
    assert {r.id: r.text.count("\n") for r in wide.collect()}[0] == 299
