"""Ids through the stored dictionary against the tokenizer itself."""

import pytest

from textloom.catalog import fixtures as fx
from textloom.operators import dictionary as D
from textloom.workspace import fresh_path

TEXTS = ["", None, " ", "hello hello world", "a</s>b <pad>", "x" * 300, "the the the the\n\n the", "\u3000 é ñandú \U0001f600", "one two " * 200]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "k long, text string").repartition(3)


@pytest.mark.parametrize(("hot", "run"), [(65_536, 4096), (0, 7), (3, 1)])
def test_ids_equal_the_tokenizers(spark, docs, hot, run):
    dictionary = D.extend_dictionary(docs, fx.TOKENIZER, fresh_path(spark, "test-dictionary"))
    got = {r.k: r.ids for r in D.encode_with_dictionary(docs, dictionary, "k", hot=hot, run=run).collect()}
    want = {r.k: r.ids or [] for r in docs.select("k", fx.TOKENIZER.encode("text").alias("ids")).collect()}
    assert got == want
    counts = {r.k: r.n_tokens for r in D.count_with_dictionary(docs, dictionary, "k", hot=hot).collect()}
    assert counts == {k: len(v) for k, v in want.items()}


def test_runs_are_short(spark, docs):
    dictionary = D.extend_dictionary(docs, fx.TOKENIZER, fresh_path(spark, "test-dictionary"))
    runs = D.encode_runs(docs, dictionary, "k", run=5).collect()
    assert len({(r.k, r.run) for r in runs}) == len(runs) and {r.k for r in runs} == set(range(len(TEXTS)))
    longest = max(len(x) for r in dictionary.collect() for x in [r.ids])
    assert max(len(r.ids) for r in runs) <= 5 * longest and max(r.run for r in runs) == 80


def test_only_new_pretokens_are_encoded(spark, docs):
    path = fresh_path(spark, "test-dictionary")
    first = D.extend_dictionary(docs.filter("k < 5"), fx.TOKENIZER, path).count()
    encoded = spark.sparkContext.accumulator(0)

    class Counting:
        merges = fx.TOKENIZER.merges

        @staticmethod
        def encode_piece(c):
            from pyspark.sql import functions as F

            @F.udf("string")
            def seen(x):
                encoded.add(1)
                return x

            return fx.TOKENIZER.encode_piece(seen(F.col(c)))

    every = D.extend_dictionary(docs, Counting, path)
    assert every.count() - first == encoded.value > 0
    assert every.select("pretoken").distinct().count() == every.count()
    before = encoded.value
    assert D.extend_dictionary(docs, Counting, path).count() == every.count() and encoded.value == before


def test_another_tokenizer_has_its_own_dictionary(spark, docs):
    from textloom.operators.tokenizer import Tokenizer

    path = fresh_path(spark, "test-dictionary")
    D.extend_dictionary(docs, fx.TOKENIZER, path)
    other = Tokenizer.from_strings([("e", "l")])
    assert D.read_dictionary(spark, path, other).isEmpty()
    got = {r.pretoken: r.ids for r in D.extend_dictionary(docs, other, path).collect()}
    assert len(got[" hello"]) == 5


def test_texts_of_one_key_go_by_place(spark):
    rows = [(1, "b a"), (1, "a c d"), (None, "x"), (None, None), (2, None), (2, ""), (3, "a a"), (3, "a a")]
    docs = spark.createDataFrame(rows, "k long, text string").repartition(3)
    dictionary = D.extend_dictionary(docs, fx.TOKENIZER, fresh_path(spark, "test-dictionary"))
    entries = {r.pretoken: r.ids for r in dictionary.collect()}

    def ids(*pieces):
        return [x for p in pieces for x in entries[p]]

    first = sorted([" b", " a"], key=entries.get), sorted([" a", " c"], key=entries.get)
    for hot in (0, 65_536):
        got = {r.k: r.ids for r in D.encode_with_dictionary(docs, dictionary, "k", hot=hot).collect()}
        assert got == {1: ids(*first[0], *first[1], " d"), None: ids(" x"), 2: [], 3: ids(*[" a"] * 4)}
        runs = {(r.k, r.run): r.ids for r in D.encode_runs(docs, dictionary, "k", hot=hot, run=2).collect()}
        assert runs[1, 0] == ids(*first[0], *first[1]) and runs[1, 1] == ids(" d") and len(runs) == 5


def test_pretokens_are_not_shuffled_one_by_one(spark):
    docs = spark.createDataFrame([(i, "one two three four " * 500) for i in range(8)], "k long, text string")
    dictionary = D.extend_dictionary(docs, fx.TOKENIZER, fresh_path(spark, "test-dictionary"))
    plan = D.encode_with_dictionary(docs, dictionary, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "pos" not in plan
