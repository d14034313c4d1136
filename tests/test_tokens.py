import json
from collections import Counter

import pyarrow as pa
import pytest

from textloom.functions import blocks as B
from textloom.functions.symbols import BYTE_TO_ID, id_to_symbol, printable, symbol_to_id
from textloom.operators import tokenizer as T
from textloom.operators.packing import explode_blocks, pack_rows, pad_to_longest
from textloom.operators.tokenizer import BYTE_TOKENIZER, Tokenizer
from textloom.operators import vocabulary as V
from textloom.operators.vocabulary import count_pretokens, learn_merges

SPECIAL_TEXTS = ["a</s>b", "</s>", "", "x <pad> y<s>", "</s></s> ", "a</s", "<unk>z\n</s>\n", "   ", "tail  "]


def library(tk, lines, vocab_size):
    tok = tk.Tokenizer(tk.models.BPE())
    tok.pre_tokenizer = tk.pre_tokenizers.ByteLevel(add_prefix_space=True, use_regex=True)
    tok.decoder = tk.decoders.ByteLevel()
    trainer = tk.trainers.BpeTrainer(
        vocab_size=vocab_size,
        special_tokens=["<s>", "<pad>", "</s>", "<unk>"],
        show_progress=False,
        initial_alphabet=tk.pre_tokenizers.ByteLevel.alphabet(),
    )
    tok.train_from_iterator(lines, trainer)
    return tok


def merges_of(tok):
    return [tuple(m) for m in json.loads(tok.to_str())["model"]["merges"]]


def learned(spark, lines, vocab_size, **kw):
    df = spark.createDataFrame([(x,) for x in lines], "text string")
    return learn_merges(count_pretokens(df), vocab_size, **kw)


def shown(tok):
    return [(printable(tok.tokens[a]), printable(tok.tokens[b])) for a, b in tok.merges]


@pytest.fixture(scope="module")
def trained(spark, sf):
    tk = pytest.importorskip("tokenizers")
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    lines = [x for t in texts for x in (t + "\n").splitlines(keepends=True)]
    return library(tk, lines, 420), learned(spark, lines, 420, pool_size=60), texts


def test_merges_and_vocabulary_match_library(spark, trained):
    lib, mine, _ = trained
    assert shown(mine) == merges_of(lib)
    table = mine.vocab_table(spark).collect()
    assert {r.token: r.token_id for r in table} == lib.get_vocab()
    assert [r.kind for r in sorted(table)][3:5] == ["special", "byte"]


def test_encoding_matches_library(spark, trained):
    lib, mine, texts = trained
    values = texts + SPECIAL_TEXTS
    df = spark.createDataFrame(list(enumerate(values)), "i int, text string")
    rows = df.select("i", mine.encode("text", eos=True).alias("ids"), mine.length("text").alias("n")).orderBy("i").collect()
    for v, r in zip(values, rows, strict=True):
        assert r.ids == lib.encode(v + "</s>", add_special_tokens=False).ids, v
        assert r.n == len(r.ids) - 1


def test_decoding_matches_library(spark, trained):
    lib, mine, texts = trained
    ids = [lib.encode(t).ids[:37] for t in texts + SPECIAL_TEXTS] + [[2, BYTE_TO_ID[0xE2], BYTE_TO_ID[0x82], 2], []]
    df = spark.createDataFrame(list(enumerate(ids)), "i int, ids array<int>")
    out = df.select("i", mine.decode("ids").alias("skip"), mine.decode("ids", False).alias("keep")).orderBy("i").collect()
    assert [r.skip for r in out] == [lib.decode(x, skip_special_tokens=True) for x in ids]
    assert [r.keep for r in out] == [lib.decode(x, skip_special_tokens=False) for x in ids]


CORPORA = [
    (["ab cd ab cd\n"], 300),
    (["x y\n", "x y\n"], 300),
    (["aaaa aaaaaaa aa\n"] * 3, 275),
    (["abc abc bc ab abcabc cab\n", "bca abab bcbc aab abbc\n"] * 2, 290),
]


@pytest.mark.parametrize("word_limit", [0, 3, 1000])
@pytest.mark.parametrize(("lines", "size"), CORPORA)
def test_small_corpora_match_library(spark, lines, size, word_limit):
    """With all rounds on the executors, with a few words at a time, and with all of them."""
    tk = pytest.importorskip("tokenizers")
    lib = library(tk, lines, size)
    mine = learned(spark, lines, size, pool_size=5, word_limit=word_limit)
    assert shown(mine) == merges_of(lib) and mine.vocab_size == lib.get_vocab_size()


def test_thousands_of_merges_match_library(spark, sf, monkeypatch):
    """Rounds bring no more words than the limit, and make many merges each."""
    tk = pytest.importorskip("tokenizers")
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    lines = [x for t in texts for x in (t + "\n").splitlines(keepends=True)]
    rounds = []
    held = V._merge_held

    def counted(found, pairs, after, pool, symbols, size):
        before = len(symbols.merges)
        out = held(found, pairs, after, pool, symbols, size)
        rounds.append((found.num_rows, len(symbols.merges) - before, len(out[0])))
        return out

    monkeypatch.setattr(V, "_merge_held", counted)
    mine = learned(spark, lines, 5000, pool_size=3000, word_limit=6000)
    assert shown(mine) == merges_of(library(tk, lines, 5000)) and len(mine.merges) >= 4000
    assert all(words <= 6000 and changed <= words and merges for words, merges, changed in rounds)
    assert len(rounds) < 60


def test_full_vocabulary_matches_library(spark, sf):
    """Production size: merges go on until no pair is left."""
    tk = pytest.importorskip("tokenizers")
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    mine = learned(spark, texts, V.VOCAB_SIZE)
    assert shown(mine) == merges_of(library(tk, texts, V.VOCAB_SIZE)) and len(mine.merges) > 20_000


def test_merges_that_give_an_existing_token(spark):
    """Words in which one token comes about in several ways, so that other words' pairs gain."""
    import random

    tk = pytest.importorskip("tokenizers")
    rng = random.Random(12)
    for seed in range(4):
        lines = [" ".join("".join(rng.choice("ab" if seed % 2 else "abc") for _ in range(rng.randrange(2, 14))) for _ in range(40)) + "\n" for _ in range(12)]
        lib = library(tk, lines, 480)
        for limit in (40, 150, 2000):
            assert shown(learned(spark, lines, 480, pool_size=25, word_limit=limit)) == merges_of(lib)


def test_repeated_results_use_the_lowest_rank(spark):
    tok = Tokenizer.from_strings([("b", "c"), ("a", "b"), ("ab", "c"), ("abc", "d"), ("a", "bc")])
    ranks = tok._ranks()
    start = [BYTE_TO_ID[b] for b in b"abcd"]
    assert [tok.tokens[i] for i in T.merge_ids(start, ranks)] == [b"abcd"]
    assert tok.vocab_size == 260 + 4 and tok.merge_results[4] == tok.merge_results[2]


def test_scan_and_heap_agree(monkeypatch):
    import random

    rng = random.Random(5)
    tok = Tokenizer.from_strings([("a", "b"), ("b", "a"), ("ab", "a"), ("a", "a"), ("ba", "b"), ("aa", "a")])
    ranks = tok._ranks()
    words = [[BYTE_TO_ID[rng.choice(b"abc")] for _ in range(rng.randrange(0, 30))] for _ in range(500)]
    scanned = [T.merge_ids(w, ranks) for w in words]
    monkeypatch.setattr(T, "SCAN_LENGTH", -1)
    assert [T.merge_ids(w, ranks) for w in words] == scanned


def test_long_pretoken(spark):
    df = spark.createDataFrame([("ab" * 50_000,)], "text string")
    tok = Tokenizer.from_strings([("a", "b")])
    assert df.select(tok.length("text").alias("n")).first().n == 50_001


def test_symbols_skip_surrogates():
    ids = [0, 259, 31_999, 54_000, 60_000, 100_000]
    assert [symbol_to_id(id_to_symbol(i)) for i in ids] == ids
    assert all(not 0xD800 <= ord(id_to_symbol(i)) < 0xE000 for i in range(54_000, 58_000))


def test_null_text_gives_null_ids(spark):
    df = spark.createDataFrame([(0, "ab"), (1, None), (2, "")], "i int, text string")
    for tok in (BYTE_TOKENIZER, Tokenizer.from_strings([("a", "b")])):
        rows = df.select("i", tok.encode("text").alias("ids"), tok.length("text").alias("n")).orderBy("i").collect()
        assert rows[1].ids is None and rows[2].ids == [] and rows[2].n == 0 and len(rows[0].ids) == rows[0].n


def test_save_and_load(spark, trained, tmp_path):
    _, mine, _ = trained
    mine.save(spark, str(tmp_path / "t"))
    back = Tokenizer.load(spark, str(tmp_path / "t"))
    assert back == mine and back.pad_id == 1
    with pytest.raises(ValueError, match="pad id"):
        Tokenizer([], pad_id=260).check_pad()


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 8, 9])
def test_blocks(spark, n):
    df = spark.createDataFrame([(7, list(range(10, 10 + n)))], "doc_id int, ids array<int>")
    rows = explode_blocks(df, block_size=4).orderBy("block_no").collect()
    assert [r.block_no for r in rows] == list(range((n + 3) // 4))
    assert all(len(r.input_ids) == len(r.attention_mask) == 4 for r in rows)
    kept = [i for r in rows for i, m in zip(r.input_ids, r.attention_mask, strict=True) if m]
    assert kept == list(range(10, 10 + n))
    assert all(i == 1 for r in rows for i, m in zip(r.input_ids, r.attention_mask, strict=True) if not m)


def test_labels(spark):
    df = spark.createDataFrame([([5, 6, 1, 1],), ([5],), ([],)], "ids array<int>")
    rows = df.select(B.causal_labels("ids").alias("c"), B.shifted_labels("ids").alias("s")).collect()
    assert [r.c for r in rows] == [[5, 6, -100, -100], [5], []]
    assert [r.s for r in rows] == [[6, 1, 1, 2], [2], []]


def test_ids_in_range(spark):
    df = spark.createDataFrame([([0, 9],), ([10],), ([-1],), ([],)], "ids array<int>")
    assert [r.ok for r in df.select(B.ids_in_range("ids", 10).alias("ok")).collect()] == [True, False, False, True]


@pytest.mark.parametrize("parts", [1, 9])
def test_packing_is_concatenation(spark, parts):
    from test_ordering import h

    docs = [(k, [k * 100 + j for j in range(k % 7 * 3)]) for k in range(40)]
    df = spark.createDataFrame(docs, "k long, ids array<int>").repartition(parts)
    got = [r.input_ids for r in pack_rows(df, "k", 16).orderBy("block_no").collect()]
    flat = [i for k, ids in sorted(docs, key=lambda d: h(d[0])) for i in ids]
    assert got == [flat[i : i + 16] for i in range(0, len(flat), 16)]


def test_pad_to_longest(spark):
    df = spark.createDataFrame([(0, 0, [5, 6]), (1, 0, [7]), (2, 1, [8])], "i int, batch_id int, ids array<int>")
    rows = pad_to_longest(df).orderBy("i").collect()
    assert [r.input_ids for r in rows] == [[5, 6], [7, 1], [8]]
    assert [r.attention_mask for r in rows] == [[1, 1], [1, 0], [1]]


def test_encoding_runs_once_below_a_filter(spark, sf):
    from textloom.catalog import fixtures as fx
    from textloom.plans.finetuning import with_length

    df = with_length(fx.read(spark, sf, "documents").select("doc_id", "text"), fx.TOKENIZER, 20, 1024)
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_band_edges(spark):
    from textloom.plans.finetuning import with_length

    texts = [(n, "x" * (n - 1)) for n in (19, 20, 21, 1024, 1025)] + [(0, "</s>" * 11)]
    df = spark.createDataFrame(texts, "i int, text string")
    # A string of n - 1 letters is n byte tokens with its prefix space; 11 specials are 11 tokens.
    assert sorted(r.i for r in with_length(df, BYTE_TOKENIZER, 20, 1024).collect()) == [21, 1024]
    assert [r.length for r in with_length(df, BYTE_TOKENIZER, 10, 12).collect()] == [11]


def test_new_forms_are_not_rows_of_the_plan(spark):
    words = spark.createDataFrame([(None, "abc", 2), (None, "bcd", 3)], "old string, w string, n long")
    merged = V._replaced(words, {"abc": "aX"})
    assert sorted((r.old, r.w, r.n) for r in merged.collect()) == [(None, "aX", 2), (None, "bcd", 3)]
    assert "LocalRelation" not in merged._jdf.queryExecution().optimizedPlan().toString()


def test_many_words_come_as_few_runs(spark, monkeypatch):
    """No merge is left to the executors, and rounds stay few, when words are far more than the limit."""
    import random

    tk = pytest.importorskip("tokenizers")
    rng = random.Random(3)
    parts = "ka lo mi shu ter ing on pre ñu et aa aaa b".split()
    lines = [" ".join("".join(rng.choices(parts, k=rng.randrange(2, 6))) for _ in range(200)) + "\n" for _ in range(40)]
    rounds = []
    held = V._merge_held

    def counted(found, pairs, after, pool, symbols, size):
        before = len(symbols.merges)
        out = held(found, pairs, after, pool, symbols, size)
        rounds.append((found.num_rows, len(symbols.merges) - before))
        return out

    monkeypatch.setattr(V, "_merge_held", counted)
    mine = learned(spark, lines, 700, word_limit=300)
    assert shown(mine) == merges_of(library(tk, lines, 700))
    assert sum(n for _, n in rounds) == len(mine.merges) and len(rounds) < 30
    assert all(runs <= 300 for runs, _ in rounds)


def test_runs_of_words():
    """Symbols of any width; runs end where a pair is not held and where a word ends."""
    import numpy as np

    words = ["", "ab", "\u0104\u7fff", chr(0xE000) + chr(0x12345) + "z", "xabyab", "aaab", "b"]
    symbols, lengths = V._read(pa.chunked_array([pa.array(["gone", *words])]).slice(1))
    assert lengths.tolist() == [len(w) for w in words] and V._written(symbols, lengths).to_pylist() == words
    held = np.array(sorted(map(V._code, ["ab", "aa", "bb", "zx"])))
    starts, sizes, runs = V._runs(symbols, lengths, held)
    text = "".join(words)
    assert runs.to_pylist() == ["ab", "ab", "ab", "aaab"] == [text[i : i + n] for i, n in zip(starts, sizes, strict=True)]


def test_sums_are_let_out_in_parts(monkeypatch):
    parts = [pa.table({"w": [f"{i % 7}" for i in range(j, j + 20)], "n": [1] * 20}) for j in range(0, 100, 20)]

    def total(batches):
        out = Counter()
        for b in batches:
            for w, n in zip(b.column("w").to_pylist(), b.column("n").to_pylist(), strict=True):
                out[w] += n
        return out

    for rows in (3, 10, 1000):
        monkeypatch.setattr(V, "HELD_ROWS", rows)
        assert total(V._sums(parts)) == Counter(f"{i % 7}" for i in range(100))
    assert sum(b.num_rows for b in V._sums(parts, 5)) > 5


@pytest.mark.parametrize("word, pair", [("abcab", "ab"), ("xaby", "ab"), ("aaa", "aa"), ("ab", "ab"), ("cab", "ab"), ("aaaa", "aa")])
def test_a_merge_changes_only_pairs_around_it(word, pair):
    new = word.replace(pair, "Z")
    gone, come = map(Counter, V._difference(word, new, pair))
    every = Counter(V._adjacent(new)), Counter(V._adjacent(word))
    gone.subtract(come)
    every[1].subtract(every[0])
    assert +gone == +every[1] and -gone == -every[1]


def test_work_is_done_in_small_slices(monkeypatch):
    monkeypatch.setattr(T, "SLICE", 12)
    texts = pa.array([["ab", "c"], None, [], ["x" * 40], ["ab"], ["c", "d", "e", "f"]], pa.list_(pa.string()))
    for batch in (texts, texts.slice(1), texts.slice(2, 3), texts.slice(0, 0)):
        parts = list(T._in_slices(iter([batch])))
        assert [r for p in parts for r in p.to_pylist()] == batch.to_pylist()
        assert all(len(p) == 1 or sum(1 + len(x) for r in p.to_pylist() for x in r or []) <= 12 for p in parts)
        encoded = [r for p in T._encode_batches(iter(parts), {}) for r in p.to_pylist()]
        assert encoded == [None if r is None else [BYTE_TO_ID[b] for x in r for b in x.encode()] for r in batch.to_pylist()]
    pairs = pa.array([[["ab"], None], [["c"] * 20, []], None, [["d"], ["e"]]], pa.list_(pa.list_(pa.string())))
    assert [p.to_pylist() for p in T._in_slices(iter([pairs]))] == [[[["ab"], None]], [[["c"] * 20, []]], [None, [["d"], ["e"]]]]


def test_known_pretokens_take_bounded_room(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(T, "CACHED_BYTES", 1 << 19, raising=False)
    batches = (pa.array([[f" {i * 4000 + j}" for j in range(4000)]]) for i in range(50))
    tracemalloc.start()
    total = sum(len(out.flatten()) for out in T._encode_batches(batches, {}))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == sum(len(f" {i}") for i in range(200_000))
    assert peak < 12 << 20
