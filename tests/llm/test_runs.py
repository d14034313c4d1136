"""Periodic runs against comparison of every word with every other."""

import hashlib
import random
import zlib

import pytest
from conftest_llm import edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import runs
from textloom.llm.queries import op12_periodic_runs, with_repeats
from textloom.llm.words import hash_words


def repeating(doc_id, words):
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def plain_runs(words, min_length=6, min_exponent=4):
    n, found = len(words), []
    for p in range(1, n // min_exponent + 1):
        start = 0
        while start < n - p:
            end = start
            while end < n - p and words[end] == words[end + p]:
                end += 1
            whole = words[start : end + p]
            if end > start and len(whole) >= max(min_length, min_exponent * p):
                if not any(whole[q:] == whole[:-q] for q in range(1, p)):
                    found.append((start, len(whole), p))
            start = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def of_texts(texts, *limits):
    words = [str(w).encode() for t in texts for w in t]
    bounds = [0]
    for t in texts:
        bounds.append(bounds[-1] + len(t))
    import numpy as np

    got = runs.runs_of(hash_words(words), np.array(bounds), *limits).tolist()
    return [[tuple(r[1:]) for r in got if r[0] == i] for i in range(len(texts))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=60), max_size=6), st.sampled_from([(6, 4), (3, 3), (10, 5)]))
def test_two_words_only(texts, limits):
    assert of_texts(texts, *limits) == [plain_runs(t, *limits) for t in texts]


def test_planted_periods():
    rng = random.Random(3)
    for _ in range(60):
        texts = []
        for _ in range(rng.randrange(1, 8)):
            words = [rng.randrange(rng.choice((1, 3, 400))) for _ in range(rng.randrange(260))]
            for _ in range(rng.randrange(3)):
                a, p = rng.randrange(max(1, len(words))), rng.randrange(1, 50)
                for i in range(a + p, min(len(words), a + p * rng.randrange(2, 9))):
                    words[i] = words[i - p]
            texts.append(words)
        assert of_texts(texts) == [plain_runs(t) for t in texts]


def test_few_periods_are_refused():
    with pytest.raises(ValueError):
        of_texts([[1, 1]], 2, 2)


def test_edges(edges, nothing):
    got = runs.periodic_runs(edges.withColumnRenamed("a", "runs")).collect()
    want = []
    for row in edge_rows():
        words = (row[1] or "").encode().split()
        found = plain_runs(words)
        want.append((row[0], row[1], tuple(found), collapsed(words, found).decode()))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.text, tuple(map(tuple, r.runs)), r.collapsed)) for r in got)
    assert any(r.runs for r in got) and got[0].kept == "clash"
    assert runs.periodic_runs(nothing).count() == 0


def test_one_very_long_text(spark):
    text = "lead " + "a b c d e f g " * 40_000 + "tail"
    row = runs.periodic_runs(spark.createDataFrame([(text,)], "text string")).first()
    assert [tuple(r) for r in row.runs] == [(1, 280_000, 7)] and row.collapsed == "lead a b c d e f g tail"


def test_planted_repeats(spark):
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "a b", "  x\ty\n\nz\x0bw\x1cv\u3000u ", " ".join(f"w{i}" for i in range(90))]
    rows = [(100 * i + k, t) for k, t in enumerate(texts) for i in range(40)] + [(None, "a b")]
    for key, text in with_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        before = texts[key % 100] if key is not None else "a b"
        words = (before or "").encode().split()
        assert (text or "").encode().split() == repeating(key, words)
        assert text == before or zlib.crc32(str(key).encode()) % 10 == 0


def test_query(spark, sf):
    rows = {r.doc_id: r for r in op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    planted = 0
    for doc_id, text in docs:
        words = repeating(doc_id, (text or "").encode().split())
        if len(words) > 1200:
            continue
        found = plain_runs(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        row = rows[doc_id]
        planted += bool(found)
        assert (row.n_runs, row.start, row.length, row.period) == (len(found), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert row.runs_sha256 == sha("".join("%d,%d,%d\n" % r for r in found).encode())
        assert row.collapsed_sha256 == sha(collapsed(words, found))
    assert planted > 5
