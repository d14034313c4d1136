"""Every word of a text belongs to one paragraph, and pieces begin where their words say."""

import random

import numpy as np
from conftest_llm import same
from hypothesis import given, settings
from hypothesis import strategies as st
from test_pairs import plain_paragraphs, plain_units

from textloom.llm import paragraphs
from textloom.llm.words import hash_words


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 45), max_size=12))
def test_no_word_is_left_out(lengths):
    text = "\n".join(" ".join(f"w{i}" for i in range(n)) for n in lengths)
    found = paragraphs.paragraphs_of(text)
    assert all(len(p.split()) >= 30 for p in found)
    assert sum(len(p.split()) for p in found) == (sum(lengths) if sum(lengths) >= 30 else 0)


def test_pieces_against_every_window():
    rng = random.Random(2)
    for n in (0, 29, 30, 31, 59, 60, 61, 300):
        for words in (10, 100_000):
            text = " ".join(f"w{rng.randrange(words)}" for _ in range(n))
            got = paragraphs.pieces_of(hash_words(text.encode().split())).tolist()
            assert got == plain_units(text)[2]
            gaps = np.diff([-1, *got, max(0, n - 29)]) if got else []
            assert all(g <= paragraphs.WINDOW for g in gaps)


def test_short_and_joined_lines(spark):
    """Lines of 1 to 40 words, alone and after short ones, near lines, and a very common short one."""
    rng = random.Random(3)
    rows = []
    for n in range(1, 41, 3):
        line = [f"w{rng.randrange(10_000)}" for _ in range(n)]
        rows += [(len(rows), " ".join(line)), (len(rows) + 1, "\n \n" + " ".join(line).upper())]
        rows += [(len(rows), "one two\n" + " ".join([*line, "more"])), (len(rows) + 1, " ".join(["other", *line[1:]]))]
    rows += [(len(rows) + i, f"all rights reserved\nline of its own {i}") for i in range(300)]
    want = plain_paragraphs(rows)
    assert {r[0] for r in want} == {"paragraph", "piece"}
    same(paragraphs.near_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).drop("removed").collect(), want)
