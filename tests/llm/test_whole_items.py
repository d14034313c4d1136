"""Benchmark items of any length, and every passage that may hold one."""

import random

import pytest

from textloom.llm import decontaminate


def bench_text(rng, n):
    return " ".join(f"w{rng.randrange(30_000)}" for _ in range(n))


@pytest.mark.parametrize("length", [97, 128, 300, 1000])
def test_long_items_are_found(spark, length):
    """Verbatim copies of long items anywhere in a text, and copies with every tenth word changed."""
    rng = random.Random(length)
    items = [(i, bench_text(rng, length)) for i in range(20)] + [(100 + i, bench_text(rng, 30)) for i in range(50)]
    docs, want = [], set()
    for i, text in items[:20]:
        near = " ".join("other" if k % 10 == 3 else w for k, w in enumerate(text.split()))
        for d, copy in ((2 * i, text), (2 * i + 1, near)):
            docs.append((d, f"{bench_text(rng, rng.randrange(400))} {copy} {bench_text(rng, rng.randrange(100))}"))
            want.add((d, i))
    docs += [(1000 + i, t[: len(t) // 3]) for i, t in items[:20]]  # a third of an item is not the item
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame, bench).collect()} == want
    assert {r.doc_id for r in decontaminate.decontaminated(frame, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_parts_hold_every_word_of_an_item():
    words = [b"%d" % i for i in range(1000)]
    for n in (1, decontaminate.PART, decontaminate.PART + 1, 145, 300, 1000):
        first, *rest = decontaminate.parts(words[:n])
        assert first == words[:n] and bool(rest) == (n > decontaminate.PART)
        assert not rest or {w for part in rest for w in part} == set(first)
        assert all(len(part) == decontaminate.PART for part in rest)
