"""Packing of whole rows and batches by budget against one row after the other."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.operators import packing


def plain_best_fit(sizes, length):
    rooms, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= s]
        if fits:
            i = min(fits)[1]
        else:
            i = len(rooms)
            rooms.append(max(length, s))
        rooms[i] -= s
        out.append(i)
    return out


def contents(bins, sizes):
    """The bins as multisets of sizes: which of several bins with equal room is taken does not matter."""
    held = {}
    for b, s in zip(bins, sizes):
        held.setdefault(b, []).append(int(s))
    return sorted(held.values())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 25), max_size=80), st.integers(1, 20))
def test_best_fit(sizes, length):
    sizes = sorted(sizes, reverse=True)
    got = packing.best_fit(np.array(sizes, np.int64), length)
    assert contents(got.tolist(), sizes) == contents(plain_best_fit(sizes, length), sizes)


@pytest.mark.parametrize("sizes, length", [([14, 12, 2, 1], 15), ([9, 8, 8, 7, 1, 1, 1], 10), ([6, 5, 3, 3, 2, 1, 1], 8)])
def test_the_first_of_equal_bins_is_taken(sizes, length):
    assert packing.best_fit(np.array(sizes, np.int64), length).tolist() == plain_best_fit(sizes, length)


def table(spark, rows=500, most=130):
    rng = random.Random(rows)
    data = [(i, [i] * rng.choice((0, rng.randrange(1, 20), rng.randrange(1, most)))) for i in range(rows)]
    return spark.createDataFrame([*data, (rows, None)], "k long, ids array<int>"), {i: len(x) for i, x in data if x}


@pytest.mark.parametrize("shards", [1, 4])
def test_every_row_is_whole(spark, shards):
    df, sizes = table(spark)
    found = [packing.pack_whole(df.repartition(n), "k", 100, shards=shards).collect() for n in (1, 7)]
    assert sorted(map(repr, found[0])) == sorted(map(repr, found[1]))
    seen = {}
    for r in found[0]:
        assert r.input_ids == [k for k, n in zip(r["keys"], r.lengths) for _ in range(n)]
        assert sum(r.lengths) <= 100 or len(r["keys"]) == 1
        seen.update(zip(r["keys"], r.lengths))
    assert seen == sizes and sum(len(r["keys"]) for r in found[0]) == len(sizes)
    assert len({(r.shard, r.block_no) for r in found[0]}) == len(found[0])


def test_fill_rate(spark):
    df, sizes = table(spark, 2000, 90)
    row = packing.fill_rate(packing.pack_whole(df, "k", 100), 100).first()
    assert (row.n_documents, row.n_tokens, row.n_long) == (len(sizes), sum(sizes.values()), 0)
    assert row.n_blocks == len(set(plain_best_fit(sorted(sizes.values(), reverse=True), 100)))
    assert row.fill == pytest.approx(sum(sizes.values()) / row.n_blocks / 100) and row.fill > 0.95


def test_batches_stay_below_the_budget(spark):
    df, sizes = table(spark)
    rows = packing.batches_by_tokens(df, "k", 400, shards=3).collect()
    assert {r.key: r.n_tokens for r in rows} == sizes and len(rows) == len(sizes)
    groups = {}
    for r in rows:
        assert r.input_ids == [r.key] * r.n_tokens + [1] * (len(r.input_ids) - r.n_tokens)
        groups.setdefault((r.shard, r.batch_no), []).append(r)
    for members in groups.values():
        assert len({len(r.input_ids) for r in members}) == 1 and max(r.n_tokens for r in members) == len(members[0].input_ids)
        assert sum(len(r.input_ids) for r in members) <= 400 or len(members) == 1
    used, places = sum(sizes.values()), sum(len(r.input_ids) for r in rows)
    in_order = packing.batches_by_tokens(df, "k", 1, shards=1).count()
    assert in_order == len(sizes) and 1 - used / places < 0.15


def test_ids_move_once(spark):
    df, _ = table(spark)
    for out in (packing.pack_whole(df, "k", 100, shards=2), packing.batches_by_tokens(df, "k", 400, shards=2)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
    empty = df.filter(F.lit(False))
    assert packing.pack_whole(empty, "k", 100).count() == 0 and packing.batches_by_tokens(empty, "k", 9).count() == 0
