"""Fingerprints and their links against comparison of everything with everything."""

import random

import numpy as np
import pytest
import xxhash
from conftest_llm import edge_rows, same
from test_pairs import components

from textloom.llm import simhash
from textloom.llm.queries import op11_simhash


def plain_print(text, size=4):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, prints=None):
    prints = prints or [plain_print(t) for _, t in rows]
    known = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            known.setdefault(p, []).append(d)
    values = np.array(list(known), np.uint64)
    links = []
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= 4):
            links.append((i, int(j)))
    part = components(range(len(values)), [l for l in links if l[0] != l[1]])
    least = {}
    for i, p in enumerate(known):
        least[part[i]] = min(least.get(part[i], 1 << 62), *known[p])
    at = {p: least[part[i]] for i, p in enumerate(known)}
    return [(d, f"{p:016x}", at[p] if d is not None else None) for (d, _), p in zip(rows, prints)]


def test_edges(edges, nothing):
    same(simhash.near_duplicates(edges).collect(), plain([r[:2] for r in edge_rows()]))
    assert simhash.near_duplicates(nothing).count() == 0


def test_fingerprint_is_the_same_in_runs(monkeypatch):
    text = " ".join(random.Random(2).choice("a b c d e f g".split()) for _ in range(500))
    monkeypatch.setattr(simhash, "RUN", 7)
    for t in (text, "A B", "one", "", None, "a b c d"):
        assert simhash.fingerprint(t) == plain_print(t)


def test_every_value_is_within_the_radius_of_its_home():
    """And a neighbour's home is among the anchors a value is sent to."""
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)

    def sent(values):
        out, homes = [set() for _ in values], [set() for _ in values]
        for at, anchor, home in simhash.anchors(values):
            for i, a in zip(at.tolist(), anchor.tolist(), strict=True):
                assert a not in out[i]
                out[i].add(a)
                if home:
                    homes[i].add(a)
        return out, homes

    every, homes = sent(fps)
    for bit in range(64):
        _, moved = sent(fps ^ np.uint64(1 << bit))
        assert all(h <= e for h, e in zip(moved, every, strict=True))
    word = np.array([h & ((1 << simhash.CODE) - 1) for s in homes for h in s])
    assert not simhash._SYNDROME[word].any()
    assert sum(map(len, every)) / len(every) < 44


def near_values(rng, clusters, members):
    values = []
    for _ in range(clusters):
        v = rng.getrandbits(64)
        for _ in range(members):
            values.append(v)
            for _ in range(rng.randrange(6)):
                v ^= 1 << rng.randrange(64)
    return values


@pytest.mark.parametrize("cell", [5, 64, 1 << 14])
def test_planted_links(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(cell)
    prints = list(dict.fromkeys(near_values(rng, 60, 12) + near_values(rng, 3, 150)))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "rep long, fp long").repartition(3)
    got = simhash.links(classes).collect()
    want = plain([(i, None) for i in range(len(prints))], prints)
    part = components(range(len(prints)), [tuple(r) for r in got])
    assert [part[i] for i in range(len(prints))] == [w[2] for w in want]


def test_links_do_not_grow_with_the_square(spark):
    rng, base = random.Random(9), 0x123456789ABCDEF0
    prints = list({base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(4000)})
    classes = spark.createDataFrame([(i, f) for i, f in enumerate(np.array(prints, np.uint64).view(np.int64).tolist())], "rep long, fp long")
    assert simhash.links(classes).count() < 60 * len(prints)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    same(op11_simhash(spark, sf).collect(), plain(rows))
