"""Operators on pairs of documents, against comparison of everything with everything."""

import collections
import random

import numpy as np
import pytest
from conftest_llm import edge_rows, same

from textloom.llm import ngram_join, paragraphs, sparse_suffix
from textloom.llm.components import connected_components
from textloom.llm.queries import op6_sparse_suffix, op9_paragraphs
from textloom.llm.words import grams, hash_words, mixed


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)) if words else frozenset()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def linked(sets):
    """Pairs of positions in the list whose sets are alike; only those that share a shingle are looked at."""
    where = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    common = collections.Counter((a, b) for v in where.values() for k, b in enumerate(v) for a in v[:k])
    return [(a, b) for (a, b), c in common.items() if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c)]


def plain_join(rows):
    docs = [(d, shingles(t)) for d, t in rows]
    keyed = [(d, s) for d, s in docs if d is not None]
    names = [d for d, _ in keyed]
    part = components(names, [(names[a], names[b]) for a, b in linked([s for _, s in keyed])])
    return [(d, len(s), part.get(d)) for d, s in docs]


@pytest.mark.parametrize("orders", [1, 2, 3])
def test_join_of_edges(edges, orders):
    want = plain_join([r[:2] for r in edge_rows()])
    same(ngram_join.similar_components(edges, orders=orders).collect(), want)


def test_join_with_everything_frequent_and_small_blocks(edges, nothing, monkeypatch):
    """Every token counts as frequent, buckets are salted and cut: the same result."""
    want = plain_join([r[:2] for r in edge_rows()])
    monkeypatch.setattr(ngram_join, "FREQUENT", 1)
    monkeypatch.setattr(ngram_join, "SALTED", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    same(ngram_join.similar_components(edges).collect(), want)
    assert ngram_join.similar_components(nothing).count() == 0


@pytest.mark.parametrize("tokens, block", [(20, 1024), (200, 3)])
def test_join_with_every_cluster_cut_by_wide_bitmaps(edges, tokens, block, monkeypatch):
    want = plain_join([r[:2] for r in edge_rows()])
    monkeypatch.setattr(ngram_join, "TOKENS", tokens)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "SIGNATURE", 64)  # full even for short sets
    same(ngram_join.similar_components(edges).collect(), want)


def test_long_sets_with_a_common_passage_are_no_cluster(spark, monkeypatch):
    """The narrow bitmaps of long sets are full; only sets that may be alike go on to be compared whole."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(7000, 9000))] for _ in range(24)]
    texts += [t[:2000] + ["other"] + t[2001:5000] + ["words"] + t[5001:] for t in texts[:4]]
    rows = [(i, " ".join(t[:100] + passage + t[100:])) for i, t in enumerate(texts)]
    clusters, cells = [], ngram_join._cells

    def kept(part):
        clusters.extend(r["count"] for r in part.groupBy("cluster").count().collect())
        return cells(part)

    monkeypatch.setattr(ngram_join, "TOKENS", 1 << 15)
    monkeypatch.setattr(ngram_join, "_cells", kept)
    same(ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect(), plain_join(rows))
    assert max(clusters, default=0) <= 2


def test_wide_bitmaps_are_in_the_class_of_every_set_alike():
    sets = [np.sort(mixed(np.arange(n, dtype=np.uint64))) for n in (0, 1, 1023, 1024, 1279, 1280, 5000)]
    got = [[(r["c"], r["n"], 64 * len(r["sig"])) for r in x] for x in ngram_join._wide_bitmaps(sets, 80).to_pylist()]
    assert got[:3] == [[], [(0, 1, 4096)], [(9, 1023, 4096)]]
    assert got[3] == [(10, 1024, 8192), (9, 1024, 4096)]
    assert got[4:] == [[(10, 1279, 8192)], [(10, 1280, 8192)], [(12, 5000, 32768), (11, 5000, 16384)]]


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7), (7, 6), (5, 4), (11, 11), (None, 1)] + [(100, i) for i in range(101, 160)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for p in links if None not in p and p[0] != p[1] for x in p}
    assert got == components(nodes, [p for p in links if None not in p and p[0] != p[1]])


def plain_repeats(rows, least=50):
    docs = collections.defaultdict(list)
    for d, t in rows:
        if d is not None:
            docs[d].append((t or "").encode().split())
    where = collections.defaultdict(set)
    for d, texts in docs.items():
        for w in texts:
            for i in range(len(w) - least + 1):
                where[tuple(w[i : i + least])].add(d)
    out = {}
    for d, texts in docs.items():
        covered = set()
        for w in texts:
            for i in range(len(w) - least + 1):
                if len(where[tuple(w[i : i + least])]) > 1:
                    covered.update(range(i, i + least))
        if covered:
            out[d] = len(covered)
    return out


def test_repeats_of_edges(edges, nothing):
    got = sparse_suffix.repeated_passages(edges).collect()
    assert {r.doc_id: r.n_words_repeated for r in got} == plain_repeats([r[:2] for r in edge_rows()])
    assert all(r.doc_id not in r.partners and r.partners for r in got)
    assert sparse_suffix.repeated_passages(nothing).count() == 0


def test_repeats_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r.doc_id: r.n_words_repeated for r in op6_sparse_suffix(spark, sf).collect()} == plain_repeats(rows)


def plain_units(text, least=30):
    """Paragraphs and pieces by their first word and number of words."""
    words, paragraphs, begin, at = [], [], 0, 0
    for line in (text or "").encode().lower().split(b"\n"):
        words += line.split()
        if len(words) - begin >= least:
            paragraphs.append([begin, len(words)])
            begin = len(words)
    if paragraphs:
        paragraphs[-1][1] = len(words)
    else:
        words = []
    anchor = hash_words(words)
    anchor = mixed(grams(anchor, 3)) if len(anchor) > 2 else anchor
    places = len(words) - least + 1
    pieces = set()
    for at in range(max(1, places - 30) if places > 0 else 0):
        pieces.add(min(range(at, min(at + 31, places)), key=lambda i: (anchor[i], i)))
    return words, paragraphs, sorted(pieces)


def plain_paragraphs(rows):
    """``kind, doc, start, words, first doc, its start`` of all that is repeated."""
    lines, sets, pieces = [], [], collections.defaultdict(list)
    for d, t in rows:
        words, paragraphs, starts = plain_units(t)
        for i, j in paragraphs:
            lines.append((d, i, j - i))
            sets.append(frozenset(tuple(words[k : k + 5]) for k in range(i, j - 4)))
        for i in starts:
            pieces[tuple(words[i : i + 30])].append(("piece", d, i, 30))
    groups = collections.defaultdict(list)
    for x, root in components(range(len(lines)), linked(sets)).items():
        groups[root].append(("paragraph", *lines[x]))
    out = []
    for members in [*groups.values(), *pieces.values()]:
        first = min(members, key=lambda m: (m[1] is not None, m[1] or 0, m[2]))
        out += [(*m, *first[1:3]) for m in members if len(members) > 1]
    return out


def test_paragraphs_of_edges(edges, nothing):
    got = paragraphs.near_paragraphs(edges)
    want = plain_paragraphs([r[:2] for r in edge_rows()])
    same(got.drop("removed").collect(), want)
    assert {r[0] for r in want} == {"paragraph", "piece"}
    clusters = {(r.kind, r.cluster_doc, r.cluster_start) for r in got.filter("not removed").collect()}
    assert clusters == {(r[0], r[4], r[5]) for r in want}
    assert paragraphs.near_paragraphs(nothing).count() == 0


def test_paragraphs_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    same(op9_paragraphs(spark, sf).drop("removed").collect(), plain_paragraphs(rows))


def test_a_passage_anywhere_has_a_piece(spark):
    """60 words over several lines or inside one, after any number of other words."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(40):
        before, after = ([word() for _ in range(rng.randrange(90))] for _ in range(2))
        cut = rng.randrange(60)
        inside = " ".join(passage[:cut]) + rng.choice((" ", "\n")) + " ".join(passage[cut:])
        rows.append((i, " ".join(before) + rng.choice((" ", "\n")) + inside + " " + " ".join(after)))
    got = paragraphs.near_paragraphs(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect()} == set(range(40))


def test_cells_let_out_no_more_links_than_rows(spark):
    """A large group of near copies around the threshold: components are right and links few."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randrange(2, 7)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    same(got.collect(), plain_join(rows))


def test_bands_are_tuned_for_recall():
    bands, rows = paragraphs.tune(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 > 1 - (1 - 0.8**rows) ** (bands - 1)


def test_components_with_hubs_and_chains(spark, monkeypatch):
    """Nodes with most of the links go round the shuffle: the same components."""
    from textloom.llm import components as C

    rng = random.Random(6)
    links = [(0, i) for i in range(1, 400)] + [(5000, i) for i in range(300, 700)] + [(i, i + 1) for i in range(10_000, 10_300)]
    links += [(rng.randrange(20_000, 20_400), rng.randrange(20_000, 20_400)) for _ in range(500)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    nodes = {x for p in links for x in p if p[0] != p[1]}
    want = components(nodes, [p for p in links if p[0] != p[1]])
    for small in (1000, 50):
        monkeypatch.setattr(C, "SMALL", small)
        monkeypatch.setattr(C, "HUBS", 20)
        assert {r.node: r.component for r in C.connected_components(df).collect()} == want
