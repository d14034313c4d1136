"""Trees and proofs against a plain recomputation of every level."""

import hashlib
import random
import zlib

import pytest
from conftest_llm import edge_rows, same
from pyspark.sql import functions as F

from textloom.llm import merkle
from textloom.llm.queries import op13_merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        n = levels[-1]
        levels.append([H(*n[i : i + 2]) for i in range(0, len(n), 2)])
    return levels


def way(levels, i):
    for level in levels[:-1]:
        pair = level[i & ~1 : (i & ~1) + 2]
        yield [x for x in (i & ~1, (i & ~1) + 1) if x != i and x < len(level)], pair, i & 1
        i >>= 1


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, more=0):
    doc, text, lang, source, n = row[:5]
    return H(field(doc), field(source), field(lang), field(None if n is None else n + more), field(text))


def plain(rows, tampered):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {g: levels_of([leaf_of(r) for r in groups[g]]) for g in order}
    top = levels_of([trees[g][-1][0] for g in order])
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = [*way(trees[g], i), *way(top, k)]
            siblings = []
            node = leaf_of(r, 1) if tampered(r[0]) else leaf_of(r)
            for others, pair, right in steps:
                if others:
                    siblings.append(pair[0 if right else 1])
                node = H(*([siblings[-1], node] if right else [node, siblings[-1]])) if others else H(node)
            root = top[-1][0]
            yield r[0], leaf_of(r), trees[g][-1][0], root, H(*siblings), node, node == root


def every_seventh(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0


def of_rows(df, bits=12):
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    other = merkle.field_hash([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in names])
    return merkle.manifest(df, claimed=F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, other), bits=bits)


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_edges_in_several_tiers(edges, nothing, bits):
    same(merkle.proofs(of_rows(edges, bits)).collect(), plain(edge_rows(), every_seventh))
    assert merkle.proofs(of_rows(nothing, bits)).count() == 0


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 8, 33])
def test_sizes_and_one_group(spark, rows):
    data = [(i * 3 % 100, f"text {i}", "en", None, i) for i in range(rows)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    same(merkle.proofs(of_rows(df, 2)).collect(), plain(data, every_seventh))


@pytest.mark.parametrize("total", [1, 2, 3, 4, 7, 8, 9, 31, 64, 100])
def test_places_are_the_order_of_completion(total):
    leaves = [bytes([i]) * 32 for i in range(total)]
    height = (total - 1).bit_length()
    log = merkle.grown(leaves, height)
    levels = levels_of([b.hex() for b in leaves])
    places = {merkle.position(k, i, total): h for k, level in enumerate(levels) for i, h in enumerate(level)}
    assert [places[p] for p in range(len(log))] == [b.hex() for b in log] and len(places) == len(log)


def test_same_trees_from_any_partitioning(spark):
    rng = random.Random(1)
    data = [(rng.randrange(10**9), "w " * rng.randrange(9), rng.choice(["a", "b", None]), "s", 3) for _ in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    roots = {merkle.manifest(df.repartition(n)).roots.roots().first().root for n in (1, 5, 40)}
    assert len(roots) == 1


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    got = op13_merkle(spark, sf).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    same(got, plain([tuple(r) for r in docs], every_seventh))
    assert 0 < sum(not r.verified for r in got) < len(got)
