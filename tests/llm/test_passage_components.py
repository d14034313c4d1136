"""Documents that shared passages connect, against every run of 50 words."""

import collections
import random

import pytest
from conftest_llm import edge_rows
from test_pairs import components, plain_repeats

from textloom.llm import sparse_suffix
from textloom.llm.queries import op6_sparse_suffix


def plain_components(rows, least=50):
    where = collections.defaultdict(set)
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - least + 1) if d is not None else ():
            where[tuple(w[i : i + least])].add(d)
    links = [(min(v), d) for v in where.values() for d in v if len(v) > 1]
    return components({d for link in links for d in link}, links)


def passage_rows():
    """Pairs of equal documents around one passage, passages cut at many places, and one in many documents."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(5_000)}" for _ in range(n)]
    rows, passage = [], text(55)
    for _ in range(12):
        whole = " ".join([*text(40), *passage, *text(40)])
        rows += [whole, whole]
    for _ in range(30):
        shared = text(90)
        for _ in range(6):
            a = rng.randrange(40)
            rows.append(" ".join([*text(20), *shared[a : a + rng.randrange(45, 60)], *text(20)]))
    return [(i * 7 % 1009 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_components_of_passages(spark, parts):
    rows = passage_rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sparse_suffix.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.doc_id: r.n_words_repeated for r in got} == plain_repeats(rows)
    want = plain_components(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert len({want[d] for d, _ in rows[:24]}) == 1


def test_components_of_edges_and_query(spark, edges, sf):
    got = {r.doc_id: r.component_id for r in sparse_suffix.repeated_passages(edges).collect()}
    assert got == plain_components([r[:2] for r in edge_rows()])
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r.doc_id: r.component_id for r in op6_sparse_suffix(spark, sf).collect()} == plain_components(rows)
