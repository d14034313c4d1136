"""The pipeline against its stages in plain Python."""

import collections

import public_tokenizers
import pytest
from conftest_llm import edge_rows
from test_pairs import plain_join
from test_rows import plain_contaminated, plain_quality, plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from textloom.llm.queries import bands, vocabularies


def plain_kept(rows):
    """Of each group the row with the smallest number, rows without one last."""
    groups = collections.defaultdict(list)
    for i, _, part in plain_join([(i, t) for i, (_, t) in enumerate(rows)]):
        groups[part].append(i)
    rank = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    return [rows[i] for i in sorted(min(g, key=rank) for g in groups.values())]


def plain_pipeline(rows, items):
    """(doc_id, text) rows that stay, with secrets masked."""
    loaded = {name: v.load() for name, v in vocabularies().items()}
    rows = [(d, t) for d, t, lang in rows if plain_quality(t, lang, loaded, bands())[-1]]
    kept = plain_kept(rows)
    bad = {row for row, _ in plain_contaminated([(i, t) for i, (_, t) in enumerate(kept)], items)}
    out = []
    for i, (d, t) in enumerate(kept):
        if i not in bad:
            masked, at = "", 0
            for start, _, _, end in plain_spans(t):
                if start >= at:
                    masked += t[at:start] + "[SECRET]"
                at = max(at, end)
            out.append((d, masked + t[at:]))
    return out


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_pipeline(spark, sf, library):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {d: library.encode(t, add_special_tokens=False).ids for d, t in plain_pipeline(rows, items)}
    got = corpus_pipeline.run(spark, sf).collect()
    assert len(got) == len(want)
    assert {r.doc_id: r.ids for r in got} == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_stages_on_edges(spark, sf, edges, nothing):
    """Each stage takes every kind of row and keeps the columns."""
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edges, sf)
        rows = out.collect()
        if stage is not corpus_pipeline.encoded:
            assert out.columns == edges.columns, name
        if stage is corpus_pipeline.deduplicate:
            want = plain_kept([r[:2] for r in edge_rows()])
            assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.text)) for r in rows)
        if stage in (corpus_pipeline.without_secrets, corpus_pipeline.encoded):
            assert len(rows) == len(edge_rows())
        assert stage(spark, nothing, sf).count() == 0, name


def test_different_texts_under_one_number_stay(spark, sf):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[1]), (None, texts[2]), (None, texts[2]), (3, texts[2])]
    kept = corpus_pipeline.deduplicate(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, texts[0]), (1, texts[1]), (3, texts[2])]
