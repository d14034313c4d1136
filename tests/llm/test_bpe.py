"""Encoding and decoding against the public library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textloom.llm import bpe
from textloom.llm.queries import byte_bpe, op1_bpe


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return bpe.Encoder(vocabulary)


def ids_of(encoder, text):
    return np.frombuffer(b"".join(encoder.chunks(text)), "<u4").tolist()


PIECES = st.sampled_from(
    ["a", "the", " ", "  ", "\n", "\t", "'s", "don't", "1", "²", "é", "é", "中文", "\U0001f600", "!?", "<|endoftext|>", "　", "\x1c", "\x85", "Ġ", "xyzzy", "-" * 70]
)


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.lists(PIECES, max_size=25).map("".join), st.text(max_size=60)))
def test_encoder_equals_library(encoder, library, text):
    assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_tokens_in_any_order_equal_library(encoder, library, vocabulary):
    rng = random.Random(5)
    tokens = [t.decode("utf-8", "ignore") for t in vocabulary.token_bytes]
    for _ in range(1500):
        text = "".join(rng.choice(tokens) for _ in range(rng.randrange(14)))
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_pieces_give_the_same_as_the_whole_with_bounded_state(vocabulary):
    rng = random.Random(6)
    letters = [t.decode() for t in vocabulary.ids if t.isalpha()]
    bound = vocabulary.lookahead + 3 * vocabulary.longest
    for _ in range(30):
        data = "".join(rng.choice(letters) for _ in range(400)).encode()
        transducer, out, at = bpe.Transducer(vocabulary), [], 0
        while at < len(data):
            step = rng.randrange(1, 9)
            out += transducer.feed(data[at : at + step])
            at += step
            assert len(transducer.data) <= bound
        assert out + transducer.finish() == vocabulary.merge(data)


def test_ids_emitted_never_change(vocabulary):
    """What the lookahead lets out is the beginning of the encoding of every longer text."""
    rng = random.Random(7)
    letters = [t.decode() for t in vocabulary.ids if t.isalpha()]
    for _ in range(20):
        start = "".join(rng.choice(letters) for _ in range(150)).encode()
        transducer = bpe.Transducer(vocabulary)
        final = transducer.feed(start)
        assert final
        for _ in range(4):
            whole = vocabulary.merge(start + "".join(rng.choice(letters) for _ in range(20)).encode())
            assert whole[: len(final)] == final


def test_decoder_carries_split_characters(vocabulary):
    decoder = bpe.Decoder(vocabulary)
    ids = [vocabulary.ids[bytes([b])] for b in "é中\U0001f600".encode()]
    pieces = [decoder.feed(i.to_bytes(4, "little")) for i in ids]
    assert "".join(pieces) + decoder.finish() == "é中\U0001f600"
    assert decoder.feed(ids[0].to_bytes(4, "little")) + decoder.finish() == "�"


def test_columns(edges, nothing, vocabulary, library):
    out = bpe.decode(bpe.encode(edges, vocabulary), vocabulary)
    rows = out.collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens) == (want, len(want))
        assert r.decoded == library.decode(want, skip_special_tokens=False)
        assert r.key == "clash"
    assert bpe.encode(nothing, vocabulary).count() == 0
    assert bpe.round_trip(nothing, vocabulary).count() == 0


def test_query(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_what_is_no_id(spark, vocabulary):
    rows = [([262, None, 257],), ([-1],), ([50257, 10**9],), ([],), (None,), ([50256],)]
    for kind in ("int", "bigint"):
        got = [r.decoded for r in bpe.decode(spark.createDataFrame(rows, f"ids array<{kind}>"), vocabulary).collect()]
        the, a = (vocabulary.token_bytes[i].decode() for i in (262, 257))
        assert got == [f"{the}\ufffd{a}", "\ufffd", "\ufffd\ufffd", "", "", "<|endoftext|>"]


def test_caches_are_bounded_by_bytes(monkeypatch, vocabulary, library):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 3000)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 50)
    own, rng = bpe.Encoder(vocabulary), random.Random(1)
    for _ in range(300):
        text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 40))) for _ in range(8))
        assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids
        for cache in (own.pretokens, own.spaced, own.plain):
            assert sum(map(len, cache)) + sum(map(len, cache.values())) <= 3300
        assert len(own.transducer.pairs) <= 50


def test_a_worker_keeps_one_operators_things():
    first = bpe.of_worker("x", 1, list)
    assert bpe.of_worker("x", 1, list) is first
    bpe.of_worker("y", 1, list)
    assert bpe.of_worker("x", 1, list) is not first


def test_slices_of_a_batch():
    import pyarrow as pa

    batch = pa.record_batch({"t": ["aa", None, "b" * 50, "", "ccc"], "n": [1, 2, 3, 4, 5]})
    parts = list(bpe.slices(batch, 10))
    assert [p.column("n").to_pylist() for p in parts] == [[1, 2], [3], [4, 5]]
    assert [p.num_rows for p in bpe.slices(batch.slice(0, 0), 10)] == [0]
