"""Encoders hold bounded runs and keep a word once."""

from textloom.llm import bpe, training_order


class _Model:
    def __init__(self):
        self.longest = 0

    def __hash__(self):
        return 7

    def model(self):
        return self

    def encode_ordinary(self, text):
        self.longest = max(self.longest, len(text))
        return list(text.encode())


def test_training_order_encodes_long_texts_in_runs(monkeypatch):
    monkeypatch.setattr(training_order, "PART", 10, raising=False)
    text = "ab  cd\x1c e  f " + "word " * 40 + " \n end"
    model = _Model()
    monkeypatch.setattr(training_order, "of_worker", lambda owner, key, make: make())
    encode = training_order.token_encoder(model)
    assert encode(text)[::2] == text.encode() and encode("") == b"" and model.longest <= 20


def test_training_order_ids_equal_those_of_whole_texts(monkeypatch):
    import numpy as np

    from textloom.llm import queries

    monkeypatch.setattr(training_order, "PART", 7, raising=False)
    ranks = queries.byte_ranks()
    whole = ranks.model().encode_ordinary
    encode = training_order.token_encoder(ranks)
    for text in ["", " ", "a  b c\n d \n\n e", "it's  12 34 ... ?! x", " 　x   y\x85z " * 9, "x" * 50, "é ñ \U0001f600 ß " * 20]:
        assert np.frombuffer(encode(text), "<u2").tolist() == whole(text)


def test_a_word_is_kept_once():
    v = bpe.Vocabulary.from_merges([bytes([b]) for b in range(256)], {})
    encoder = bpe.Encoder(v)
    text = " ".join(["first", *(f"w{'abcdefgh'[i % 8]}{'x' * (i // 8)}" for i in range(64))])
    assert b"".join(encoder.chunks(text))[::4] == text.encode()
    assert len(encoder.spaced) == 64 and not encoder.pretokens
