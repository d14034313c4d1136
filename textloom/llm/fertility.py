"""Quality rules from tokeniser fertility: how well public vocabularies fit a text."""

from __future__ import annotations

import base64
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom.llm.bpe import of_worker, slices, with_python_rows
from textloom.llm.words import grams, words_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
CACHED_BYTES = 64 << 20  # of known words, and what one takes besides its letters; neither changes a result
WORD = 200
PART = 1 << 20  # text whose words are looked up at a time


@dataclass(frozen=True)
class Piece:
    """A sentencepiece model with byte fallback, as its file's content."""

    model: bytes

    def load(self):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        fallback = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        return lambda word: model.encode(word), fallback

    def load_all(self):
        """The encoding of many words in one call."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        return lambda words: model.encode(words, num_threads=1)


@dataclass(frozen=True)
class Ranks:
    """A byte-level vocabulary as lines of base64 token and rank; parts of characters count as fallback."""

    lines: bytes
    pattern: str

    def ranks(self) -> dict[bytes, int]:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, self.lines.splitlines())}

    def model(self):
        import tiktoken

        return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks(), special_tokens={})

    def load(self):
        model, ranks = self.model(), self.ranks()
        fallback = np.zeros(max(ranks.values()) + 1, bool)
        for token, rank in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                fallback[rank] = True
        return lambda word: model.encode_ordinary(" " + word), fallback

    def load_all(self):
        """The encoding of many words in one call."""
        encode = self.model().encode_ordinary
        return lambda words: [encode(" " + w) for w in words]


def piece_model(path: str) -> Piece:
    with open(path, "rb") as f:
        return Piece(f.read())


def rank_file(path: str, pattern: str) -> Ranks:
    with open(path, "rb") as f:
        return Ranks(f.read(), pattern)


@dataclass(frozen=True)
class Band:
    """What one vocabulary may show on a text; outside of it the text is rejected."""

    chars_per_token: tuple[float, float] = (0.0, float("inf"))
    max_fallback: float = 1.0
    min_entropy: float = 0.0


@dataclass(frozen=True)
class Bands:
    """Bands by vocabulary and language, else by script, else the one named ``other``."""

    by_key: dict[str, dict[str, Band]] = field(default_factory=dict)

    def of(self, vocabulary: str, lang: str | None, text: str) -> Band:
        bands = self.by_key.get(vocabulary, {})
        if lang in bands:
            return bands[lang]
        return bands.get(script_of(text)) or bands.get("other") or Band()


# First code points of scripts with a band of their own; a run lasts until the next one.
_SCRIPTS = [(0x0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "other"), (0x600, "Arabic"),
            (0x780, "other"), (0x900, "Devanagari"), (0x980, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
            (0x2000, "none"), (0x2E80, "CJK"), (0xA4D0, "other"), (0xAC00, "CJK"), (0xD7B0, "other")]
_FIRST = np.array([s[0] for s in _SCRIPTS], np.uint32)


def script_of(text: str) -> str:
    """Script of most letters of the text; ASCII signs and digits do not count."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = points[(points >= 0x80) | ((points | 0x20) - 0x61 < 26)]
    counts = np.bincount(np.searchsorted(_FIRST, letters, "right") - 1, minlength=len(_SCRIPTS))
    totals: dict[str, int] = {}
    for (_, name), n in zip(_SCRIPTS, counts, strict=True):
        if name != "none":
            totals[name] = totals.get(name, 0) + int(n)
    best = max(totals, key=lambda k: totals[k])
    return best if totals[best] else "other"


class _Numbers(dict):
    """A number for each distinct word; new words are listed."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.room, self.size = np.empty(1 << 16, kind), 0

    def extend(self, values: np.ndarray) -> None:
        while self.size + len(values) > len(self.room):
            self.room = np.concatenate([self.room, np.empty_like(self.room)])
        self.room[self.size : self.size + len(values)] = values
        self.size += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


class _Words:
    """Hash and token ids of distinct words by their numbers; forgets everything when it holds too much.

    A word is looked up once, whatever the number of vocabularies, and the new words of
    some texts are encoded by one call for each vocabulary.
    """

    def __init__(self, vocabularies: dict):
        self.encoders = {name: source.load_all() for name, source in vocabularies.items()}
        self.fallback = {name: source.load()[1] for name, source in vocabularies.items()}
        self.clear()

    def clear(self) -> None:
        self.numbers, self.held = _Numbers(), 0
        self.hashes = _Grown(np.uint64)
        self.tokens = {name: _Grown(np.uint32) for name in self.encoders}
        self.ends = {name: _Grown(np.int64) for name in self.encoders}

    def of(self, words: list[bytes]) -> np.ndarray:
        if self.held > CACHED_BYTES:
            self.clear()
        out = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if fresh:
            self.held += sum(map(len, fresh)) + WORD * len(fresh)
            self.hashes.extend(np.fromiter(map(xxhash.xxh3_64_intdigest, fresh), np.uint64, len(fresh)))
            texts = [w.decode("utf-8", "replace") for w in fresh]
            for name, encode in self.encoders.items():
                ids = encode(texts)
                counts = np.fromiter(map(len, ids), np.int64, len(ids))
                own = self.tokens[name]
                self.ends[name].extend(own.size + np.cumsum(counts))
                own.extend(np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())))
        return out

    def ids(self, name: str, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of some words one after another, and how many each word has."""
        ends = self.ends[name].values
        begins = np.concatenate([[0], ends[:-1]])
        n = ends[numbers] - begins[numbers]
        at = np.repeat(begins[numbers] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.tokens[name].values[at], n


def _measures(ids: np.ndarray, n: np.ndarray, bounds: np.ndarray, fallback: np.ndarray) -> list[tuple[int, float, float]]:
    """Tokens, share of fallback tokens and entropy of each text; ``bounds`` cuts the words into texts."""
    ends = np.concatenate([[0], np.cumsum(n)])[bounds]
    total = np.diff(ends)
    text = np.repeat(np.arange(len(total)), total)
    plain = np.concatenate([[0], np.cumsum(fallback[ids])])
    back = plain[ends[1:]] - plain[ends[:-1]]
    seen = np.sort(text * len(fallback) + ids)
    first = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]])) if len(seen) else np.empty(0, np.int64)
    count, of = np.diff(first, append=len(seen)), seen[first] // len(fallback)
    share = count / total[of]
    entropy = np.zeros(len(total))
    if len(of):
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        entropy[of[starts]] = -np.add.reduceat(share * np.log2(share), starts)
    return [(t, b / t if t else 0.0, e) for t, b, e in zip(total.tolist(), back.tolist(), entropy.tolist(), strict=True)]


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside a window of words that stands in the text more than once."""
    runs = grams(hashes, window)
    if len(runs) < 2:
        return 0
    _, which, counts = np.unique(runs, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[which] > 1)
    if not len(again):
        return 0
    covered = np.zeros(len(hashes), bool)
    for i in range(window):
        covered[again + i] = True
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["n_tokens", "chars_per_token", "fallback_share", "entropy"]


def quality_rules(
    df: DataFrame, vocabularies: dict, bands: Bands, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Add base counts, each vocabulary's measures, ``base_failed`` and ``kept``.

    A word is encoded by itself, as a word inside a line, so a measure does not depend
    on what stands around it: characters of words per token, share of fallback tokens
    and entropy of the text's tokens in bits. Null and blank texts have zero counts and
    null measures, fail the base rules and are not kept. Every row is judged by itself:
    repeated rows stay, further columns pass through, and an existing column that has
    the name of a new one is replaced. Without a column ``lang`` the script decides.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabularies)  # the vocabulary files
    counts = [T.StructField(n, T.LongType()) for n in BASE]
    measures = [
        T.StructField(f"{v}_{m}", T.LongType() if m == "n_tokens" else T.DoubleType())
        for v in vocabularies
        for m in MEASURES
    ]
    fields = [*counts, *measures, T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    names = [f.name for f in fields]

    def make():
        key = tuple((name, hash(source)) for name, source in shared.value.items())
        known = of_worker("quality", key, lambda: _Words(shared.value))

        def row(t: str, language: str | None, hashes: np.ndarray, found: list[tuple[int, float, float]]) -> list:
            n = len(hashes)
            chars = len(t) - sum(map(t.count, SPACES))
            repeats = repeated_words(hashes)
            out = [n, chars, sum(map(t.count, SYMBOLS)), repeated_lines(t), repeats]
            failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
            kept = not failed
            for name, (tokens, share, entropy) in zip(known.encoders, found, strict=True):
                if not tokens:
                    out += [0, None, None, None]
                    kept = False
                    continue
                out += [tokens, chars / tokens, share, entropy]
                if kept:
                    band = bands.of(name, language, t)
                    low, high = band.chars_per_token
                    kept = low <= chars / tokens <= high and share <= band.max_fallback and entropy >= band.min_entropy
            return [*out, failed, kept]

        def some(texts: list[str], langs: list[str | None]) -> list[list]:
            words = [words_of(t) for t in texts]
            bounds = np.cumsum([0, *map(len, words)])
            numbers = known.of(list(chain.from_iterable(words)))
            hashes = known.hashes.values[numbers]
            found = [_measures(*known.ids(name, numbers), bounds, known.fallback[name]) for name in known.encoders]
            each = zip(*found, strict=True) if found else ([] for _ in texts)
            return [row(t, k, hashes[a:b], list(f)) for t, k, a, b, f in zip(texts, langs, bounds[:-1], bounds[1:], each, strict=True)]

        def work(batch):
            rows: list[list] = []
            for part in slices(batch, PART):
                texts = [t or "" for t in part.column(text).to_pylist()]
                langs = part.column(lang).to_pylist() if lang in part.schema.names else [None] * len(texts)
                rows += some(texts, langs)
            return {n: [r[i] for r in rows] for i, n in enumerate(names)}

        return work

    return with_python_rows(df.drop(*(set(names) - {text, lang})), make, fields)
