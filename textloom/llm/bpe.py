"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

The encoding of a string is the only path of tokens in which every two neighbours
encode to themselves when joined. Reading bytes from left to right, the last token
of the encoding of each prefix is therefore enough to go on with, and only
prefixes that end within one token length of the head can still be continued.
A token is final once it lies further behind the head than the lookahead that the
merge list needs, so the state never grows with the text.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom.functions.symbols import printable

# Fixed value: the public split pattern of this kind of vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SPACES = frozenset(c for c in map(chr, range(0x10000)) if regex.match(r"\s", c))

# Bounds of a generation of a cache (bytes), of what enters it (characters), of the known pairs, and of
# the runs of text and bytes handled at a time; none of them changes a result.
CACHED_BYTES = 24 << 20
ROUND_TRIP_BYTES = 80 << 20  # where nothing but digests is made
CACHED_PAIRS = 1 << 18
LONG = 128
SLICE = 4 << 20
ENTRY = 104  # bytes of a dictionary for one entry
CHUNK = 1 << 14
PIECE = 1 << 10


@dataclass
class Vocabulary:
    """Tokens, merges and added tokens of a tokenizer file; plain tables that ship to executors."""

    token_bytes: list[bytes]
    ids: dict[bytes, int]
    merged: dict[tuple[int, int], tuple[int, int]]  # pair -> (rank, token)
    parts: dict[int, tuple[int, int, int]]  # token -> (rank, left, right)
    added: dict[str, int] = field(default_factory=dict)
    lookahead: int = 0
    longest: int = 1
    starts: dict = field(default_factory=dict)  # byte -> (token that ends here or -1, the same for the next byte)
    sizes: list[int] = field(default_factory=list)
    key: str = ""  # names the content

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        """Read a byte-level BPE file of the ``tokenizers`` library (driver only)."""
        with open(path, encoding="utf-8") as f:
            return cls.from_json(json.load(f))

    @classmethod
    def from_json(cls, spec: dict) -> Vocabulary:
        byte_of = {printable(bytes([b])): b for b in range(256)}
        vocab: dict[str, int] = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        table = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in vocab.items():
            if token not in added:
                table[i] = bytes(byte_of[c] for c in token)
        for token, i in added.items():
            table[i] = token.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merged = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        return cls.from_merges(table, merged, added)

    @classmethod
    def from_merges(cls, table, merged, added=None) -> Vocabulary:
        ids = {t: i for i, t in enumerate(table) if t and i not in set((added or {}).values())}
        parts: dict[int, tuple[int, int, int]] = {}
        for (a, b), (rank, t) in sorted(merged.items(), key=lambda x: x[1][0]):
            parts.setdefault(t, (rank, a, b))
        v = cls(table, ids, merged, parts, dict(added or {}))
        v.longest = max(map(len, ids), default=1)
        v.lookahead = sufficient_lookahead(v)
        v.sizes = list(map(len, table))
        v.key = hashlib.sha256(repr((table, list(merged.items()), added)).encode()).hexdigest()
        for t, i in ids.items():
            if v.merge(t) == [i]:  # tokens that no text gives are left out
                node = v.starts
                for byte in t[:-1]:
                    node = node.setdefault(byte, (-1, {}))[1]
                node[t[-1]] = (i, node.get(t[-1], (-1, {}))[1])
        return v

    def merge(self, data: bytes) -> list[int]:
        """Reference encoding of one pretoken: lowest rank first, leftmost first."""
        out = [self.ids[data[i : i + 1]] for i in range(len(data))]
        while len(out) > 1:
            found = [(self.merged[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in self.merged]
            if not found:
                break
            _, i = min(found)
            out[i : i + 2] = [self.merged[out[i], out[i + 1]][1]]
        return out


def sufficient_lookahead(v: Vocabulary) -> int:
    """Bytes right of a token boundary after which the boundary cannot change any more.

    A boundary behind token ``b`` is undone only by a merge ``(b, x)`` that comes
    before the merge which uses ``b`` otherwise; ``x`` must be complete for that,
    and may itself be held up by what follows it. Ranks fall along such a chain,
    so its longest length in bytes is found by one pass over the merges in order.
    """
    best: dict[int, list[tuple[int, int]]] = {}  # left token -> [(rank, longest chain up to that rank)]
    held: dict[int, int] = {}  # token -> bytes by which its own making may be held up
    rule = sorted(((rank, a, b, t) for (a, b), (rank, t) in v.merged.items()))

    def chain(token: int, before: int) -> int:
        found = 0
        for rank, most in reversed(best.get(token, ())):
            if rank < before:
                found = most
                break
        return found

    def spine(token: int) -> int:
        """Longest chain that could take away a part on the right edge of ``token``."""
        if token not in held:
            longest, t = 0, token
            while t in v.parts:
                rank, _, right = v.parts[t]
                longest, t = max(longest, chain(right, rank)), right
            held[token] = longest
        return held[token]

    for rank, a, b, _ in rule:
        reach = len(v.token_bytes[b]) + spine(b)
        rows = best.setdefault(a, [])
        rows.append((rank, max(reach, rows[-1][1] if rows else 0)))
    return max((max(chain(t, len(rule) + 1), spine(t)) for t in v.ids.values()), default=0) + v.longest


class Transducer:
    """Encodes one pretoken that arrives in pieces.

    It walks the path of longest tokens and steps back where two neighbours do not
    stay side by side. Bytes behind the lookahead are dropped, so it holds a window of
    the lookahead and two tokens.
    """

    def __init__(self, v: Vocabulary):
        self.v = v
        self.pairs: dict[tuple[int, int], bool] = {}
        self.start()

    def start(self) -> None:
        self.data = b""  # bytes that are not final yet
        self.head = 0  # where the path ends in them
        self.path: list[int] = []
        self.tries: list[list[int]] = []  # shorter tokens left to try at each step of the path
        self.dead: set[int] = set()  # ends from which no path goes on
        self.before = -1  # last final token

    def fits(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay as they are when they stand side by side."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._fits(a, b)
        return known

    def _fits(self, a: int, b: int) -> bool:
        v, before = self.v, len(self.v.merged) + 1
        none = (-1, 0, 0)
        while True:
            joined = v.merged.get((a, b))
            if joined is not None and joined[0] < before:
                return False
            ra, rb = v.parts.get(a, none), v.parts.get(b, none)
            # Undo the later of the two last merges; of equals, the right one was made later.
            if ra[0] < 0 and rb[0] < 0:
                return True
            if ra[0] > rb[0]:
                before, a = ra[0], ra[2]
            else:
                before, b = rb[0] + 1, rb[1]

    def whole(self, data: bytes) -> list[int]:
        """Ids of a pretoken that has arrived as one piece."""
        self.data = data
        self._walk(len(data))
        out = self.path
        self.start()
        return out

    def feed(self, data: bytes) -> list[int]:
        """Take more bytes; returns the ids that have become final."""
        self.data += data
        self._walk(len(self.data) - self.v.longest)
        return self._emit(self.head - self.v.lookahead)

    def finish(self) -> list[int]:
        self._walk(len(self.data))
        out = self._emit(self.head)
        self.start()
        return out

    def _walk(self, until: int) -> None:
        data, path, tries, dead = self.data, self.path, self.tries, self.dead
        sizes, starts, pairs = self.v.sizes, self.v.starts, self.pairs
        head, todo, last = self.head, None, self.path[-1] if self.path else self.before
        while head < until or todo is not None:
            if todo is None:  # tokens that start here, shortest first
                todo, node, at, end = [], starts, head, len(data)
                while at < end and (step := node.get(data[at])) is not None:
                    token, node = step
                    at += 1
                    if token >= 0:
                        todo.append(token)
            while todo:
                token = todo.pop()
                if dead and head + sizes[token] in dead:
                    continue
                if last >= 0:
                    fits = pairs.get((last, token))
                    if not (self.fits(last, token) if fits is None else fits):
                        continue
                path.append(token)
                tries.append(todo)
                head, todo, last = head + sizes[token], None, token
                break
            else:
                dead.add(head)
                head -= sizes[path.pop()]
                todo = tries.pop()
                last = path[-1] if path else self.before
        self.head = head

    def _emit(self, limit: int) -> list[int]:
        """Cut off the tokens that end at ``limit`` or before."""
        count = end = 0
        for token in self.path:
            if end + self.v.sizes[token] > limit:
                break
            end += self.v.sizes[token]
            count += 1
        if not count:
            return []
        out = self.path[:count]
        del self.path[:count], self.tries[:count]
        self.before, self.data, self.head = out[-1], self.data[end:], self.head - end
        self.dead = {d - end for d in self.dead if d > end}
        return out


class Encoder:
    """Encodes whole texts piece by piece, with caches of bounded size."""

    def __init__(self, v: Vocabulary, cached: int | None = None):
        self.v = v
        self.split = regex.compile(SPLIT)
        self.transducer = Transducer(v)
        self.pretokens = Recent()
        self.spaced = _Segments(self, " ")
        self.plain = _Segments(self, "")
        self.pretokens.most = self.spaced.most = cached
        self.added = regex.compile("|".join(map(regex.escape, sorted(v.added, key=len, reverse=True)))) if v.added else None

    def pretoken(self, piece: str) -> bytes:
        known = self.pretokens.get(piece)
        if known is None:
            known = self.made(piece)
            if len(piece) <= LONG:
                self.pretokens.put(piece, known)
        return known

    def made(self, piece: str) -> bytes:
        """Ids of one pretoken, by the transducer."""
        t, data = self.transducer, piece.encode("utf-8", "surrogatepass")
        if len(data) <= LONG:
            return _packed(t.whole(data))
        known = b"".join(_packed(t.feed(data[at : at + PIECE])) for at in range(0, len(data), PIECE))
        return known + _packed(t.finish())

    def raw(self, piece: str) -> bytes:
        """Ids of ``piece`` as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pretoken, self.split.findall(piece)))

    def chunks(self, text: str) -> Iterator[bytes]:
        """Ids of ``text`` in order, a bounded run of text at a time."""
        if self.added is None or not self.added.search(text):
            yield from self._ordinary(text)
            return
        at = 0
        for m in self.added.finditer(text):
            yield from self._ordinary(text[at : m.start()])
            yield self.v.added[m[0]].to_bytes(4, "little")
            at = m.end()
        yield from self._ordinary(text[at:])

    def _ordinary(self, text: str) -> Iterator[bytes]:
        """A single space between two other characters always begins a pretoken, so text is cut there."""
        if not text:
            return
        parts = text.split(" ")
        for i in range(0, len(parts), CHUNK):
            run = parts[i : i + CHUNK]
            try:
                head = [self.plain[run.pop(0)]] if i == 0 else []
                yield b"".join([*head, *map(self.spaced.__getitem__, run)])
            except _Unclean:
                # The rest holds white space that is not one single space.
                yield from self._joined(parts[i:], first=i == 0)
                return

    def _joined(self, parts: list[str], first: bool) -> Iterator[bytes]:
        segment = [parts[0]] if first else ["", parts[0]]
        clean = _is_clean(parts[0])
        for part in parts[1:]:
            here = _is_clean(part)
            # Cut only where the characters on both sides of the space are no white space.
            if clean[1] and here[0]:
                yield self.raw(" ".join(segment))
                segment = ["", part]
            else:
                segment.append(part)
            clean = here
        yield self.raw(" ".join(segment))


class _Unclean(Exception):
    pass


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _is_clean(part: str) -> tuple[bool, bool]:
    """Whether the part begins, and ends, with something else than white space."""
    if not part:
        return False, False
    return part[0] not in SPACES, part[-1] not in SPACES


class Recent(dict):
    """A cache of two generations: the older one is forgotten when the younger one is full.

    A generation is full when its keys and values, strings or bytes, have ``most``, else ``CACHED_BYTES``.
    """

    older: dict = {}
    held = 0
    most: int | None = None

    def put(self, key, value) -> None:
        if self.held >= (self.most or CACHED_BYTES):
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.held += getsizeof(key) + getsizeof(value) + ENTRY
        self[key] = value

    def get(self, key):
        found = super().get(key)
        if found is None and (found := self.older.get(key)) is not None:
            self.put(key, found)
        return found


class _Segments(Recent):
    """Ids of the text between two spaces, with the space before it."""

    def __init__(self, encoder: Encoder, before: str):
        self.encoder, self.before = encoder, before

    def __missing__(self, part: str) -> bytes:
        found = self.older.get(part)
        if found is None:
            if not part or part[0] in SPACES or part[-1] in SPACES:
                raise _Unclean
            pieces = self.encoder.split.findall(self.before + part)
            # A single pretoken is kept here alone.
            found = self.encoder.made(pieces[0]) if len(pieces) == 1 else b"".join(map(self.encoder.pretoken, pieces))
        if len(part) <= LONG:
            self.put(part, found)
        return found


class Decoder:
    """Ids to text, a piece at a time: a byte string for each id, then UTF-8 with its own carried state."""

    def __init__(self, v: Vocabulary):
        self.table = v.token_bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, raw: bytes) -> str:
        ids = memoryview(raw).cast("I")
        return self.state.decode(b"".join(map(self.table.__getitem__, ids)))

    def text(self, ids: Iterable[int | None]) -> str:
        """Text of whole ids; a byte that is never part of UTF-8 stands for what is no id."""
        table, most = self.table, len(self.table)
        parts = (table[i] if i is not None and 0 <= i < most else b"\xff" for i in ids)
        return self.state.decode(b"".join(parts)) + self.finish()

    def finish(self) -> str:
        out = self.state.decode(b"", True)
        self.state.reset()
        return out


_HELD: dict = {}


def of_worker(owner: str, key, make):
    """What ``make`` gives, kept in this Python worker for later tasks.

    Only one operator's things are kept: they go when another operator asks.
    """
    if _HELD.get("owner") != owner:
        _HELD.clear()
        _HELD["owner"] = owner
    if (owner, key) not in _HELD:
        _HELD[owner, key] = make()
    return _HELD[owner, key]


def encoder_of(v: Vocabulary, cached: int | None = None) -> Encoder:
    """The encoder of this Python worker, so that later tasks find its caches filled."""
    return of_worker("bpe", (v.key, cached), lambda: Encoder(v, cached))


def slices(batch: pa.RecordBatch, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about ``most`` bytes of text at a time; a longer text is alone."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    yield batch.slice(start)


def with_python_rows(df: DataFrame, make, fields: list[T.StructField]) -> DataFrame:
    """``df`` with new columns from ``make() -> function of Arrow batch -> dict of lists or arrays``.

    The factory runs once in each task, so caches live as long as the task. A batch holds
    a bounded run of text.
    """
    schema = T.StructType([*df.schema.fields, *fields])
    names = [f.name for f in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        work = make()
        for whole in batches:
            for batch in slices(whole):
                made = work(batch)
                new = [v if isinstance(v := made[n], pa.Array) else pa.array(v, target.field(n).type) for n in names]
                columns = [a.cast(f.type) if a.type != f.type else a for a, f in zip([*batch.columns, *new], target, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=target.names)

    return df.mapInArrow(run, schema)


def _id_lists(raw: list[bytes]) -> pa.ListArray:
    """Lists of ids from their packed form, without a Python number for each."""
    offsets = np.cumsum([0, *(len(r) // 4 for r in raw)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<i4")))


def _broadcast(df: DataFrame, v: Vocabulary):
    return df.sparkSession.sparkContext.broadcast(v)  # as large as the vocabulary file, whatever the data


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``, the token ids of the whole text, and ``n_tokens``.

    Null and empty texts give an empty list. Repeated rows, other columns and their
    order stay; an existing column of one of the two names is replaced.
    """
    shared = _broadcast(df, vocabulary)

    def make():
        encoder = encoder_of(shared.value)

        def work(batch):
            raw = [b"".join(encoder.chunks(t)) if t else b"" for t in batch.column(text).to_pylist()]
            return {out: _id_lists(raw), "n_tokens": [len(r) // 4 for r in raw]}

        return work

    fields = [T.StructField(out, T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    return with_python_rows(df.drop(*({out, "n_tokens"} - {text})), make, fields)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the text of the ids; a null list gives an empty text.

    A split character, a null in the list, a negative id and one beyond the vocabulary
    give U+FFFD.
    """
    shared = _broadcast(df, vocabulary)

    def make():
        decoder = Decoder(shared.value)

        def work(batch):
            # One list at a time, whatever the others have.
            return {out: [decoder.text(row.as_py() or ()) for row in batch.column(ids)]}

        return work

    return with_python_rows(df.drop(out), make, [T.StructField(out, T.StringType())])


def round_trip(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str | None = None) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and ``round_trip``.

    Ids flow from the encoder to the decoder in bounded runs and are kept only where
    ``ids`` names a column for them. Null counts as empty; rows, their order and other
    columns stay, existing columns of the new names are replaced.
    """
    shared = _broadcast(df, vocabulary)

    def make():
        encoder, decoder = encoder_of(shared.value, ROUND_TRIP_BYTES), Decoder(shared.value)

        def work(batch):
            rows: dict[str, list] = {n: [] for n in ("n_tokens", "ids_sha256", "decoded_sha256", "round_trip")}
            kept: list[bytes] = []
            for t in batch.column(text).to_pylist():
                n, digest, back, own = 0, hashlib.sha256(), hashlib.sha256(), []
                for raw in encoder.chunks(t or ""):
                    n += len(raw) // 4
                    digest.update(raw)
                    if ids:
                        own.append(raw)
                    back.update(decoder.feed(raw).encode())
                back.update(decoder.finish().encode())
                rows["n_tokens"].append(n)
                kept.append(b"".join(own))
                rows["ids_sha256"].append(digest.hexdigest())
                rows["decoded_sha256"].append(back.hexdigest())
                whole = hashlib.sha256((t or "").encode("utf-8", "surrogatepass")).digest()
                rows["round_trip"].append(back.digest() == whole)
            return rows | ({ids: _id_lists(kept)} if ids else {})

        return work

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("round_trip", T.BooleanType()),
        *([T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else []),
    ]
    return with_python_rows(df.drop(*({f.name for f in fields} - {text})), make, fields)
