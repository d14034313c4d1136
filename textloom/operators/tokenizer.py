"""Byte-level BPE encoding and decoding of text columns."""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.blocks import append_eos
from textloom.functions.pretokens import (
    has_specials,
    pretokens_with_specials,
    special_pieces,
    with_prefix_space,
)
from textloom.functions.symbols import (
    BYTE_TO_ID,
    BYTES_IN_ID_ORDER,
    FIRST_BYTE_ID,
    FIRST_MERGE_ID,
    PAD_ID,
    SPECIALS,
    byte_ids,
    printable,
)

CACHED_BYTES = 16 << 20  # of a generation of known pretokens
CACHED_LENGTH = 256  # characters of a pretoken that is kept
ENTRY = 190  # bytes that a known pretoken takes besides its letters and ids
SCAN_LENGTH = 32
SLICE = 1 << 19  # list items, and bytes of strings, that are worked on together


def _byte_encode(text: Column) -> Column:
    """Ids under the alphabet alone; each piece between special strings gets its prefix space."""
    ids_of = F.create_map(*[F.lit(x) for pair in SPECIALS.items() for x in pair])
    by_piece = F.transform(
        special_pieces(text),
        lambda p: F.when(p.isin(*SPECIALS), F.array(F.element_at(ids_of, p))).otherwise(
            byte_ids(with_prefix_space(p))
        ),
    )
    return F.when(has_specials(text), F.flatten(by_piece)).otherwise(byte_ids(with_prefix_space(text)))


def merge_ids(ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges to one pretoken, lowest rank first, leftmost first.

    Words are scanned for their best pair again and again; long pretokens use a
    heap over linked neighbours, which keeps them at n log n.
    """
    n = len(ids)
    ids = list(ids)
    while len(ids) <= SCAN_LENGTH:
        best, at = None, 0
        for i, pair in enumerate(zip(ids, ids[1:])):
            hit = ranks.get(pair)
            if hit is not None and (best is None or hit < best):
                best, at = hit, i
        if best is None:
            return ids
        ids[at : at + 2] = [best[1]]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []

    def offer(left: int) -> None:
        right = after[left]
        if right < n and (hit := ranks.get((ids[left], ids[right]))):
            heapq.heappush(heap, (hit[0], left, ids[left], ids[right], hit[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, left, a, b, made = heapq.heappop(heap)
        right = after[left]
        if ids[left] != a or right >= n or ids[right] != b:
            continue
        ids[left], ids[right] = made, -1
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
        if before[left] >= 0:
            offer(before[left])
        offer(left)
    return [x for x in ids if x >= 0]


def row_ends(lists: pa.Array) -> np.ndarray:
    """Items, and bytes of strings, up to the end of each row."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    items = lists.flatten()
    if pa.types.is_list(items.type):
        return np.concatenate([[0], row_ends(items)])[ends]
    if pa.types.is_string(items.type) and len(items):
        offsets = np.frombuffer(items.buffers()[1], np.int32)[items.offset : items.offset + len(items) + 1]
        return ends + (offsets[ends] - offsets[0])
    return ends


def _in_slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The same rows in arrays of at most ``SLICE`` items and bytes, or one row: what is made of one stays small."""
    for batch in batches:
        ends, at = row_ends(batch), 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + SLICE, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def _sizes(encoded: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4


def _bounds(which: np.ndarray, encoded: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Ids up to the end of each row of ``counts`` pieces."""
    ends = np.concatenate([[0], np.cumsum(_sizes(encoded)[which])])
    return ends[np.concatenate([[0], np.cumsum(counts)])]


def placed_ids(which: np.ndarray, encoded: list[bytes], counts: np.ndarray, nulls: pa.Array | None = None) -> pa.ListArray:
    """The ids (int32) of the pieces ``which`` one after another, a list for each row of ``counts`` pieces."""
    sizes = _sizes(encoded)
    row_sizes = sizes[which]
    ends = np.cumsum(row_sizes)
    starts = np.cumsum(sizes) - sizes
    pool = np.frombuffer(b"".join(encoded), np.int32)
    take = np.repeat(starts[which] - (ends - row_sizes), row_sizes) + np.arange(ends[-1] if len(ends) else 0)
    bounds = _bounds(which, encoded, counts)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(pool[take], pa.int32()), mask=nulls)


def _encode_batches(
    batches: Iterator[pa.Array], ranks: dict[tuple[int, int], tuple[int, int]], lengths_only: bool = False
) -> Iterator[pa.Array]:
    """Arrays of pretokens to arrays of ids (or their lengths); each distinct pretoken is merged once."""
    # Ids as int32, which take less room than lists; the older generation goes when the younger one is full.
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}
    held = 0

    def encode_one(piece: str) -> bytes:
        ids = [SPECIALS[piece]] if piece in SPECIALS else merge_ids([BYTE_TO_ID[b] for b in piece.encode()], ranks)
        return array("i", ids).tobytes()

    for batch in batches:
        flat = batch.flatten().dictionary_encode()
        pieces = flat.dictionary.to_pylist()
        encoded = []
        for p in pieces:
            ids = known.get(p)
            if ids is None:
                ids = older.get(p)
                if ids is None:
                    ids = encode_one(p)
                if len(p) <= CACHED_LENGTH:
                    if held > CACHED_BYTES:
                        known, older, held = {}, known, 0
                    known[p] = ids
                    held += ENTRY + len(p) + len(ids)
            encoded.append(ids)
        which = flat.indices.to_numpy()
        counts = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        nulls = batch.is_null()
        if lengths_only:
            bounds = _bounds(which, encoded, counts)
            yield pa.array(np.diff(bounds), pa.int32(), mask=nulls.to_numpy(zero_copy_only=False))
            continue
        yield placed_ids(which, encoded, counts, nulls if batch.null_count else None)


def _decode_batches(batches: Iterator[pa.Array], tokens: list[bytes]) -> Iterator[pa.Array]:
    """Arrays of ids to text; malformed byte sequences become U+FFFD."""
    table = pa.array(tokens, pa.binary())
    for batch in batches:
        parts = table.take(batch.flatten())
        counts = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), parts), b"")
        nulls = batch.is_null().to_pylist()
        text = [None if n else b.decode("utf-8", "replace") for b, n in zip(joined.to_pylist(), nulls, strict=True)]
        yield pa.array(text, pa.string())


@dataclass
class Tokenizer:
    """Merges in rank order as ``(left id, right id)``; holds at most the vocabulary.

    A merge that produces a string already in the vocabulary reuses its id.
    """

    merges: list[tuple[int, int]] = field(default_factory=list)
    pad_id: int | None = None

    def __post_init__(self) -> None:
        self.pad_id = PAD_ID if self.pad_id is None else self.pad_id
        self.tokens = [s.encode() for s in SPECIALS] + [bytes([b]) for b in BYTES_IN_ID_ORDER]
        self.merge_results: list[int] = []
        seen = {t: i for i, t in enumerate(self.tokens) if i >= FIRST_BYTE_ID}
        for left, right in self.merges:
            made = self.tokens[left] + self.tokens[right]
            if made not in seen:
                seen[made] = len(self.tokens)
                self.tokens.append(made)
            self.merge_results.append(seen[made])

    @classmethod
    def from_strings(cls, merges: list[tuple[str, str]]) -> Tokenizer:
        """Build from token texts, for instance ``[(" ", "t"), (" t", "he")]``."""
        tokens: dict[bytes, int] = {bytes([b]): i for b, i in BYTE_TO_ID.items()}
        pairs = []
        for left, right in merges:
            a, b = left.encode(), right.encode()
            pairs.append((tokens[a], tokens[b]))
            tokens.setdefault(a + b, FIRST_BYTE_ID + len(tokens))
        return cls(pairs)

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)

    def _ranks(self) -> dict[tuple[int, int], tuple[int, int]]:
        # A repeated pair keeps its first rank.
        ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (pair, made) in enumerate(zip(self.merges, self.merge_results, strict=True)):
            ranks.setdefault(pair, (rank, made))
        return ranks

    def _merge_udf(self, pieces: Column, lengths_only: bool = False) -> Column:
        ranks = SparkSession.active().sparkContext.broadcast(self._ranks())

        @F.arrow_udf(T.IntegerType() if lengths_only else T.ArrayType(T.IntegerType()))
        def encode_pretokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return _encode_batches(_in_slices(batches), ranks.value, lengths_only)

        return (encode_pretokens.asNondeterministic() if lengths_only else encode_pretokens)(pieces)

    def length(self, text: str | Column) -> Column:
        """Number of tokens of ``text``; the ids themselves stay in the Python worker.

        Marked as not repeatable so that a filter on the result is not pushed
        below it, which would encode every text twice.
        """
        col = F.col(text) if isinstance(text, str) else text
        if self.merges:
            return self._merge_udf(pretokens_with_specials(col), lengths_only=True)
        return F.size(_byte_encode(col))

    def encode_piece(self, pretoken: str | Column) -> Column:
        """Ids of one pretoken, taken as it is."""
        col = F.col(pretoken) if isinstance(pretoken, str) else pretoken
        return self._merge_udf(F.array(col))

    def encode(self, text: str | Column, eos: bool = False) -> Column:
        """Token ids of ``text``; with ``eos`` the end id is appended.

        Special strings inside the text become special ids. Without merges the
        ids are the bytes, so no Python worker is used.
        """
        col = F.col(text) if isinstance(text, str) else text
        if self.merges:
            ids = self._merge_udf(pretokens_with_specials(col))
        else:
            ids = _byte_encode(col)
        return append_eos(ids) if eos else ids

    def encode_each(self, texts: list[Column]) -> Column:
        """Array with the ids of each text, all encoded in one Python evaluation."""
        if not self.merges:
            return F.array(*[_byte_encode(t) for t in texts])
        ranks = SparkSession.active().sparkContext.broadcast(self._ranks())

        @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
        def encode_lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            counts: list[np.ndarray] = []

            def inner() -> Iterator[pa.Array]:
                for batch in _in_slices(batches):
                    counts.append(batch.value_lengths().to_numpy(zero_copy_only=False))
                    yield batch.flatten()

            for ids in _encode_batches(inner(), ranks.value):
                ends = np.cumsum(np.concatenate([[0], counts.pop(0)])).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(ends), ids)

        return encode_lists(F.array(*[pretokens_with_specials(t) for t in texts]))

    def decode(self, ids: str | Column, skip_specials: bool = True) -> Column:
        col = F.col(ids) if isinstance(ids, str) else ids
        tokens = [b"" if skip_specials and i < FIRST_BYTE_ID else t for i, t in enumerate(self.tokens)]
        table = SparkSession.active().sparkContext.broadcast(tokens)

        @F.arrow_udf(T.StringType())
        def decode_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return _decode_batches(_in_slices(batches), table.value)

        return decode_ids(col)

    def check_pad(self) -> None:
        if not 0 <= self.pad_id < self.vocab_size:
            raise ValueError(f"pad id {self.pad_id} is outside the vocabulary of {self.vocab_size}")

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        """``token_id, token, kind``; the token in its printable form."""
        def kind(i: int) -> str:
            return "special" if i < FIRST_BYTE_ID else "byte" if i < FIRST_MERGE_ID else "merge"

        names = list(SPECIALS) + [printable(t) for t in self.tokens[FIRST_BYTE_ID:]]
        rows = [(i, t, kind(i)) for i, t in enumerate(names)]
        return spark.createDataFrame(rows, "token_id int, token string, kind string")

    def merges_table(self, spark: SparkSession) -> DataFrame:
        """``rank, left, right, token_id``; ``left`` and ``right`` in printable form."""
        rows = [
            (r, printable(self.tokens[a]), printable(self.tokens[b]), made)
            for r, ((a, b), made) in enumerate(zip(self.merges, self.merge_results, strict=True))
        ]
        return spark.createDataFrame(rows, "rank int, left string, right string, token_id int")

    def save(self, spark: SparkSession, path: str) -> None:
        self.vocab_table(spark).coalesce(1).write.parquet(f"{path}/vocab")
        self.merges_table(spark).coalesce(1).write.parquet(f"{path}/merges")
        spark.createDataFrame([(self.pad_id,)], "pad_id int").coalesce(1).write.parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str, pad_id: int | None = None) -> Tokenizer:
        """Read saved tables; ``pad_id`` replaces the saved one."""
        ids = {r.token: r.token_id for r in spark.read.parquet(f"{path}/vocab").collect() if r.kind != "special"}
        merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        if pad_id is None:
            pad_id = spark.read.parquet(f"{path}/settings").first().pad_id
        return cls([(ids[m.left], ids[m.right]) for m in merges], pad_id)


BYTE_TOKENIZER = Tokenizer()
