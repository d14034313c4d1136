"""Words, their 64-bit hashes and word shingles of whole texts, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CACHED_WORDS = 500_000
SHINGLE = 5

# Odd multipliers of the rolling combination of neighbouring word hashes.
_MULTIPLIERS = np.random.default_rng(20_240_501).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and U+0009 to U+000D, as UTF-8.

    ``bytes.split`` cuts at exactly those six characters.
    """
    return text.encode("utf-8", "surrogatepass").split() if text else []


class WordHashes(dict):
    """64-bit hash of each word; forgets everything when it holds too many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer, so that low and high bits are both usable."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in text order."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total += hashes[i : i + count] * _MULTIPLIERS[i]
    return mixed(total)


SLICE = 1 << 20  # bytes of text whose words are hashed at a time
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_SAME >= 65) & (_SAME <= 90), _SAME + 32, _SAME).astype(np.uint8)
_PLACES = np.empty(0, np.uint64)


def _places(count: int) -> np.ndarray:
    """An odd multiplier for each place of a byte in its word."""
    global _PLACES
    if len(_PLACES) < count:
        _PLACES = mixed(mixed(np.arange(1, max(64, 2 * count) + 1, dtype=np.uint64))) | np.uint64(1)
    return _PLACES


def hash_words(words: list[bytes]) -> np.ndarray:
    """The same hashes of words that are given one by one."""
    if not words:
        return np.empty(0, np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    terms = data * _places(int(sizes.max()))[np.arange(len(data)) - np.repeat(first, sizes)]
    return mixed(mixed(np.add.reduceat(terms, first) + sizes.astype(np.uint64)))


def hashed_rows(
    column: pa.Array, lower: bool = False, fold: np.ndarray | None = None
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """64-bit hash of every word of the texts of an Arrow column, some rows at a time.

    Yields the rows, their word hashes one after another and where each row's begin and
    the last one's end. A hash is a sum over the bytes with a multiplier for each place,
    so whole slices are hashed by array arithmetic. Nulls are empty; ``lower`` folds A to Z,
    ``fold`` is another replacement for each byte.
    """
    fold = fold if fold is not None else _LOWER if lower else _SAME
    apart = _SPACE[fold]
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    content = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
        data, cuts = content[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        if not len(data):
            yield slice(row, stop), np.empty(0, np.uint64), np.zeros(stop - row + 1, np.int64)
            row = stop
            continue
        inside = ~apart[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        # A row begins a word of its own, whatever ends the row before.
        edges = cuts[:-1][cuts[:-1] < len(data)]
        begins[edges] = inside[edges]
        starts = np.flatnonzero(begins)
        at = np.flatnonzero(inside)
        first = np.searchsorted(at, starts)
        sizes = np.diff(first, append=len(at))
        place = at - np.repeat(starts, sizes)
        folded = fold[data[at]].astype(np.uint64) + np.uint64(1)
        terms = folded * _places(int(sizes.max(initial=1)))[place]
        hashes = mixed(mixed(np.add.reduceat(terms, first) + sizes.astype(np.uint64))) if len(first) else np.empty(0, np.uint64)
        yield slice(row, stop), hashes, np.searchsorted(starts, cuts)
        row = stop


def shingle_sets(
    column: pa.Array, size: int = SHINGLE, least: int = 0
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Sorted distinct shingles of each text, in lower case; fewer than ``size`` words count as one.

    Texts of fewer than ``least`` words have none.
    """
    for rows, hashes, ends in hashed_rows(column, lower=True):
        yield rows, *sets_of(hashes, ends, size, least)


def sets_of(hashes: np.ndarray, ends: np.ndarray, size: int = SHINGLE, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The sets of texts whose word hashes are given one after another, cut at ``ends``, and the bounds of the sets."""
    counts = np.diff(ends)
    runs = grams(hashes, size) + np.uint64(size - 1) if len(hashes) >= size else np.empty(0, np.uint64)
    parts = []
    for begin, n in zip(ends[:-1].tolist(), counts.tolist(), strict=True):
        if n < least:
            part = runs[:0]
        elif n >= size:
            part = np.sort(runs[begin : begin + n - size + 1])
        else:
            part = grams(hashes[begin : begin + n], n) + np.uint64(n - 1) if n else np.empty(0, np.uint64)
        parts.append(part)
    tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    bounds = np.cumsum([0, *map(len, parts)])
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = tokens[1:] != tokens[:-1]
    fresh[bounds[:-1][bounds[:-1] < len(tokens)]] = True
    return tokens[fresh], np.concatenate([[0], np.cumsum(fresh)])[bounds]
