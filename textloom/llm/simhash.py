"""Near duplicates by SimHash, found at the anchors of a covering code.

Four differing bits leave at most one in one of three parts of a fingerprint. Each part is
covered by a code: Hamming's [15, 11] on fifteen of its bits, so that every value is at
most one bit from a code word (the covering radius), and all values of the bits that remain.
The code words are the anchors. A fingerprint is at home at its nearest anchor and is also
sent to every further one within the radius plus the threshold at which a neighbour can be
at home: 13 or 14 anchors in the mean for each part, whatever the data. Two fingerprints
that differ little enough in a part meet at the home of either, where they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import connected_components
from textloom.llm.forest import joined
from textloom.llm.words import words_of
from textloom.operators.skew import attach_group_values
from textloom.workspace import write_through

SHINGLE = 4
DISTANCE = 4
SEED = 42
PARTS = ((0, 21), (21, 21), (42, 22))  # first bit and width
CODE = 15  # bits of a part that the Hamming code covers
RUN = 1 << 16  # shingles whose hashes are held at a time
CELL = 1 << 14  # rows of an anchor that meet in one task; a larger anchor is cut into pairs of cells
PAIRS = 1 << 20  # comparisons made at a time

_BITS = np.arange(1 << CODE, dtype=np.uint32)
_SYNDROME = np.zeros(1 << CODE, np.uint8)
for _i in range(CODE):
    _SYNDROME ^= ((_BITS >> np.uint32(_i)) & 1).astype(np.uint8) * np.uint8(_i + 1)
# What to flip for the nearest word, and for the seven words at distance two, by the syndrome.
_NEAREST = np.array([0] + [1 << (s - 1) for s in range(1, CODE + 1)], np.uint32)
_SECOND = np.array(
    [[0] * 7] + [[(1 << (a - 1)) | (1 << ((a ^ s) - 1)) for a in range(1, CODE + 1) if a < a ^ s] for s in range(1, CODE + 1)],
    np.uint32,
)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bits set in over half the hashes of the runs of ``size`` words, repeats included; 0 without a word.

    Words are in lower case (A to Z); fewer than ``size`` are one run. A run of hashes of
    bounded length is held at a time.
    """
    words = words_of(text)
    if not words:
        return 0
    data = b" ".join(words).lower()
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(size, len(words))
    total, count, digest = np.zeros(64, np.int64), len(words) - width + 1, xxhash.xxh64_intdigest
    for at in range(0, count, RUN):
        stop = min(at + RUN, count)
        cuts = zip(starts[at:stop].tolist(), ends[at + width - 1 : stop + width - 1].tolist(), strict=True)
        hashes = np.array([digest(data[a:b], SEED) for a, b in cuts], np.uint64)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > count, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``key`` and ``fp``, the fingerprint as a signed integer, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), size) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found.view(np.int64))], names=["key", "fp"])

    return df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(run, "key long, fp long")


def anchors(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Places in ``fps`` and the anchors they are sent to; the last value says whether these are the homes."""
    every = np.arange(len(fps))
    for number, (first, width) in enumerate(PARTS):
        part = ((fps >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.uint32)
        code, rest = part & np.uint32((1 << CODE) - 1), part >> np.uint32(CODE)
        syndrome = _SYNDROME[code]

        def named(word: np.ndarray, rest: np.ndarray) -> np.ndarray:
            return (np.int32(number) << 24) | (rest.astype(np.int32) << CODE) | word.astype(np.int32)

        home = code ^ _NEAREST[syndrome]
        yield every, named(home, rest), True
        off = np.flatnonzero(syndrome)  # a word of the code keeps its home whichever bit changes
        for k in range(_SECOND.shape[1]):
            yield off, named(code[off] ^ _SECOND[syndrome[off], k], rest[off]), False
        for k in range(width - CODE):
            yield every, named(home, rest ^ np.uint32(1 << k)), False


def _large_anchors(classes: DataFrame) -> dict[int, int]:
    """Anchors that get more than ``CELL`` fingerprints, and how many; the code fixes how many there can be."""

    def run(batches):
        for batch in batches:
            sent = np.concatenate([a for _, a, _ in anchors(batch.column("fp").to_numpy().view(np.uint64))])
            at, n = np.unique(sent, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["anchor", "n"])

    sums = classes.select("fp").mapInArrow(run, "anchor int, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return {r.anchor: r.n for r in sums.filter(F.col("n") > CELL).collect()}


_HOME, _BOTH = 2, 1  # rows that are only asked about, and rows that are also answers


def _sent(classes: DataFrame, large: dict[int, int]) -> DataFrame:
    """``anchor, i, j, rep, fp, role``; rows of a large anchor go to all cells of their line and of their column."""
    shared = classes.sparkSession.sparkContext.broadcast({a: -(-n // CELL) for a, n in large.items()})
    names = ["anchor", "i", "j", "rep", "fp", "role"]

    def rows(anchor, i, j, rep, fp, role) -> pa.RecordBatch:
        kinds = (np.int32, np.int32, np.int32, np.int64, np.int64, np.int8)
        return pa.RecordBatch.from_arrays([pa.array(v.astype(k)) for v, k in zip((anchor, i, j, rep, fp, role), kinds, strict=True)], names=names)

    def run(batches):
        cells = shared.value
        hot = np.array(sorted(cells), np.int32)
        width = np.array([cells[a] for a in hot.tolist()], np.int64)
        for batch in batches:
            rep, signed = batch.column("rep").to_numpy(), batch.column("fp").to_numpy()
            for at, anchor, home in anchors(signed.view(np.uint64)):
                place = np.searchsorted(hot, anchor)
                is_hot = np.zeros(len(anchor), bool)
                if len(hot):
                    is_hot = hot[np.minimum(place, len(hot) - 1)] == anchor
                plain, none = at[~is_hot], np.zeros(int((~is_hot).sum()))
                yield rows(anchor[~is_hot], none, none, rep[plain], signed[plain], none + (_BOTH if home else 0))
                for k in np.flatnonzero(is_hot).tolist():
                    w, r, f = int(width[place[k]]), rep[at[k]], signed[at[k]]
                    own = xxhash.xxh3_64_intdigest(f.tobytes()) % w
                    line, same = np.arange(w), np.full(w, own)
                    parts = [(line, same, 0), (same, line, _HOME)][: 1 + home]
                    for i, j, role in parts:
                        yield rows(np.full(w, anchor[k]), i, j, np.full(w, r), np.full(w, f), np.full(w, role))

    return classes.select("rep", "fp").mapInArrow(run, "anchor int, i int, j int, rep long, fp long, role byte")


def _near(cell: np.ndarray, rep: np.ndarray, fp: np.ndarray, role: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what belongs together in each cell, no more than there are rows; rows of a cell stand together."""
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    sizes = np.diff(starts, append=len(cell))
    asked = np.flatnonzero(role > 0)
    group = np.searchsorted(starts, asked, "right") - 1
    first, count = starts[group], sizes[group]
    bits, parent = fp.view(np.uint64), np.arange(len(cell))
    turns = np.cumsum(count) // PAIRS
    for at in np.split(np.arange(len(asked)), np.flatnonzero(np.diff(turns)) + 1):
        if not len(at):
            continue
        n = count[at]
        i = np.repeat(asked[at], n)
        j = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        ok = (np.bitwise_count(bits[i] ^ bits[j]) <= distance) & (role[j] < _HOME) & (i != j)
        parent = joined(parent, i[ok], j[ok])
    moved = np.flatnonzero(parent != np.arange(len(parent)))
    return rep[moved], rep[parent[moved]]


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``a, b`` between the representatives ``rep`` of distinct fingerprints ``fp``.

    They connect what fingerprints at ``distance`` or less connect; an anchor lets out no
    more links than it has rows.
    """
    if distance >= 2 * len(PARTS):
        raise ValueError("a part may differ in one bit only")
    sent = _sent(classes, _large_anchors(classes)).repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")

    def run(batches):
        held: list[tuple] = []

        def finish(parts) -> pa.RecordBatch:
            cell, rep, fp, role = (np.concatenate(c) for c in zip(*parts, strict=True))
            a, b = _near(cell, rep, fp, role, distance)
            return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, i, j, rep, fp, role = (batch.column(c).to_numpy() for c in range(6))
            # An anchor has 26 bits.
            cell = (anchor.astype(np.uint64) << np.uint64(36)) ^ (i.astype(np.uint64) << np.uint64(18)) ^ j.astype(np.uint64)
            cut = len(cell) - int(np.argmax(cell[::-1] != cell[-1])) if (cell != cell[-1]).any() else 0
            if held and (cut or held[-1][0][-1] != cell[0]):
                held.append((cell[:cut], rep[:cut], fp[:cut], role[:cut]))
                yield finish(held)
                held = []
            elif cut:
                yield finish([(cell[:cut], rep[:cut], fp[:cut], role[:cut])])
            held.append((cell[cut:], rep[cut:], fp[cut:], role[cut:]))
        if held:
            yield finish(held)

    return sent.mapInArrow(run, "a long, b long")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row of ``df``.

    Words are runs of other characters than space and U+0009 to U+000D, with A to Z in
    lower case. Fingerprints of ``size`` word runs (see ``fingerprint``) are linked when
    they differ in ``distance`` bits or fewer, equal ones and those of null, empty and
    blank texts, which are zero, included; the component is the smallest key reachable.
    Repeated rows and rows that repeat a key with another text are returned each, the
    latter connect nothing but their own fingerprints. A null key keeps its fingerprint,
    connects nothing and has no component. Other columns are not read; an empty table
    gives an empty result.
    """
    rows = write_through(fingerprints(df, key, text, size), "fingerprints")
    classes = rows.filter("key is not null").groupBy("fp").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = write_through(classes, "fingerprints")
    found = connected_components(links(classes, distance))
    named = classes.join(found, F.col("rep") == F.col("node"), "left")
    named = named.select("fp", "size", F.coalesce("component", "rep").alias("component_id"))
    out = attach_group_values(rows, named, "fp", "size", "key")
    component = F.when(F.col("key").isNotNull(), F.col("component_id")).alias("component_id")
    return out.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component)
