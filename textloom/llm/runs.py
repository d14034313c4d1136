"""Runs of repeating words in a text, found by catching squares over power-of-two blocks.

A run with period ``p`` repeats its first ``p`` words several times. The catcher of level
``j`` watches every completed block of ``2 ** j`` words for the same words at a distance
from ``2 ** (j + 1)`` to below ``2 ** (j + 2)``, which is where the next two pairs of blocks
are: whatever is appended is compared with the heads of two earlier blocks only. A run
of three periods and more holds a whole block together with its copies in the periods that
follow, so each run is caught on the level of its period. What is caught is extended to
both sides word by word, and squares of one period that touch merge into their run.

All words of some texts are advanced together as arrays, level after level; a level costs
a few array operations, and only texts long enough for its periods take part in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom.llm.words import hashed_rows, mixed

MIN_LENGTH = 6
MIN_EXPONENT = 4
CELLS = 1 << 20  # comparisons made at a time when runs are extended

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])

Caught = tuple[np.ndarray, np.ndarray, np.ndarray]  # begin, end (exclusive) and period


def _agreeing(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, in steps of ``step``, equal the word one period later."""
    total = np.zeros(len(at), np.int64)
    active, width, last = np.arange(len(at)), 64, len(words) - 1
    while len(active):
        going, rows = np.empty(len(active), bool), max(1, CELLS // width)
        for lo in range(0, len(active), rows):
            part = active[lo : lo + rows]
            i = at[part, None] + step * (total[part, None] + np.arange(width))
            k = i + period[part, None]
            apart = (i < 0) | (k > last)
            apart |= words[np.clip(i, 0, last)] != words[np.clip(k, 0, last)]
            hit = apart.any(1)
            total[part] += np.where(hit, apart.argmax(1), width)
            going[lo : lo + rows] = ~hit
        active, width = active[going], min(2 * width, CELLS)
    return total


def _short(words: np.ndarray, period: int, least: int) -> Caught:
    """Maximal stretches of one, two or three words repeating, by comparing every word."""
    same = np.zeros(len(words) - period + 2, np.int8)
    same[1:-1] = words[:-period] == words[period:]
    turn = np.diff(same)
    begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1) + period
    primitive = words[begin] != words[begin + 1] if period > 1 else np.ones(len(begin), bool)
    if period == 3:
        primitive |= words[begin + 1] != words[begin + 2]
    keep = (end - begin >= least) & primitive
    return begin[keep], end[keep], np.full(int(keep.sum()), period)


def _candidates(words: np.ndarray, heads: np.ndarray, block: int, copies: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks that stand again one, two, ... ``copies`` periods later, and the period; ``heads`` hashes ``block`` words from each place."""
    whole = -(-len(heads) // block) * block
    grid = np.zeros(whole, np.uint64)
    grid[: len(heads)] = heads
    grid = grid.reshape(-1, block)
    begins, periods = [], []
    for back in (2, 3):
        if len(grid) <= back:
            continue
        at = np.flatnonzero(grid[back:] == grid[:-back, :1])
        begin = at // block * block
        begins.append(begin)
        periods.append(at - begin + back * block)
    if not begins:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin, period = np.concatenate(begins), np.concatenate(periods)
    for c in range(1, copies + 1):
        inside = begin + c * period < len(heads)
        begin, period = begin[inside], period[inside]
        equal = heads[begin] == heads[begin + c * period]
        begin, period = begin[equal], period[equal]
    return begin, period


def _merged(words: np.ndarray, begin: np.ndarray, period: np.ndarray, copies: int) -> Iterator[Caught]:
    """Stretches that hold a candidate with all its copies; those of one period in one stretch count once."""
    order = np.lexsort((begin, period))
    begin, period = begin[order], period[order]
    while len(begin):
        first = np.ones(len(begin), bool)
        first[1:] = (period[1:] != period[:-1]) | (np.diff(begin) > period[1:])
        seeds, p = begin[first], period[first]
        end = seeds + _agreeing(words, seeds, p, 1) + p
        start = seeds - _agreeing(words, seeds - 1, p, -1)
        holds = seeds + copies * p < end
        yield start[holds], end[holds], p[holds]
        covered = begin + period < end[np.cumsum(first) - 1]
        begin, period = begin[~covered & ~first], period[~covered & ~first]


def caught(words: np.ndarray, counts: np.ndarray, min_length: int, min_exponent: int) -> Iterator[Caught]:
    """All runs in ``words``: texts one after another, longest first, each followed by a word found nowhere else.

    ``counts`` has the words of each text without that last one.
    """
    ends = np.cumsum(counts + 1)

    def part(least: int) -> int:
        """Length of the beginning that holds the texts of at least so many words."""
        n = int(np.searchsorted(-counts, -least, "right"))
        return int(ends[n - 1]) if n else 0

    reach = np.zeros(len(words), np.int64)  # end of the runs of shorter periods that hold a word

    def noted(begin: np.ndarray, end: np.ndarray) -> None:
        for s, e in zip(begin.tolist(), end.tolist(), strict=True):
            np.maximum(reach[s:e], e, out=reach[s:e])

    for p in (1, 2, 3):
        least = max(min_length, min_exponent * p)
        size = part(least)
        if size:
            found = _short(words[:size], p, least)
            noted(found[0], found[1])
            yield found
    heads, block = words, 1
    while True:
        size = part(max(min_length, 4 * block * min_exponent))
        if not size:
            return
        # Twice as many words in each hash: those of a place and of the place a block later.
        places = size - 2 * block + 1
        heads = heads[:places] * np.uint64(0x9E3779B97F4A7C15 + 2 * block) + heads[block : block + places]
        block *= 2
        begin, period = _candidates(words, heads, block, min_exponent - 1)
        # Copies in another text do not count, and inside a run of a shorter period this one is no smallest period.
        last = begin + (min_exponent - 1) * period
        fresh = (reach[begin] < last) & (last + block < ends[np.searchsorted(ends, begin, "right")])
        now = list(_merged(words, begin[fresh], period[fresh], min_exponent - 1))
        for start, end, p in now:
            keep = end - start >= np.maximum(min_length, min_exponent * p)
            noted(start[keep], end[keep])
            yield start[keep], end[keep], p[keep]


def runs_of(
    hashes: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> np.ndarray:
    """Rows ``text, start, length, period`` in this order; ``bounds`` cuts the words into texts."""
    if min_exponent < 3:
        raise ValueError("runs are caught from three periods on")
    counts = np.diff(bounds)
    able = np.flatnonzero(counts >= max(min_length, min_exponent))
    if not len(able):
        return np.empty((0, 4), np.int64)
    able = able[np.argsort(-counts[able], kind="stable")]
    sizes = counts[able]
    firsts = np.cumsum(sizes + 1) - (sizes + 1)
    words = np.empty(int((sizes + 1).sum()), np.uint64)
    apart = firsts + sizes
    rest = np.ones(len(words), bool)
    rest[apart] = False
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    words[rest] = hashes[np.repeat(bounds[able], sizes) + inner]
    words[apart] = mixed(np.arange(1, len(able) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    found = [np.stack(x, axis=1) for x in caught(words, sizes, min_length, min_exponent) if len(x[0])]
    if not found:
        return np.empty((0, 4), np.int64)
    start, end, period = np.unique(np.concatenate(found), axis=0).T
    row = np.searchsorted(firsts, start, "right") - 1
    out = np.stack([able[row], start - firsts[row], end - start, period], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those behind the first period of a run."""
    if not len(runs):
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs[:, 1:].tolist():
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


def periodic_runs(
    df: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """Add ``runs``, an array of ``start, length, period`` in words, and ``collapsed``, the text with each run once.

    Words are what stands between white space (space and U+0009 to U+000D). A run is a
    stretch of words with smallest period ``period`` that no neighbouring word extends,
    of at least ``min_length`` words and ``min_exponent`` (3 or more) periods; runs are
    ordered by start, then period, and may overlap. ``collapsed`` joins by one space the
    words that no run contains behind its first period. Null, empty and blank texts have
    no runs and an empty collapsed text. Rows are judged one by one: repeated rows stay,
    other columns pass through, and an existing column of one of the two names is
    replaced. An empty table gives an empty result. Words are compared by 64-bit hashes.
    """
    others = [f for f in df.schema.fields if f.name not in ("runs", "collapsed")]
    schema = T.StructType([*others, T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    at = df.columns.index(text)
    keep = [i for i, f in enumerate(df.schema.fields) if f.name not in ("runs", "collapsed")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            texts = batch.column(at).cast(pa.large_binary())
            for rows, hashes, bounds in hashed_rows(batch.column(at)):
                count = rows.stop - rows.start
                found = runs_of(hashes, bounds, min_length, min_exponent)
                cuts = np.searchsorted(found[:, 0], np.arange(count + 1))
                lists = pa.ListArray.from_arrays(
                    pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(found[:, i]) for i in (1, 2, 3)], names=RUN.names)
                )
                short = [
                    _collapsed((t.as_py() or b"").split(), found[cuts[i] : cuts[i + 1]])
                    for i, t in enumerate(texts.slice(rows.start, count))
                ]
                columns = [batch.column(i).slice(rows.start, count) for i in keep]
                arrays = [*columns, lists, pa.array(short, pa.binary())]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, target, strict=True)], schema=target)

    return df.mapInArrow(run, schema)
