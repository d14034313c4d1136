"""Pretoken counts and merge learning as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.pretokens import pretokens
from textloom.functions.symbols import (
    FIRST_BYTE_ID,
    byte_symbols,
    id_to_symbol,
    symbol_to_id,
)
from textloom.operators.tokenizer import BYTE_TOKENIZER, Tokenizer
from textloom.workspace import cut_lineage

VOCAB_SIZE = 32_000
POOL_SIZE = 20_000
ROUNDS_PER_CUT = 8  # the plan of a round grows with the rounds since the last cut
WORD_LIMIT = 100_000  # parts of words that a round brings to the driver at most
MEAN_LENGTH = 64  # symbols that these have on average at most
FIRST_PAIRS = 16  # leading pairs of the first round
GATHERED = 1 << 21  # bytes of words that a task works on at once
HELD_ROWS = 1 << 20  # sums that a task holds before it lets them out


def count_pretokens(lines: DataFrame, text: str = "text") -> DataFrame:
    """``pretoken, n`` over all rows; partial counts are combined before the shuffle."""
    # The outer form keeps the optimizer from running the split twice, once to
    # test for empty arrays; the null row of an empty text is dropped at the end.
    return (
        lines.select(F.explode_outer(pretokens(text)).alias("pretoken"))
        .groupBy("pretoken")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("pretoken").isNotNull())
    )


def _rank(item: tuple[str, int]) -> tuple[int, str]:
    """Most frequent first; ties go to the smaller left id, then right id."""
    return -item[1], item[0]


class _Symbols:
    """The vocabulary as it grows: tokens by id, ids by token, and the merges in order."""

    def __init__(self):
        self.tokens = list(BYTE_TOKENIZER.tokens)
        self.made = {t: i for i, t in enumerate(self.tokens) if i >= FIRST_BYTE_ID}
        self.merges: list[tuple[int, int]] = []

    def merge(self, pair: str) -> tuple[str, bool]:
        """Record a merge; the symbol it gives, and whether that is a new one."""
        left, right = map(symbol_to_id, pair)
        result = self.tokens[left] + self.tokens[right]
        fresh = result not in self.made
        if fresh:
            self.made[result] = len(self.tokens)
            self.tokens.append(result)
        self.merges.append((left, right))
        return id_to_symbol(self.made[result]), fresh


def learn_merges(
    counts: DataFrame, vocab_size: int = VOCAB_SIZE, pool_size: int = POOL_SIZE, word_limit: int = WORD_LIMIT
) -> Tokenizer:
    """Learn byte-pair merges from ``pretoken, n`` until the vocabulary is full.

    The words stay distributed as symbol strings. A round counts all pairs, takes leading
    ones, and cuts each word where two symbols are not one of these pairs. What stays
    together is a run; equal runs of all words are added up, and at most ``word_limit`` of
    them come to the driver. A pair over a cut can only get rarer, so while the best pair
    ranks before the first one not taken, the runs have all that is needed: the driver
    merges one pair after the other, and the new forms of the runs go back to the words.
    A single pair has few runs, whatever the words; more pairs are taken from round to
    round as their runs allow. Stops early when no pair is left.
    """
    # An explicit partition count keeps the table spread out although it is small;
    # the rounds are short, so one partition per task slot is enough.
    spark = counts.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = min(most, spark.sparkContext.defaultParallelism)
    words = _cut(counts.select(byte_symbols("pretoken").alias("w"), "n").repartition(slots, "w"))
    former: DataFrame | None = None
    symbols = _Symbols()
    take = FIRST_PAIRS
    rounds = 0
    while len(symbols.tokens) < vocab_size:
        ranked = _leading_pairs(words, pool_size)
        if former is not None:
            former.unpersist()
            former = None
        if not ranked:
            break
        take = min(take, len(ranked))
        while (found := _runs_of(words, [p for p, _ in ranked[:take]], word_limit)) is None:
            take //= 2
        # Without a pool of full size every pair that there is has been listed.
        rest = ranked[take:] or ranked[pool_size - 1 :]
        after = _rank(rest[0]) if rest else None
        changed, repeated = _merge_held(found, {p for p, _ in ranked[:take]}, after, dict(ranked), symbols, vocab_size)
        if len(symbols.tokens) >= vocab_size:
            break
        former, words = words, _replaced(words, changed).persist()
        if not repeated:
            take = max(1, int(take * min(4.0, 0.8 * (word_limit / found.num_rows) ** 0.5)))
        rounds += 1
        if rounds % ROUNDS_PER_CUT == 0:
            cut = _cut(words)
            former.unpersist()
            former, words = words, cut
    words.unpersist()
    return Tokenizer(symbols.merges)


def _adjacent(word: str) -> list[str]:
    return [word[i : i + 2] for i in range(len(word) - 1)]


def _difference(old: str, new: str, pair: str) -> tuple[list[str], list[str]]:
    """Adjacent pairs of a word before and after the merge of ``pair``; a single merge changes only those around it."""
    if len(old) - len(new) > 1:
        return _adjacent(old), _adjacent(new)
    at = old.find(pair)
    start = max(at - 1, 0)
    return _adjacent(old[start : at + 3]), _adjacent(new[start : at + 2])


def _merge_held(
    found: pa.Table, held: set[str], after: tuple[int, str] | None, pool: dict[str, int], symbols: _Symbols, vocab_size: int
) -> tuple[dict[str, str], bool]:
    """Merge one pair after the other while the best one stands in ``found`` alone.

    ``found`` has all runs of the ``held`` pairs, ``pool`` their counts; other pairs rank
    ``after`` or behind. Pairs wait in a queue with the count they had when they were put
    there, and go back with the present one when their turn comes. A merge that gives an
    existing symbol is the last one: its pairs may gain elsewhere too. Only if nothing is
    left out, the runs being whole words, merges go on behind it.
    Returns the changed runs, old form to new one, and whether such a merge ended the round.
    """
    words, n = found.column("w").to_pylist(), found.column("n").to_pylist()
    first = list(words)
    where: dict[str, set[int]] = {}  # runs that hold a pair
    for i, w in enumerate(words):
        for p in _adjacent(w):
            where.setdefault(p, set()).add(i)
    counts = {p: pool[p] for p in held}
    queue = [(-c, p) for p, c in counts.items()]
    heapify(queue)
    repeated = False
    while queue and not repeated and len(symbols.tokens) < vocab_size:
        least, pair = heappop(queue)
        count = counts.get(pair, 0)
        if count <= 0:
            continue
        if -least != count:
            heappush(queue, (-count, pair))
            continue
        if after is not None and (-count, pair) > after:
            break
        symbol, fresh = symbols.merge(pair)
        repeated = not fresh and after is not None
        touched = set()
        for i in where.pop(pair, ()):
            old = words[i]
            w = words[i] = old.replace(pair, symbol)
            if w == old:
                continue
            gone, come = _difference(old, w, pair)
            for q in gone:
                counts[q] -= n[i]
            for q in come:
                counts[q] = counts.get(q, 0) + n[i]
                touched.add(q)
                where.setdefault(q, set()).add(i)
        counts.pop(pair, None)
        for q in touched:
            if counts.get(q, 0) > 0:
                heappush(queue, (-counts[q], q))
    return {a: b for a, b in zip(first, words, strict=True) if a != b}, repeated


def _cut(words: DataFrame) -> DataFrame:
    """Checkpoint the words, without those that are one symbol and can never merge again.

    The result is kept in executor memory; a lost part is read again from the
    checkpoint and goes through the rounds since then.
    """
    return cut_lineage(words.filter(F.length("w") > 1)).persist()


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of several batches at once, so that what is done once for each is little."""
    kept, size = [], 0
    for batch in batches:
        if batch.num_rows:
            kept.append(batch)
            size += batch.nbytes
        if size >= GATHERED:
            yield pa.Table.from_batches(kept).combine_chunks()
            kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _read(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words, one after the other, and how many each word has."""
    words = column.cast(pa.large_binary()).combine_chunks()
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # symbols before each byte
    symbols = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    return symbols, np.diff(begins[at - at[0]])


def _written(symbols: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Words of the given lengths from their symbols."""
    width = 1 + (symbols >= 0x80) + (symbols >= 0x800) + (symbols >= 0x10000)  # bytes in UTF-8
    ends = np.concatenate([[0], np.cumsum(width)])
    offsets = ends[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int64)
    data = symbols.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    words = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))
    return words.cast(pa.string())


def _codes(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each symbol and the next one of its word as one number, in the order of pairs; -1 for a word's last symbol."""
    codes = np.full(len(symbols), -1, np.int64)
    codes[:-1] = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
    codes[np.cumsum(lengths)[lengths > 0] - 1] = -1
    return codes


def _code(pair: str) -> int:
    return ord(pair[0]) << 32 | ord(pair[1])


def _runs(symbols: np.ndarray, lengths: np.ndarray, held: np.ndarray):
    """Longest runs of symbols of a word in which all pairs are ``held``: where they begin, their lengths, and the runs."""
    codes = _codes(symbols, lengths)
    at = np.searchsorted(held, codes)
    at[at == len(held)] = 0
    joined = held[at] == codes
    before = np.concatenate([[False], joined[:-1]])
    starts = np.flatnonzero(joined & ~before)
    sizes = np.flatnonzero(before & ~joined) + 1 - starts
    return starts, sizes, _written(symbols[joined | before], sizes)


def _sums(parts: Iterable[pa.Table], limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """``n`` added up for each key of the first column; a key may come again when many are held.

    With more than ``limit`` keys the rest is left out.
    """

    def added(tables: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(tables)
        key = table.column_names[0]
        return table.group_by(key, use_threads=False).aggregate([("n", "sum")]).rename_columns([key, "n"])

    held, rows = [], 0
    for part in parts:
        held.append(added([part]))
        rows += held[-1].num_rows
        if rows > HELD_ROWS or (limit is not None and rows > limit):
            held = [added(held)]
            rows = held[0].num_rows
            if limit is not None and rows > limit:
                break
            if rows > HELD_ROWS // 2:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from added(held).to_batches()


def _leading_pairs(words: DataFrame, size: int) -> list[tuple[str, int]]:
    """The ``size`` best pairs of all words with their counts, best first."""

    def run(batches):
        yield from _sums(pairs(_gathered(batches)))

    def pairs(tables):
        for table in tables:
            symbols, lengths = _read(table.column("w"))
            codes = _codes(symbols, lengths)
            inside = codes >= 0
            n = np.repeat(table.column("n").to_numpy(), lengths)[inside]
            yield pa.table({"pair": codes[inside], "n": n})

    sums = words.select("w", "n").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    top = sums.filter(F.col("n") > 0).orderBy(F.desc("n"), F.asc("pair")).limit(size).collect()
    return [(chr(r.pair >> 32) + chr(r.pair & 0xFFFFFFFF), r.n) for r in top]


def _runs_of(words: DataFrame, pairs: list[str], limit: int) -> pa.Table | None:
    """``w, n``: all runs of some pairs with the times they occur; None if more than one pair has too many."""
    held = words.sparkSession.sparkContext.broadcast(np.sort(np.array([_code(p) for p in pairs], np.int64)))
    at_most = limit if len(pairs) > 1 else None

    def run(batches):
        yield from _sums(runs(_gathered(batches)), at_most)

    def runs(tables):
        for table in tables:
            symbols, lengths = _read(table.column("w"))
            starts, _, found = _runs(symbols, lengths, held.value)
            n = np.repeat(table.column("n").to_numpy(), lengths)[starts]
            yield pa.table({"w": found, "n": n})

    found = words.select("w", "n").mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).persist()
    try:
        size = found.agg(F.count(F.lit(1)).alias("runs"), F.sum(F.length("w")).alias("symbols")).first()
        if at_most is not None and (size.runs > limit or size.symbols > MEAN_LENGTH * limit):
            return None
        return found.toArrow()
    finally:
        found.unpersist()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of some ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _replaced(words: DataFrame, changed: dict[str, str]) -> DataFrame:
    """The table with new forms of some runs, without words that have become one symbol.

    The pairs of the changed runs cut the words as all pairs taken did: what changed in one
    run has changed in every run that holds it, so no part of an unchanged run is listed.
    """
    held = np.array(sorted({_code(p) for w in changed for p in _adjacent(w)}), np.int64)
    shared = words.sparkSession.sparkContext.broadcast((held, list(changed), list(changed.values())))

    def run(batches):
        held, old, new = shared.value
        old, new = pa.array(old, pa.string()), pa.chunked_array([pa.array(new, pa.string())])
        forms, widths = _read(new)
        first = np.cumsum(widths) - widths
        for table in _gathered(batches):
            symbols, lengths = _read(table.column("w"))
            starts, sizes, found = _runs(symbols, lengths, held)
            which = pc.fill_null(pc.index_in(found, value_set=old), -1).to_numpy(zero_copy_only=False)
            hit = which >= 0
            starts, sizes, which = starts[hit], sizes[hit], which[hit]
            put = widths[which]
            symbols, kept = symbols.copy(), np.ones(len(symbols), np.bool_)
            symbols[_ranges(starts, put)] = forms[_ranges(first[which], put)]
            kept[_ranges(starts + put, sizes - put)] = False
            ends = np.cumsum(lengths)
            left = np.concatenate([[0], np.cumsum(kept)])
            lengths = left[ends] - left[ends - lengths]
            more = lengths > 1
            kept &= np.repeat(more, np.diff(ends, prepend=0))
            table = table.filter(pa.array(more))
            forms_left = _written(symbols[kept], lengths[more])
            yield from table.set_column(table.column_names.index("w"), "w", forms_left).to_batches()

    return words.mapInArrow(run, words.schema)


def vocabulary(tokenizer: Tokenizer, spark: SparkSession) -> DataFrame:
    """Specials, then the 256 bytes, then merge results, each with its id."""
    return tokenizer.vocab_table(spark)
