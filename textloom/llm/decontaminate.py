"""Benchmark decontamination: a BM25 index of the test items with block maxima is asked with every passage.

The index is of the benchmark, the queries are all passages of all documents. A passage
is skipped for a whole block of items when the largest scores that its rare words can have
there, and the most that common words add, stay below the threshold; what is left is scored exactly, and an item found is
verified by the overlap of its question and of its answer with the text around.

A passage cannot hold half of an item much longer than itself, so an item of more than
``PART`` words is asked for by overlapping parts too, each scored against itself; it is
verified over its whole length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.words import hash_words, hashed_rows

K1, B = 1.2, 0.75
SCORE = 0.5  # share of the item's score with itself
OVERLAP = 0.6  # share of the word runs of a part
GRAM = 3
STEP = 32  # words from one passage to the next
SPAN = 4  # steps of a passage
PART = STEP * (SPAN - 1)  # words of a part of a long item: a copy lies whole in some passage
ITEM_BLOCK = 4
COMMON = 0.03  # share of the items from which on a word is common
LEADING = 18  # bits of a word hash that find its terms
ITEMS = 20_000  # items of one index; more are asked in turns
ITEM_WORDS = 2_000_000  # words of one index

# Lower-case A to Z; ASCII signs and control characters separate words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)

_FOLDED = np.frombuffer(_FOLD, np.uint8)


def fold(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def question_and_answer(words: list[bytes], text: str) -> int:
    """Number of words of the question: up to the last question mark, else line end, else
    sentence end that leaves words on both sides, else two thirds."""
    for sign in ("?", "\n", ". "):
        at = text.rstrip("?\n. ").rfind(sign)
        if at >= 0:
            n = len(fold(text[: at + 1]))
            if GRAM <= n <= len(words) - GRAM:
                return n
    return max(1, -(-2 * len(words) // 3))


def parts(words: list[bytes]) -> list[list[bytes]]:
    """The item, and if it is longer than ``PART`` words all of it in parts that overlap by half or more."""
    if len(words) <= PART:
        return [words]
    last = len(words) - PART
    return [words, *[words[at : at + PART] for at in (*range(0, last, PART // 2), last)]]


@dataclass
class Index:
    """Inverted index of a bounded number of items, ready to ship.

    What is scored are entries: an item, and the parts of a long one.
    """

    ids: list[int]
    words: list[list[bytes]]
    questions: list[int]
    items: list[int] = field(default_factory=list)  # by entry: its item
    terms: dict[bytes, int] = field(default_factory=dict)
    own: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # by entry: terms, BM25 weight over the entry's own score
    held: np.ndarray | None = None  # terms of the passage that is being scored
    rest: np.ndarray | None = None  # by block of entries: the most that common words add
    rare: np.ndarray | None = None  # where the blocks of a term start; common terms have none
    blocks: np.ndarray | None = None
    peaks: np.ndarray | None = None  # largest weight of the term in the block
    hashes: np.ndarray | None = None  # of the terms, in order
    places: np.ndarray | None = None  # term of each of these hashes
    slots: np.ndarray | None = None  # first of these hashes at or after each leading bits

    @classmethod
    def build(cls, rows: list[tuple[int, str]], frequency: dict[bytes, int], count: int, mean: float) -> Index:
        ids = [i for i, _ in rows]
        words = [fold(t) for _, t in rows]
        index = cls(ids, words, [question_and_answer(w, t) for w, (_, t) in zip(words, rows, strict=True)])
        entries = []
        index.items = [item for item, w in enumerate(words) for _ in parts(w)]
        for entry, w in enumerate(part for w in words for part in parts(w)):
            own: dict[bytes, float] = {}
            for term, tf in Counter(w).items():
                df = frequency[term]
                idf = np.log(1 + (count - df + 0.5) / (df + 0.5))
                own[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
            total = sum(own.values())
            numbers = [index.terms.setdefault(term, len(index.terms)) for term in own]
            shares = [value / total for value in own.values()]
            index.own.append((np.array(numbers, np.int64), np.array(shares)))
            entries += [(t, entry, v) for t, v in zip(numbers, shares, strict=True)]
        entries.sort()
        index.held = np.zeros(len(index.terms), bool)
        index.lookup()
        common = {t for w in index.terms for t in [index.terms[w]] if frequency[w] > max(2, COMMON * count)}
        most = np.zeros(max(len(index.own), 1))
        peaks: dict[tuple[int, int], float] = {}
        for term, entry, value in entries:
            if term in common:
                most[entry] += value
            else:
                at = term, entry // ITEM_BLOCK
                peaks[at] = max(peaks.get(at, 0.0), value)
        index.rest = np.maximum.reduceat(most, np.arange(0, len(most), ITEM_BLOCK))
        index.rare = np.searchsorted([t for t, _ in peaks], np.arange(len(index.terms) + 1))
        index.blocks = np.array([b for _, b in peaks], np.int64)
        index.peaks = np.array(list(peaks.values()))
        return index

    def lookup(self) -> None:
        """Order the terms by hash, with the place where each run of equal leading bits starts."""
        hashes = hash_words(list(self.terms))
        self.places = np.argsort(hashes)
        self.hashes = hashes[self.places]
        self.slots = np.searchsorted(self.hashes >> np.uint64(64 - LEADING), np.arange(1 << LEADING, dtype=np.uint64))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Term of each word hash, or -1."""
        out = np.full(len(hashes), -1)
        at = self.slots[hashes >> np.uint64(64 - LEADING)]
        todo = np.flatnonzero(at < len(self.hashes))
        while len(todo):
            here = self.hashes[at[todo]]
            hit = here == hashes[todo]
            out[todo[hit]] = self.places[at[todo[hit]]]
            # The next hash may be smaller still; a larger one ends the search.
            todo = todo[here < hashes[todo]]
            at[todo] += 1
            todo = todo[at[todo] < len(self.hashes)]
        return out

    def scores(self, terms: np.ndarray, blocks: list[int]) -> Iterator[tuple[int, float]]:
        """Items of ``blocks`` of entries that reach the threshold for a passage with these distinct terms."""
        self.held[terms] = True
        for block in blocks:
            for entry in range(block * ITEM_BLOCK, min((block + 1) * ITEM_BLOCK, len(self.own))):
                own, weights = self.own[entry]
                score = float(weights[self.held[own]].sum())
                if score >= SCORE:
                    yield self.items[entry], score
        self.held[terms] = False


def runs(words: list[bytes], size: int) -> set[bytes]:
    size = max(1, min(size, len(words)))
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def overlap(part: list[bytes], around: set[bytes], size: int) -> float:
    """Share of the distinct word runs of a part that stand in the text."""
    own = runs(part, size) if part else set()
    return len(own & around) / len(own) if own else 0.0


def passages_found(index: Index, texts: pa.Array) -> Iterator[tuple[int, int, float, float, float, int]]:
    """Row, item, score, question and answer overlap and first word of the best passage, for verified items."""
    for rows, hashes, ends in hashed_rows(texts, fold=_FOLDED):
        for row, *found in _slice_found(index, texts, rows.start, hashes, ends):
            yield rows.start + row, *found


def _slice_found(index: Index, texts: pa.Array, offset: int, hashes: np.ndarray, ends: np.ndarray):
    # Words of all rows in steps; a row begins with a step of its own.
    lengths = np.diff(ends)
    steps = -(-lengths // STEP)
    first_step = np.concatenate([[0], np.cumsum(steps)])
    terms = index.find(hashes)
    at = np.flatnonzero(terms >= 0)
    row = np.repeat(np.arange(len(lengths)), lengths)[at]
    at_step = first_step[row] + (at - ends[row]) // STEP
    pair = np.unique(at_step * max(len(index.terms), 1) + terms[at])
    step, term = np.divmod(pair, max(len(index.terms), 1))
    row_of = np.repeat(np.arange(len(lengths)), steps)
    count = int(first_step[-1])
    starts = np.searchsorted(step, np.arange(count + 1))
    # The largest that the rare words of a step can add for each block of items, in order of block and step.
    many = index.rare[term + 1] - index.rare[term]
    each = np.repeat(np.arange(len(term)), many)
    at = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + index.rare[term][each]
    key = index.blocks[at] * max(count, 1) + step[each]
    order = np.argsort(key, kind="stable")
    key, reach = key[order], np.concatenate([[0.0], np.cumsum(index.peaks[at[order]])])
    opening = np.flatnonzero(np.diff(key, prepend=-1))
    block, begin = np.divmod(key[opening], max(count, 1))
    stop = np.minimum(begin + SPAN, first_step[row_of[begin] + 1]) if len(begin) else begin
    bound = reach[np.searchsorted(key, block * max(count, 1) + stop)] - reach[opening] + index.rest[block]
    asked: dict[int, set[int]] = {}
    for i in np.flatnonzero(bound >= SCORE * (1 - 1e-6)):
        # A passage that begins earlier has no more rare words of this block than the one from here.
        for s in range(max(int(first_step[row_of[begin[i]]]), int(begin[i]) - SPAN + 1), int(begin[i]) + 1):
            asked.setdefault(s, set()).add(int(block[i]))
    for b in np.flatnonzero(index.rest >= SCORE * (1 - 1e-6)):  # items of common words alone
        for s in range(count):
            asked.setdefault(s, set()).add(int(b))
    # By row and item: the largest score of each passage that reaches the threshold.
    asked_for: dict[tuple[int, int], dict[int, float]] = {}
    for s in sorted(asked):
        end = min(s + SPAN, first_step[row_of[s] + 1])
        distinct = np.unique(term[starts[s] : starts[end]])
        for item, score in index.scores(distinct, sorted(asked[s])):
            passages = asked_for.setdefault((int(row_of[s]), item), {})
            start = int(s - first_step[row_of[s]]) * STEP
            passages[start] = max(score, passages.get(start, 0.0))
    words = {row: fold(texts[offset + row].as_py()) for row, _ in asked_for}
    for (row, item), passages in asked_for.items():
        found = verified(words[row], index.words[item], index.questions[item], passages)
        if found:
            yield row, item, *found


def verified(words: list[bytes], own: list[bytes], q: int, passages: dict[int, float]) -> tuple[float, float, float, int] | None:
    """Score, overlaps and start of the best passage around which question and answer stand, the first of equals."""
    size = max(1, min(GRAM, q, len(own) - q))
    # The item may begin before or end after a passage.
    low, high = max(0, min(passages) - len(own)), max(passages) + SPAN * STEP + len(own)
    text, wanted = words[low:high], runs(own[:q], size) | runs(own[q:], size)
    grams = [b" ".join(text[i : i + size]) for i in range(len(text) - size + 1)]
    places = [i for i, gram in enumerate(grams) if gram in wanted]
    for start, score in sorted(passages.items(), key=lambda x: (-x[1], x[0])):
        begin = bisect_left(places, start - len(own) - low)
        end = bisect_right(places, start + SPAN * STEP + len(own) - size - low)
        around = {grams[i] for i in places[begin:end]}
        asked, answered = overlap(own[:q], around, size), overlap(own[q:], around, size)
        if asked >= OVERLAP and (answered >= OVERLAP or not own[q:]):
            return score, asked, answered, start
    return None


def contaminated(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row for each document and item it holds: ``key``, ``item_id``, ``score``,
    ``question_overlap``, ``answer_overlap``, ``start`` (word where the best passage begins).

    The score is BM25 of the passage over the item's score with itself; of an item of more
    than ``PART`` words it is the largest of the item and its parts. Null and empty
    texts, and items without a word, give no row; rows that repeat a document repeat its
    findings; equal items are all found; a null key or item id stays null. Other columns
    are not read. With no item or no document the result is empty. Items are collected
    ``ITEMS`` or ``ITEM_WORDS`` words at a time; a larger benchmark is asked in turns.
    """
    found = None
    split = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    for shared in _indexes(benchmark, item, item_text):

        def run(batches, shared=shared):
            index = shared.value
            for batch in _slices(batches):
                keys = batch.column("k")
                got = list(passages_found(index, batch.column("t"))) if index.ids else []
                columns = list(zip(*got, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(columns[0], pa.int64())),
                        pa.array([index.ids[i] for i in columns[1]], pa.int64()),
                        *[pa.array(c, pa.float64()) for c in columns[2:5]],
                        pa.array(columns[5], pa.int64()),
                    ],
                    names=["k", "item_id", "score", "question_overlap", "answer_overlap", "start"],
                )

        kind = split.schema["k"].dataType.simpleString()
        one = split.mapInArrow(
            run, f"k {kind}, item_id long, score double, question_overlap double, answer_overlap double, start long"
        )
        found = one if found is None else found.unionByName(one)
    return found.withColumnRenamed("k", key)


def decontaminated(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``df`` that hold no item, with all their columns; found as by ``contaminated``.

    A row is judged by its own text, so repeated rows and null keys need no care.
    """
    for shared in _indexes(benchmark, item, item_text):

        def run(batches, shared=shared):
            index = shared.value
            for batch in _slices(batches):
                clean = np.ones(batch.num_rows, bool)
                if index.ids:
                    clean[[f[0] for f in passages_found(index, batch.column(text))]] = False
                yield batch.filter(pa.array(clean))

        df = df.mapInArrow(run, df.schema)
    return df


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _indexes(benchmark: DataFrame, item: str, item_text: str) -> Iterator:
    """Broadcast indexes of at most ``ITEMS`` items and about ``ITEM_WORDS`` words; weights are of the whole benchmark."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item).cast("bigint").alias("item"), F.col(item_text).alias("text")).filter("text is not null")
    # A long item has its words once more, and twice in parts that overlap by half.
    chars = F.length("text") * F.when(F.length("text") > 6 * PART, 3).otherwise(1)
    total = items.agg(F.count("text").alias("n"), F.sum(chars).alias("chars")).first()
    turns = max(1, -(-total.n // ITEMS), -(-(total.chars or 0) // (6 * ITEM_WORDS)))
    words = _benchmark_words(items)
    length = words.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("words")).first()
    mean = (length.words or 0) / max(length.n, 1)
    for turn in range(turns):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(turns)) == turn)
        rows = [(r.item, r.text) for r in part.collect() if fold(r.text)]
        counts = words.select(F.explode("words").alias("w")).groupBy("w").count()
        if turns > 1:
            mine = {w for _, t in rows for w in set(fold(t))}
            counts = counts.join(spark.createDataFrame([(bytearray(w),) for w in mine], "w binary"), "w", "left_semi")
        frequency = {bytes(r.w): r["count"] for r in counts.collect()}
        yield spark.sparkContext.broadcast(Index.build(rows, frequency, length.n, mean))


def _benchmark_words(items: DataFrame) -> DataFrame:
    """Distinct words and length of every item with a word, by the same folding as the texts."""

    def run(batches):
        for batch in batches:
            words = [w for w in map(fold, batch.column("text").to_pylist()) if w]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(set(w)) for w in words], pa.list_(pa.binary())), pa.array([len(w) for w in words], pa.int64())],
                names=["words", "length"],
            )

    return items.select("text").mapInArrow(run, "words array<binary>, length long")
