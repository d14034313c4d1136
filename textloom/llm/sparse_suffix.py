"""Repeated passages by a sparse suffix array.

Suffixes are kept only where content selects them: at the words whose following words
hash lowest in a window, so equal passages keep the same suffixes wherever they stand.
Of the kept suffixes, those whose first words stand in another document too are put in
one order over the whole corpus; neighbours are compared and extended right and left.

Documents that share a run of 50 words are linked: neighbours with each other where they
chain a whole group of equal first words, else each document with the smallest that has
the run. The components of these links are those of all shared passages.

A passage of 50 equal words keeps a suffix at one of its first 16 words, so the 35 words
from there are equal, and 15 words to each side are enough to decide it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import connected_components
from textloom.llm.words import grams, hashed_rows, mixed
from textloom.workspace import write_through

LEAST = 50  # words of a passage that counts
WINDOW = 16  # of so many neighbouring suffixes one is kept
SEED = 16  # words whose hash selects suffixes
AHEAD = LEAST - WINDOW + 1  # words that must be equal from a kept suffix on
SIDE = WINDOW - 1  # words of context to each side of them
FILTER_BITS = 27
MATCH, ASKED, SHARED, LINK = range(4)  # kinds of rows that a comparison gives


def anchors(hashes: np.ndarray) -> np.ndarray:
    """Kept positions: of every ``WINDOW`` neighbouring seeds the lowest, the rightmost of equals."""
    runs = grams(hashes, SEED)
    if len(hashes) < LEAST:
        return np.empty(0, np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(runs, WINDOW)
    lowest = WINDOW - 1 - np.argmin(rows[:, ::-1], axis=1)
    at = np.unique(np.arange(len(rows)) + lowest)
    return at[at + AHEAD <= len(hashes)]


def _of_batches(batches):
    for batch in batches:
        keys = batch.column("key").to_pylist()
        for rows, hashes, ends in hashed_rows(batch.column("text")):
            for key, begin, end in zip(keys[rows], ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                h = hashes[begin:end]
                at = anchors(h)
                if len(at):
                    yield key, h, at, grams(h, AHEAD)[at].view(np.int64)


def _spot(head: np.ndarray, bits: int) -> np.ndarray:
    return (head.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _shared_heads(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Bitmap of the first words that stand in at least two documents; of bounded size."""

    def run(batches):
        keys, heads, held = [], [], 0
        for key, _, _, head in _of_batches(batches):
            head = np.unique(head)
            keys.append(np.full(len(head), key, np.int64))
            heads.append(head)
            held += len(head)
            if held > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(heads)), pa.array(np.concatenate(keys))], names=["head", "key"])
                keys, heads, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(heads)), pa.array(np.concatenate(keys))], names=["head", "key"])

    found = docs.mapInArrow(run, "head long, key long").groupBy("head").agg(F.min("key").alias("x"), F.max("key").alias("y"))
    found = write_through(found.filter("x != y").select("head"), "heads")
    bits = min(FILTER_BITS, max(16, (16 * found.count()).bit_length()))
    place = F.shiftrightunsigned("head", 64 - bits)
    words = (
        found.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(head, {64 - bits}) & 63 as int))").alias("m"))
        .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    )  # at most 2 ** (FILTER_BITS - 6) rows
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words["w"].to_numpy()] = words["m"].to_numpy()
    return table, bits


def _suffixes(docs: DataFrame, table: np.ndarray, bits: int) -> DataFrame:
    """Kept suffixes whose first words the bitmap knows, with their context nearest word first.

    A word of context is its hash with 32 bits, never 0; 0 is beyond the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        made = [[], [], [], [], []]
        held = 0

        def batch_of():
            head, key, at, ahead, behind = (np.concatenate(m) for m in made)
            binary = [pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * SIDE), len(head), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary()) for x in (ahead, behind)]
            return pa.RecordBatch.from_arrays([pa.array(head), pa.array(key), pa.array(at), *binary], names=["head", "key", "at", "ahead", "behind"])

        for key, h, at, head in _of_batches(batches):
            spot = _spot(head, bits)
            inside = (shared.value[spot >> 6] >> (spot & 63)) & 1 == 1
            if not inside.any():
                continue
            at, head = at[inside], head[inside]
            # Big-endian, so that the order of the bytes is the order of the words.
            words = ((h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)).astype(">u4")
            padded = np.concatenate([np.zeros(SIDE, ">u4"), words, np.zeros(SIDE, ">u4")])
            view = np.lib.stride_tricks.sliding_window_view(padded, SIDE)
            for m, x in zip(made, (head, np.full(len(at), key, np.int64), at, view[at + AHEAD + SIDE], view[at][:, ::-1]), strict=True):
                m.append(x)
            held += len(at)
            if held > 20_000:
                yield batch_of()
                made, held = [[], [], [], [], []], 0
        if held:
            yield batch_of()

    return docs.mapInArrow(run, "head long, key long, at long, ahead binary, behind binary")


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal words from the start of each pair of rows, 0 being no word."""
    equal = (x == y) & (x != 0)
    return np.where(equal.all(1), x.shape[1], np.argmin(equal, axis=1))


def _windows(head: np.ndarray, ahead: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, words to the left and hash of every run of ``LEAST`` words around each suffix."""

    def prefixes(words):
        out = np.zeros((len(words), SIDE + 1), np.uint64)
        for i in range(SIDE):
            out[:, i + 1] = mixed(out[:, i] * np.uint64(0x100000001B3) + words[:, i].astype(np.uint64) + np.uint64(1))
        return out

    left, right = prefixes(behind), prefixes(ahead)
    side = np.arange(SIDE + 1)
    hashes = mixed(head.view(np.uint64)[:, None] + left * np.uint64(3) + right[:, SIDE - side] * np.uint64(0x9E3779B97F4A7C15))
    valid = ((behind != 0).sum(1)[:, None] >= side) & ((ahead != 0).sum(1)[:, None] >= SIDE - side)
    row, a = np.nonzero(valid)
    return row, a, hashes[row, a].view(np.int64)


def _compare(ordered: DataFrame) -> DataFrame:
    """Compare neighbours within each part of the ordered suffixes.

    Kinds of rows: a match has the words added to the left and right and the other
    document (``partner``); a link has two documents that share a run of ``LEAST`` words.
    Groups of equal first words that go on in another part also give each of their
    windows (``w``) with its smallest (``key``) and largest document (``partner``) here,
    and those windows of a suffix that the neighbours leave to be asked for.
    """

    def run(batches):
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        head, key, at = (table.column(c).to_numpy() for c in ("head", "key", "at"))
        ahead, behind = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), ">u4").reshape(len(head), SIDE).astype(np.uint32)
            for c in ("ahead", "behind")
        )
        n = len(head)
        index = np.arange(n)
        turn = np.flatnonzero(np.diff(head)) + 1
        group = np.searchsorted(turn, index, "right")
        first = np.concatenate([[0], turn])[group]
        last = np.concatenate([turn, [n]])[group] - 1
        other = np.flatnonzero((np.diff(key) != 0) | (np.diff(head) != 0)) + 1
        run_of = np.searchsorted(other, index, "right")
        before = np.concatenate([[0], other])[run_of] - 1  # nearest row before of another document
        after = np.concatenate([other, [n]])[run_of]
        best, left, right, partner = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1)
        pairs = []  # documents that share a run
        chained = np.zeros(len(other) + 1, bool)  # by run of one document: the run before shares words enough
        chained[np.concatenate([[0], run_of[first[1:][np.diff(first) > 0]]])] = True
        for near in (before, after):
            ok = np.flatnonzero((near >= first) & (near <= last))
            r, lft = _common(ahead[ok], ahead[near[ok]]), _common(behind[ok], behind[near[ok]])
            link = ok[r + lft >= SIDE]
            pairs.append(np.stack([np.maximum(key[link], key[near[link]]), np.minimum(key[link], key[near[link]])], 1))
            chained[np.maximum(run_of[link], run_of[near[link]])] = True
            better = r + lft > best[ok]
            ok, r, lft = ok[better], r[better], lft[better]
            best[ok], left[ok], right[ok], partner[ok] = r + lft, lft, r, key[near[ok]]
        good = best >= SIDE
        # Words shared with a neighbour that are too few count for nothing.
        left[~good], right[~good] = 0, 0
        opened = (first == 0) | (last == n - 1)
        # A document further away may share other words than the neighbours do: the runs of such groups are counted.
        more = np.zeros(len(turn) + 1, bool)
        more[group[((best < 2 * SIDE) | ~chained[run_of]) & ~opened]] = True
        more &= np.bincount(group, minlength=len(more)) > 2
        rows = np.flatnonzero(more[group])
        if len(rows):
            row, a, w = _windows(head[rows], ahead[rows], behind[rows])
            order = np.lexsort((key[rows][row], w))
            row, a, w = rows[row[order]], a[order], w[order]
            edge = np.concatenate([[0], np.flatnonzero(np.diff(w)) + 1, [len(w)]])
            of = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
            low, high = key[row[edge[:-1]]][of], key[row[edge[1:] - 1]][of]
            hit = low != high
            row, a, low, high = row[hit], a[hit], low[hit], high[hit]
            pairs.append(np.stack([key[row], low], 1))
            np.maximum.at(left, row, a)
            np.maximum.at(right, row, SIDE - a)
            alone = ~good[row]
            partner[row[alone]] = np.where(key[row] == low, high, low)[alone]
            good[row] = True
        done = np.flatnonzero(good)
        nothing = np.zeros(len(done), np.int64)
        kinds = [(MATCH, key[done], at[done], left[done], right[done], partner[done], nothing)]
        rows = np.flatnonzero(opened)
        row, a, w = _windows(head[rows], ahead[rows], behind[rows])
        row = rows[row]
        # What the neighbours have shown already is not asked again.
        asked = np.flatnonzero((a > left[row]) | (SIDE - a > right[row]))
        kinds.append((ASKED, key[row[asked]], at[row[asked]], a[asked], SIDE - a[asked], np.full(len(asked), -1), w[asked]))
        order = np.lexsort((key[row], w))
        k, w = key[row[order]], w[order]
        begin = np.flatnonzero(np.diff(w, prepend=w[:1] - 1)) if len(w) else np.empty(0, np.int64)
        end = np.append(begin[1:], len(w)) - 1 if len(w) else begin
        nothing = np.zeros(len(begin), np.int64)
        kinds.append((SHARED, k[begin], nothing, nothing, nothing, k[end], w[begin]))
        pairs.append(np.stack([k, np.repeat(k[begin], end + 1 - begin)], 1))
        pairs = np.concatenate(pairs)
        pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
        nothing = np.zeros(len(pairs), np.int64)
        kinds.append((LINK, pairs[:, 0], nothing, nothing, nothing, pairs[:, 1], nothing))
        arrays = [np.concatenate(x) for x in zip(*[[*columns, np.full(len(columns[0]), kind)] for kind, *columns in kinds], strict=True)]
        for start in range(0, len(arrays[0]), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[start : start + 100_000]) for x in arrays], names=["key", "at", "left", "right", "partner", "w", "kind"]
            )

    return ordered.mapInArrow(run, "key long, at long, left long, right long, partner long, w long, kind long")


def repeated_passages(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with a passage of ``LEAST`` or more words that another document has too.

    Words are runs of other characters than space and U+0009 to U+000D, compared as they
    are. Columns ``key``, ``n_words_repeated``, ``spans`` (array of word ``start`` and
    ``end``, merged where they meet), ``partners`` (documents that neighbours were
    found in, not all) and ``component_id`` (the smallest document of all that shared
    passages connect, also over others; its copy is the one to keep). ``key`` is an integer. Null, empty and shorter texts have no passage; rows
    with a null key are left out; rows that repeat a key are one document, so their
    passages count only if another key has them. Other columns are not read. An empty
    table gives an empty result.
    """
    docs = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).filter("key is not null")
    table, bits = _shared_heads(docs)
    stored = write_through(_suffixes(docs, table, bits), "suffixes")
    order = ["head", "ahead", "behind", "key", "at"]
    found = write_through(_compare(stored.repartitionByRange(*order).sortWithinPartitions(*order)), "matches")
    shared = found.filter(F.col("kind") == SHARED).select("w", "key", "partner")
    both = shared.groupBy("w").agg(F.min("key").alias("x"), F.max("partner").alias("y")).filter("x != y")
    both = write_through(both, "windows")
    other = F.when(F.col("key") == F.col("x"), F.col("y")).otherwise(F.col("x"))
    far = found.filter(F.col("kind") == ASKED).join(both, "w").select("key", "at", "left", "right", other.alias("partner"))
    matches = found.filter(F.col("kind") == MATCH).select("key", "at", "left", "right", "partner").unionByName(far)
    near = found.filter(F.col("kind") == LINK).select(F.col("key").alias("a"), F.col("partner").alias("b"))
    component = connected_components(near.unionByName(shared.join(both, "w").select(F.col("key").alias("a"), F.col("x").alias("b"))))
    spans = matches.select(
        "key", "partner",
        F.struct((F.col("at") - F.col("left")).alias("start"), (F.col("at") + AHEAD + F.col("right")).alias("end")).alias("s"),
    )
    per_doc = spans.groupBy("key").agg(
        F.array_sort(F.collect_set("s")).alias("s"), F.array_sort(F.collect_set("partner")).alias("partners")
    )

    def run(batches):
        for batch in batches:
            spans, totals = [], []
            for row in batch.column("s").to_pylist():
                out: list[dict] = []
                for s in row:
                    if out and s["start"] <= out[-1]["end"]:
                        out[-1]["end"] = max(out[-1]["end"], s["end"])
                    else:
                        out.append(dict(s))
                spans.append(out)
                totals.append(sum(s["end"] - s["start"] for s in out))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(totals, pa.int64()), pa.array(spans, kind), batch.column("partners")],
                names=["key", "n_words_repeated", "spans", "partners"],
            )

    schema = "key long, n_words_repeated long, spans array<struct<start:long,end:long>>, partners array<long>"
    named = component.select(F.col("node").alias("key"), F.col("component").alias("component_id"))
    return per_doc.mapInArrow(run, schema).join(named, "key", "left").withColumnRenamed("key", key)
